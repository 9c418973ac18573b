"""Periodic runs of words by recompression.

1. Recompression: the words of a batch of documents, with a separator of its own after each, are rewritten level by level.
   A block round replaces every stretch of one symbol by (symbol, count); a pair round halves the alphabet by a hash and
   replaces every left symbol followed by a right one. Equal contents get equal symbols, up to the
   ends, whatever surrounds them. All levels together are a run-length grammar of the batch.
2. Longest common extensions: two places climb the levels while their symbols are equal, one step a level (a step over
   a block takes what both have left of it), and come down in the same way where symbols differ. This
   answers how far equal words reach, exactly, in either direction, for many pairs of places at once.
3. Harmonic grid: words with period q agree with those q further on. A run of the length asked for has such agreements over
   at least ``step`` places, so one of them is a multiple of ``step``: only these places are extended, which are n/step for
   each q, and fewer than n log n together. Where both extensions give a run, it is noted.
4. A stretch is found under multiples of its period too; of runs with the same ends the smallest period is the true one.

No suffix array is built. Memory is bounded by the batch; one long document is a batch by itself, and
its candidates are taken a part at a time.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import ship_package
from tarmac.llm.hashing import mix64

LEAST_WORDS = 24
LEAST_PERIODS = 3
BATCH_WORDS = 1 << 18
CANDIDATES = 1 << 21


class Grammar:
    """The levels of a recompression: symbols, the place of each one's parent, and each parent's first child."""

    def __init__(self, symbols: np.ndarray):
        self.symbols, self.parents, self.children, self.of_blocks = [symbols], [], [], []
        used, turn = int(symbols.max(initial=0)) + 1, 0
        # Where all symbols differ, nothing above can be equal.
        while len(np.unique(symbols)) < len(symbols):
            turn += 1
            blocks = turn % 2 == 1
            heads, keys = self._blocks(symbols) if blocks else self._pairs(symbols, turn)
            merged = np.diff(np.append(heads, len(symbols))) > 1
            if not merged.any():
                continue
            out = symbols[heads]
            names = _named(keys[merged])
            out[merged] = used + names
            used += int(names.max()) + 1
            parent = np.zeros(len(symbols), dtype=np.int64)
            parent[heads[1:]] = 1
            self.parents.append(np.cumsum(parent))
            self.children.append(np.append(heads, len(symbols)))
            self.of_blocks.append(blocks)
            self.symbols.append(out)
            symbols = out

    @staticmethod
    def _blocks(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        heads = np.flatnonzero(np.concatenate([[True], symbols[1:] != symbols[:-1]]))
        counts = np.diff(np.append(heads, len(symbols)))
        return heads, _joined(symbols[heads], counts)

    @staticmethod
    def _pairs(symbols: np.ndarray, turn: int) -> tuple[np.ndarray, np.ndarray]:
        side = (mix64(symbols.view(np.uint64) + np.uint64(turn << 40)) >> np.uint64(63)).astype(bool)
        forth, back = side[:-1] & ~side[1:], side[1:] & ~side[:-1]
        merged = forth if forth.sum() >= back.sum() else back
        heads = np.flatnonzero(np.concatenate([[True], ~merged]))
        following = np.minimum(heads + 1, len(symbols) - 1)
        return heads, _joined(symbols[heads], symbols[following])

    def extend(self, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """How many words are equal from places a and b on (or before them); symbols at both ends are unique."""
        start, number = a, np.arange(len(a))
        waiting = []  # by level: what came to a difference there
        at = 0 if forward else -1
        for level, symbols in enumerate(self.symbols):
            if level == len(self.parents):
                waiting.append((number, a, b))
                break
            parent, child = self.parents[level], self.children[level]
            here = (child[parent[a]] == a) & (child[parent[b]] == b)
            same = symbols[a + at] == symbols[b + at]
            step = np.where(~here & same, self._step(level, a, b, forward), 0)
            a, b = a + step, b + step
            up = here | (same & (child[parent[a]] == a) & (child[parent[b]] == b))
            waiting.append((number[~up], a[~up], b[~up]))
            number, a, b = number[up], parent[a[up]], parent[b[up]]
            if not len(number):
                break
        number = a = b = np.empty(0, dtype=np.int64)
        for level in range(len(waiting) - 1, -1, -1):
            if len(number):
                child, symbols = self.children[level], self.symbols[level]
                a, b = child[a], child[b]
                same = symbols[a + at] == symbols[b + at]
                step = np.where(same, self._step(level, a, b, forward), 0)
                a, b = a + step, b + step
            n, x, y = waiting[level]
            number, a, b = np.concatenate([number, n]), np.concatenate([a, x]), np.concatenate([b, y])
        out = np.empty(len(start), dtype=np.int64)
        out[number] = np.abs(a - start[number])
        return out

    def _step(self, level: int, a: np.ndarray, b: np.ndarray, forward: bool) -> np.ndarray:
        """Symbols to go over at once: what is left of the shorter block, or one."""
        if not self.of_blocks[level]:
            return np.full(len(a), 1 if forward else -1)
        parent, child = self.parents[level], self.children[level]
        if forward:
            return np.minimum(child[parent[a] + 1] - a, child[parent[b] + 1] - b)
        return -np.minimum(a - child[parent[a - 1]], b - child[parent[b - 1]])


def _joined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Two numbers as one where they fit, else side by side."""
    if max(x.max(initial=0), y.max(initial=0)) < 1 << 31:
        return (x << np.int64(32)) | y
    return np.stack([x, y], axis=1)


def _named(keys: np.ndarray) -> np.ndarray:
    """Numbers from 0 on, the same for equal keys."""
    if keys.ndim == 1:
        return np.unique(keys, return_inverse=True)[1]
    return np.unique(keys, axis=0, return_inverse=True)[1].reshape(-1)


def grid_step(period: np.ndarray) -> np.ndarray:
    """Places at which every run of a period agrees with itself one period further, at least."""
    return np.maximum(LEAST_WORDS, LEAST_PERIODS * period) - period


def candidates(words: np.ndarray, offset: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Grid places and periods of one document at which a word and the one a period further agree."""
    n = len(words)
    if n < LEAST_WORDS:
        return
    periods = np.arange(1, n // LEAST_PERIODS + 1)
    steps = grid_step(periods)
    counts = (n - periods - 1) // steps + 1
    ends = np.cumsum(counts)
    first = 0
    while first < len(periods):
        done = ends[first - 1] if first else 0
        last = max(first + 1, int(np.searchsorted(ends, done + CANDIDATES, side="right")))
        part = counts[first:last]
        order = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
        q = np.repeat(periods[first:last], part)
        i = order * np.repeat(steps[first:last], part)
        agree = words[i] == words[i + q]
        yield i[agree] + offset, q[agree]
        first = last


def runs_of(documents: list[np.ndarray]) -> list[list[tuple[int, int, int]]]:
    """The (start, length, period) of all runs of each document's words, by start and period."""
    out: list[list[tuple[int, int, int]]] = [[] for _ in documents]
    if not documents:
        return out
    top = max(int(w.max(initial=-1)) for w in documents) + 1
    parts, offsets, at = [np.array([top])], [], 1
    for number, words in enumerate(documents):
        offsets.append(at)
        parts += [words, np.array([top + 1 + number])]
        at += len(words) + 1
    places, periods = [], []
    for words, offset in zip(documents, offsets):
        for i, q in candidates(words, offset):
            places.append(i)
            periods.append(q)
    places, periods = (np.concatenate(x) if x else np.empty(0, dtype=np.int64) for x in (places, periods))
    if not len(places):
        return out
    grammar = Grammar(np.concatenate(parts).astype(np.int64))
    starts, lengths, found = [], [], []
    for part in range(0, len(places), CANDIDATES):
        i, q = places[part : part + CANDIDATES], periods[part : part + CANDIDATES]
        after = grammar.extend(i, i + q, True)
        before = grammar.extend(i, i + q, False)
        long = after + before >= grid_step(q)
        starts.append((i - before)[long])
        lengths.append((q + after + before)[long])
        found.append(q[long])
    starts, lengths, found = np.concatenate(starts), np.concatenate(lengths), np.concatenate(found)
    order = np.lexsort((found, lengths, starts))
    starts, lengths, found = starts[order], lengths[order], found[order]
    fresh = np.ones(len(starts), dtype=bool)
    fresh[1:] = (starts[1:] != starts[:-1]) | (lengths[1:] != lengths[:-1])
    starts, lengths, found = starts[fresh], lengths[fresh], found[fresh]
    owners = np.searchsorted(offsets, starts, side="right") - 1
    order = np.lexsort((found, starts))
    for owner, start, length, period in zip(owners[order], starts[order], lengths[order], found[order]):
        out[owner].append((int(start) - offsets[owner], int(length), int(period)))
    return out


def strongest(runs: list[tuple[int, int, int]]) -> tuple[int, int, int] | None:
    """The run with the greatest length / period, compared exactly; the smallest start, then period, of equals."""
    best = None
    for run in runs:
        if best is None or run[1] * best[2] > best[1] * run[2]:
            best = run
    return best


RUNS_SCHEMA = (
    "id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, "
    "strongest struct<start:bigint,length:bigint,period:bigint>, collapsed binary"
)
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def _as_run(run):
    return None if run is None else dict(zip(("start", "length", "period"), run))


def _analysed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush() -> pa.RecordBatch:
        runs = runs_of(coded)
        collapsed = []
        for words, found in zip(texts, runs):
            if found:
                keep = np.ones(len(words), dtype=bool)
                for start, length, period in found:
                    keep[start + period : start + length] = False
                words = [words[i] for i in np.flatnonzero(keep)]
            collapsed.append(b" ".join(words))
        return pa.record_batch(
            [
                pa.array(ids, pa.int64()),
                pa.array([len(w) for w in texts], pa.int64()),
                pa.array([[_as_run(r) for r in found] for found in runs], pa.list_(_RUN)),
                pa.array([_as_run(strongest(found)) for found in runs], _RUN),
                pa.array(collapsed, pa.binary()),
            ],
            names=["id", "n_words", "runs", "strongest", "collapsed"],
        )

    ids, texts, coded, size = [], [], [], 0
    codes: dict[bytes, int] = defaultdict(count().__next__)
    for batch in batches:
        for key, text in zip(batch["id"], batch["text"]):
            words = (text.as_py() or b"").split()  # bytes are split at ASCII white space
            ids.append(key.as_py())
            texts.append(words)
            coded.append(np.fromiter(map(codes.__getitem__, words), np.int64, len(words)))
            size += len(words) + 1
            if size >= BATCH_WORDS:
                yield flush()
                ids, texts, coded, size = [], [], [], 0
                codes = defaultdict(count().__next__)
    if ids:
        yield flush()


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, n_words, runs, strongest, collapsed.

    Words are what ASCII white space separates. A run is a stretch of words that repeats with its smallest period q, holds at
    least 24 words and three periods, and cannot be longer on either side. ``runs`` has start, length and
    period of all, by start and period; ``strongest`` is the one with the greatest length / period (of equals the smallest
    start, then period), or null; ``collapsed`` joins by one space the words that no run holds after its first q words.

    A null or empty text, or one of white space, has no words, no run and an empty ``collapsed``. Repeated rows are
    returned each, rows without an id too. A text of any length is analysed whole, in memory in proportion to its
    words. An empty table gives none. Other columns are ignored, whatever their names.
    """
    ship_package(docs.sparkSession)
    columns = docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")
    )
    found = columns.mapInArrow(_analysed, RUNS_SCHEMA)
    return found.withColumn("collapsed", F.col("collapsed").cast("string")).withColumnRenamed("id", id_col)
