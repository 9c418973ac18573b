"""Byte-level BPE encoding and decoding with a memory-mapped lexicon of frequent words.

Frequent words of the corpus, with their finished ids, are compiled into a minimal acyclic
automaton: words share prefixes and suffixes, and the numbers on the path to a word add up to its place in
a table of ids. The file is distributed once per executor and memory-mapped by its Python
workers. A batch's distinct words walk the automaton together, byte by byte; words it does
not hold are merged exactly, all of them step by step at once. Both ways give the same ids, so the
lexicon changes the speed only.

The vocabulary file has the format of the ``tokenizers`` library (byte-level BPE). Its special strings are
recognised in a text, as that library does by default.
"""

from __future__ import annotations

import functools
import itertools
import json
import mmap
import os
import re
import uuid
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import ship_package, stored, write_bytes
from tarmac.session import scratch_path

# Fixed value: how byte-level BPE cuts a text into words.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Words of the lexicon, the most frequent of all documents; bounds the file (a few MB).
LEXICON_WORDS = 50_000
LEXICON_WORD_BYTES = 32
WORDS_HELD = 60_000
# Texts that are encoded at once: as many as stay below these bytes, but at least one.
_TEXTS_AT_ONCE, _BYTES_AT_ONCE = 256, 512 << 10
# Words a task counts before it hands them on; more of them make fewer rows to shuffle.
WORDS_COUNTED = 200_000
_LONG = 48


# --- vocabulary -------------------------------------------------------------------


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in the vocabulary file."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


class Vocabulary:
    """Ids of bytes and merges, bytes of ids, and the special strings."""

    def __init__(self, spec: str):
        loaded = json.loads(spec)
        letters = _byte_letters()
        vocab, merges = loaded["model"]["vocab"], loaded["model"]["merges"]
        specials = {t["content"]: t["id"] for t in loaded.get("added_tokens", [])}
        size = 1 + max([*vocab.values(), *specials.values()])
        self.token_bytes = [b""] * size
        for token, i in vocab.items():
            self.token_bytes[i] = bytes(letters[c] for c in token)
        for content, i in specials.items():
            self.token_bytes[i] = content.encode()
        self.byte_ids = np.zeros(256, dtype=np.int32)
        for letter, byte in letters.items():
            self.byte_ids[byte] = vocab[letter]
        # The last place is for ids outside the vocabulary.
        self.tokens = pa.array([*self.token_bytes, b""], pa.large_binary())
        self.specials = specials
        self.size = size
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        left = np.array([vocab[a] for a, _ in pairs], dtype=np.int64)
        right = np.array([vocab[b] for _, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int64)
        self.no_rank = len(pairs)
        self._hash_pairs(left * size + right, made)
        self.pattern = regex.compile(WORD)
        self.special_pattern = (
            regex.compile("(" + "|".join(map(regex.escape, specials)) + ")") if specials else None
        )

    def _hash_pairs(self, keys: np.ndarray, made: np.ndarray) -> None:
        """An open-addressing table from pair to rank and result, probed for all pairs at once."""
        self.slots = 1 << max(4, (4 * len(keys)).bit_length())
        self.held = np.full(self.slots, -1, dtype=np.int64)
        self.rank_at = np.full(self.slots, self.no_rank, dtype=np.int32)
        self.made_at = np.zeros(self.slots, dtype=np.int32)
        left, at, self.probes = np.arange(len(keys)), self._slot(keys), 0
        while len(left):
            free = np.flatnonzero(self.held[at] == -1)
            _, first = np.unique(at[free], return_index=True)
            put = free[first]
            self.held[at[put]] = keys[left[put]]
            self.rank_at[at[put]], self.made_at[at[put]] = left[put], made[left[put]]
            stay = np.ones(len(left), dtype=bool)
            stay[put] = False
            left, at = left[stay], (at[stay] + 1) & (self.slots - 1)
            self.probes += 1

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        mixed = keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return (mixed >> np.uint64(64 - self.slots.bit_length() + 1)).astype(np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and result of merging each pair; ``no_rank`` where there is no merge."""
        wanted = left.astype(np.int64) * self.size + right
        wanted[(left < 0) | (right < 0)] = -2
        at = self._slot(wanted)
        rank = np.full(wanted.shape, self.no_rank, dtype=np.int32)
        made = np.zeros(wanted.shape, dtype=np.int32)
        hit = self.held[at] == wanted
        rank[hit], made[hit] = self.rank_at[at[hit]], self.made_at[at[hit]]
        # Few pairs lie behind their first slot.
        open_ = np.nonzero(~hit & (self.held[at] != -1) & (wanted >= 0))
        at, wanted = at[open_], wanted[open_]
        for _ in range(self.probes - 1):
            if not len(wanted):
                break
            at = (at + 1) & (self.slots - 1)
            found = self.held[at] == wanted
            place = tuple(axis[found] for axis in open_)
            rank[place], made[place] = self.rank_at[at[found]], self.made_at[at[found]]
            more = ~found & (self.held[at] != -1)
            at, wanted, open_ = at[more], wanted[more], tuple(axis[more] for axis in open_)
        return rank, made

    def merge(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words by the merge rules, one array per word."""
        counts, ids = self.merge_flat(words)
        return np.split(ids, np.cumsum(counts)[:-1]) if words else []

    def merge_flat(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids in one array; words of about one length together."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        counts = np.zeros(len(words), dtype=np.int64)
        order, parts = [], []
        for low, high in ((0, 4), (4, 8), (8, 12), (12, 16), (16, 24), (24, _LONG)):
            chosen = np.flatnonzero((sizes > low) & (sizes <= high))
            for at in range(0, len(chosen), 4096):
                part = chosen[at : at + 4096]
                counts[part], ids = self._merge_rows([words[i] for i in part], sizes[part])
                order.append(part)
                parts.append(ids)
        for i in np.flatnonzero(sizes > _LONG):
            ids = self._merge_long(words[i])
            counts[i] = len(ids)
            order.append(np.array([i]))
            parts.append(ids.astype(np.int32))
        if not parts:
            return counts, np.empty(0, dtype=np.int32)
        done, flat = np.concatenate(order), np.concatenate(parts)
        starts = np.zeros(len(words), dtype=np.int64)
        starts[done] = np.cumsum(counts[done]) - counts[done]
        return counts, flat[_spread(starts, counts)]

    def _merge_rows(self, words: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = int(sizes.max())
        raw = np.frombuffer(b"".join([w.ljust(width, b"\0") for w in words]), dtype=np.uint8)
        out = self.byte_ids[raw].reshape(len(words), width)
        columns = np.arange(width)
        out[columns[None, :] >= sizes[:, None]] = -1
        ids, live = out, np.arange(len(words))
        ranks = np.full(ids.shape, self.no_rank, dtype=np.int32)
        made = np.zeros(ids.shape, dtype=np.int32)
        if width > 1:
            ranks[:, :-1], made[:, :-1] = self.pair_ranks(ids[:, :-1], ids[:, 1:])
        while True:
            best = ranks.argmin(axis=1)
            rows = np.arange(len(live))
            stay = ranks[rows, best] < self.no_rank
            if not stay.all():
                out[live[~stay], : ids.shape[1]] = ids[~stay]
                out[live[~stay], ids.shape[1] :] = -1
                ids, ranks, made, live, best = ids[stay], ranks[stay], made[stay], live[stay], best[stay]
                rows = rows[: len(live)]
            if not len(live):
                break
            ids[rows, best] = made[rows, best]
            # Close the gap behind the merged pair; one column is empty then.
            kept = columns[None, : ids.shape[1]] != (best + 1)[:, None]
            shape = (len(live), ids.shape[1] - 1)
            ids, made = ids[kept].reshape(shape), made[kept].reshape(shape)
            ranks = ranks[kept].reshape(shape)
            for column in (best - 1, best):
                valid = np.flatnonzero((column >= 0) & (column < shape[1] - 1))
                at = column[valid]
                ranks[valid, at], made[valid, at] = self.pair_ranks(ids[valid, at], ids[valid, at + 1])
            last = np.flatnonzero(best >= shape[1] - 1)
            ranks[last, shape[1] - 1] = self.no_rank
        there = out >= 0
        return there.sum(axis=1), out[there]

    def _merge_long(self, word: bytes) -> np.ndarray:
        """Merge one long word rank by rank, all places of a rank in one sweep."""
        ids = self.byte_ids[np.frombuffer(word, dtype=np.uint8)]
        while len(ids) > 1:
            ranks, made = self.pair_ranks(ids[:-1], ids[1:])
            rank = ranks.min()
            if rank == self.no_rank:
                break
            places = np.flatnonzero(ranks == rank)
            if len(places) > 1 and (np.diff(places) == 1).any():
                chosen, last = [], -2
                for place in places:  # of overlapping places the left one merges
                    if place > last + 1:
                        chosen.append(place)
                        last = place
                places = np.array(chosen)
            ids[places] = made[places]
            ids = np.delete(ids, places + 1)
        return ids

    def chunks(self, text: str) -> list[str]:
        """The text cut at single spaces that have other characters on both sides.

        No word of the pattern goes over such a space: it starts one. So chunks are encoded
        independently, each with the space before it. The first chunk of a text or after a special
        string has none and is marked, as are special strings.
        """
        if self.special_pattern is None or not any(s in text for s in self.specials):
            return _cut(text)
        out = []
        for piece in self.special_pattern.split(text):
            if piece in self.specials:
                out.append(_SPECIAL + piece)
            elif piece:
                out.extend(_cut(piece))
        return out

    def pieces(self, chunk: str) -> list[str]:
        """The words of a chunk; a special string stands for itself."""
        if chunk.isalpha():  # letters alone are one word
            return [" " + chunk]
        body = chunk[:-1]
        if chunk[-1] in ".,;:!?" and body.isalpha():
            return [" " + body, chunk[-1]]
        if chunk[0] == _SPECIAL:
            return [chunk]
        return self.pattern.findall(chunk[1:] if chunk[0] == _FIRST else " " + chunk)


# Marks before a chunk; lone surrogates are in no valid text.
_FIRST, _SPECIAL = "\ud800", "\ud801"
_IRREGULAR = re.compile(r" (?:(?=\s)|(?<=\s.))")


def _cut(text: str) -> list[str]:
    if not text:
        return []
    if text[0] == " " or text[-1] == " " or _IRREGULAR.search(text):
        out = re.split(r"(?<=\S) (?=\S)", text)
    else:
        out = text.split(" ")
    out[0] = _FIRST + out[0]
    return out


def _spread(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """All indexes of the runs [start, start + count), one run after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


# --- the lexicon automaton ----------------------------------------------------------


def compile_lexicon(words: dict[bytes, np.ndarray]) -> bytes:
    """The minimal acyclic automaton of the words with their ids, as a file's content.

    Words are added in order; what can no longer change is replaced by an equal state that is there
    already. Each edge then gets the number of words that branch off before it.
    """
    registry: dict[tuple, int] = {}
    finals: list[bool] = []
    edges: list[tuple] = []

    def freeze(final: bool, outgoing: tuple) -> int:
        key = (final, outgoing)
        if key not in registry:
            registry[key] = len(finals)
            finals.append(final)
            edges.append(outgoing)
        return registry[key]

    # The open path: per depth whether a word ends there, and the frozen edges so far.
    path_final, path_edges, previous = [False], [[]], b""

    def close(depth: int) -> None:
        while len(path_final) - 1 > depth:
            state = freeze(path_final.pop(), tuple(path_edges.pop()))
            path_edges[-1].append((previous[len(path_final) - 1], state))

    for word in sorted(words):
        shared = len(os.path.commonprefix([previous, word]))
        close(shared)
        for _ in range(len(word) - shared):
            path_final.append(False)
            path_edges.append([])
        path_final[-1] = True
        previous = word
    close(0)
    start = freeze(path_final[0], tuple(path_edges[0]))

    below = [0] * len(finals)  # words reachable; targets are frozen before their sources
    keys, targets, skips = [], [], []
    for state, outgoing in enumerate(edges):
        count = int(finals[state])
        for byte, target in outgoing:
            keys.append(state * 256 + byte)
            targets.append(target)
            skips.append(count)
            count += below[target]
        below[state] = count
    ids = [words[w] for w in sorted(words)]
    offsets = np.concatenate([[0], np.cumsum([len(i) for i in ids])])
    parts = [
        np.array(keys, np.int64), np.array(targets, np.int32), np.array(skips, np.int32),
        np.array(finals, np.uint8), offsets.astype(np.int32),
        np.concatenate([*ids, np.empty(0, np.int64)]).astype(np.int32),
    ]
    head = np.array([start, *map(len, parts)], np.int64)
    return b"".join(part.tobytes() for part in (head, *parts))


class Lexicon:
    """The compiled automaton, memory-mapped."""

    def __init__(self, path: str):
        with open(path, "rb") as file:
            mapped = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        head = np.frombuffer(mapped, np.int64, 7)
        self.start, at, parts = int(head[0]), head.nbytes, []
        kinds = (np.int64, np.int32, np.int32, np.uint8, np.int32, np.int32)
        for kind, size in zip(kinds, head[1:], strict=True):
            parts.append(np.frombuffer(mapped, kind, int(size), at))
            at += parts[-1].nbytes
        self.keys, self.targets, self.skips, self.finals, self.offsets, self.ids = parts

    def find(self, words: list[bytes]) -> np.ndarray:
        """The place of each word in the lexicon, or -1."""
        place = np.full(len(words), -1, dtype=np.int64)
        if not len(self.keys):
            return place
        sizes = np.array([len(w) for w in words])
        live = np.flatnonzero((sizes > 0) & (sizes <= LEXICON_WORD_BYTES))
        if not len(live):
            return place
        width = int(sizes[live].max())
        raw = np.frombuffer(b"".join(words[i].ljust(width, b"\0") for i in live), np.uint8)
        raw = raw.reshape(len(live), width)
        state = np.full(len(live), self.start, dtype=np.int64)
        total, row = np.zeros(len(live), dtype=np.int64), np.arange(len(live))
        for depth in range(width):
            wanted = state * 256 + raw[row, depth]
            at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
            there = self.keys[at] == wanted
            at, row, live = at[there], row[there], live[there]
            state, total = self.targets[at].astype(np.int64), total[there] + self.skips[at]
            ended = sizes[live] == depth + 1
            hit = ended & (self.finals[state] == 1)
            place[live[hit]] = total[hit]
            row, live, state, total = row[~ended], live[~ended], state[~ended], total[~ended]
        return place

    def ids_at(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of the words at these places, and all ids in one array."""
        starts = self.offsets[places].astype(np.int64)
        counts = self.offsets[places + 1] - starts
        return counts, self.ids[_spread(starts, counts)]


# --- encoding -------------------------------------------------------------------------


class _Numbers(dict):
    """Gives names that it has not met the next number."""

    def __missing__(self, name: str) -> int:
        number = self[name] = len(self)
        return number


class _Runs:
    """Numbered names with a run of integers each."""

    def __init__(self):
        self.number = _Numbers()
        self.values = np.empty(0, dtype=np.int32)
        self.offsets = np.zeros(1, dtype=np.int64)

    def numbers(self, names: list[str]) -> list[int]:
        """The number of each name; names not met before get the next ones."""
        return list(map(self.number.__getitem__, names))

    def new(self) -> list[str]:
        """Names that have a number and no run yet, in order."""
        return list(itertools.islice(self.number, len(self.offsets) - 1, None))

    def add(self, counts: np.ndarray, values: np.ndarray) -> None:
        self.values = np.concatenate([self.values, values.astype(np.int32)])
        self.offsets = np.concatenate([self.offsets, self.offsets[-1] + np.cumsum(counts)])

    def at(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        starts = self.offsets[numbers]
        counts = self.offsets[numbers + 1] - starts
        return counts, self.values[_spread(starts, counts)]


class Encoder:
    """Encodes texts; remembers chunks and words it has met, a bounded number of them."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self._forget()

    def _forget(self) -> None:
        self.chunks, self.words = _Runs(), _Runs()  # chunks to words, words to ids

    def _learn(self) -> None:
        """Words of the new chunks, and ids of the new words."""
        cut = [self.vocabulary.pieces(c) for c in self.chunks.new()]
        numbers = self.words.numbers([p for own in cut for p in own])
        self.chunks.add(np.fromiter(map(len, cut), np.int64, len(cut)), np.array(numbers, dtype=np.int32))
        new = self.words.new()
        counts = np.zeros(len(new), dtype=np.int64)
        specials = self.vocabulary.specials
        raw = [b"" if w[0] == _SPECIAL else w.encode() for w in new]
        place = self.lexicon.find(raw) if self.lexicon else np.full(len(raw), -1)
        known = np.flatnonzero(place >= 0)
        unseen = np.flatnonzero((place < 0) & (np.fromiter(map(len, raw), np.int64, len(raw)) > 0))
        special = [i for i, w in enumerate(new) if w[0] == _SPECIAL]
        parts = [np.empty(0, dtype=np.int32)]
        if len(known):
            counts[known], ids = self.lexicon.ids_at(place[known])
            parts.append(ids)
        counts[unseen], ids = self.vocabulary.merge_flat([raw[i] for i in unseen])
        parts.append(ids)
        counts[special] = 1
        parts.append(np.array([specials[new[i][1:]] for i in special], dtype=np.int32))
        order = np.concatenate([known, unseen, np.array(special, dtype=np.int64)])
        starts = np.zeros(len(counts), dtype=np.int64)
        starts[order] = np.cumsum(counts[order]) - counts[order]
        self.words.add(counts, np.concatenate(parts)[_spread(starts, counts)])

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Row offsets and ids of the texts; null encodes as an empty text."""
        if len(self.chunks.number) > WORDS_HELD:
            self._forget()
        sizes, met = [], []
        for text in texts:
            own = self.vocabulary.chunks(text) if text else []
            sizes.append(len(own))
            met.extend(self.chunks.numbers(own))
        self._learn()
        word_counts, words = self.chunks.at(np.array(met, dtype=np.int64))
        counts, ids = self.words.at(words)
        # Ids up to each word, then up to each chunk, then up to each text.
        ends = np.concatenate([[0], np.cumsum(counts)])
        ends = ends[np.concatenate([[0], np.cumsum(word_counts)])]
        return ends[np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])], ids


@functools.lru_cache(maxsize=1)
def _vocabulary(spec_file: str) -> Vocabulary:
    with open(spec_file, encoding="utf-8") as file:
        return Vocabulary(file.read())


@functools.lru_cache(maxsize=1)
def _encoder(spec_file: str, lexicon_file: str | None) -> Encoder:
    return Encoder(_vocabulary(spec_file), Lexicon(lexicon_file) if lexicon_file else None)


@dataclass(frozen=True)
class Codec:
    """Names of the vocabulary and lexicon files as distributed to the executors."""

    spec: str
    lexicon: str | None

    def encoder(self) -> Encoder:
        return _encoder(SparkFiles.get(self.spec), self.lexicon and SparkFiles.get(self.lexicon))

    def encode(self, column: Column) -> Column:
        """The ids of a text column as array<int>; null gives an empty array."""

        @F.arrow_udf("array<int>")
        def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            encoder = self.encoder()
            for part in parts:
                pieces = []
                for at, size in _slices(part):
                    rows, ids = encoder.encode(part.slice(at, size).to_pylist())
                    pieces.append(_lists(rows, ids))
                yield pa.concat_arrays(pieces) if pieces else pa.array([], pa.list_(pa.int32()))

        return run(column.cast("string"))

    def decode(self, column: Column) -> Column:
        """The text of an array<int> column of ids; special ids give their strings, null an empty text.

        Bytes that are no UTF-8 become replacement characters; ids outside the vocabulary give nothing.
        """

        @F.arrow_udf("string")
        def run(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
            tokens = _vocabulary(SparkFiles.get(self.spec)).tokens
            for part in parts:
                lists = part.fill_null([])
                yield decode_rows(tokens, lists.offsets.to_numpy(), lists.values.fill_null(-1).to_numpy())

        return run(column)


def decode_rows(tokens: pa.LargeBinaryArray, rows: np.ndarray, ids: np.ndarray) -> pa.StringArray:
    """The text of each row of ids, between its offset in ``rows`` and the next.

    The bytes of all tokens come to lie one after the other, so a row is a stretch of them.
    """
    first = int(rows[0])
    ids, rows = ids[first : int(rows[-1])], rows.astype(np.int64) - first
    if not len(ids):
        return pa.array([""] * (len(rows) - 1), pa.string())
    known = np.where((ids >= 0) & (ids < len(tokens) - 1), ids, len(tokens) - 1)
    taken = tokens.take(pa.array(known, pa.int32()))
    _, offsets, data = taken.buffers()
    ends = np.frombuffer(offsets, np.int64, len(taken) + 1, taken.offset * 8)[rows]
    if data is None:
        return pa.array([""] * (len(rows) - 1), pa.string())
    texts = pa.LargeStringArray.from_buffers(len(rows) - 1, pa.py_buffer(ends), data)
    try:
        texts.validate(full=True)
    except pa.ArrowInvalid:
        raw = memoryview(data)
        decoded = [bytes(raw[a:b]).decode("utf-8", "replace") for a, b in itertools.pairwise(ends.tolist())]
        return pa.array(decoded, pa.string())
    return texts.cast(pa.string())


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(start, rows) of the texts to encode at once."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy()
    start = held = 0
    for at, size in enumerate(sizes.tolist()):
        if at > start and (at - start == _TEXTS_AT_ONCE or held + size > _BYTES_AT_ONCE):
            yield start, at - start
            start, held = at, 0
        held += size
    if start < len(sizes):
        yield start, len(sizes) - start


# --- building the lexicon ---------------------------------------------------------------


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(counts: Counter) -> pa.RecordBatch:
        words = list(counts)
        return pa.record_batch(
            [pa.array(words, pa.string()), pa.array([counts[w] for w in words], pa.int64())],
            names=["word", "n"],
        )

    counts: Counter = Counter()
    for batch in batches:
        for at in range(0, batch.num_rows, _TEXTS_AT_ONCE):
            for text in batch["text"].slice(at, _TEXTS_AT_ONCE).to_pylist():
                if text:
                    counts.update(text.split())
            if len(counts) > WORDS_COUNTED:
                yield flush(counts)
                counts = Counter()
    if counts:
        yield flush(counts)


def frequent_words(
    docs: DataFrame, text_col: str = "text", words: int = LEXICON_WORDS
) -> list[str]:
    """The most frequent white-space separated words of all texts, at most ``words``; ties stay or go together."""
    ship_package(docs.sparkSession)
    counted = (
        docs.select(F.col(text_col).cast("string").alias("text"))
        .mapInArrow(_count_words, "word string, n bigint")
        .groupBy("word")
        .agg(F.sum("n").alias("n"))
    )
    counted = stored(counted, "bpe-words")
    # The lowest count that keeps the list within bounds, from how many words have each count.
    least, held = None, 0
    for n, with_n in _largest_counts(counted, words):
        if held + with_n > words:
            break
        least, held = n, held + with_n
    if least is None:
        return []
    return sorted(r["word"] for r in counted.filter(F.col("n") >= least).select("word").collect())


def _largest_counts(counted: DataFrame, rows: int) -> list[tuple[int, int]]:
    """The largest counts with their numbers of words: no more of them than words are wanted."""
    spread = counted.groupBy("n").agg(F.count("*").alias("with_n"))
    return [tuple(r) for r in spread.orderBy(F.desc("n")).limit(rows).collect()]


def _distribute(spark: SparkSession, data: bytes, name: str) -> str:
    """Store bytes in the shared folder and have every executor fetch them once."""
    target = scratch_path(spark, "bpe") + "/" + name
    write_bytes(spark, target, data)
    spark.sparkContext.addFile(target)
    return name


def codec(spark: SparkSession, vocabulary_path: str, words: Iterable[str] = ()) -> Codec:
    """Distribute the vocabulary and, if there are words, the lexicon compiled from them."""
    ship_package(spark)
    with open(vocabulary_path, encoding="utf-8") as file:
        spec = file.read()
    vocabulary = Vocabulary(spec)
    tag = uuid.uuid4().hex
    spec_name = _distribute(spark, spec.encode(), f"vocabulary-{tag}.json")
    # A word is mostly met after a space, at times at a line's start.
    pieces = {
        piece.encode()
        for word in words
        for form in (f" {word}", word)
        for piece in vocabulary.pattern.findall(form)
        if len(piece.encode()) <= LEXICON_WORD_BYTES
    }
    if not pieces:
        return Codec(spec_name, None)
    ordered = sorted(pieces)
    lexicon = compile_lexicon(dict(zip(ordered, vocabulary.merge(ordered), strict=True)))
    return Codec(spec_name, _distribute(spark, lexicon, f"lexicon-{tag}.bin"))


def round_trip(
    docs: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    lexicon_words: int = LEXICON_WORDS,
) -> DataFrame:
    """(id, ids, decoded) for every row: the encoded text and what its ids decode to.

    Null and empty texts give no ids and an empty text. Texts of any length are encoded whole. Repeated rows are
    returned each; other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    coder = codec(spark, vocabulary_path, frequent_words(docs, text_col, lexicon_words))
    kind = docs.select(id_col).schema[0].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # One worker does both ways, a few texts at a time.
        encoder = coder.encoder()
        tokens = encoder.vocabulary.tokens
        for batch in batches:
            for at, size in _slices(batch["text"]):
                part = batch.slice(at, size)
                rows, ids = encoder.encode(part["text"].to_pylist())
                yield pa.record_batch(
                    [part["id"], _lists(rows, ids), decode_rows(tokens, rows, ids)], names=schema.names
                )

    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return columns.mapInArrow(run, schema)


def _lists(rows: np.ndarray, ids: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), pa.array(ids, pa.int32()))
