"""Language-model scores by online logistic context mixing.

A text is its UTF-8 bytes, A-Z lower-cased, and an end byte. Every byte is a path of binary decisions in a Huffman tree over
the training corpus, so frequent bytes take few. A predictor is a table of counts of zeros and ones: its slot for a
decision is a hash of its context (the two bytes before; the last four bytes of the word begun; all of the word begun)
joined with the node of the tree. The logits of the predictors are added with weights; a gate decides which
set of weights is used: the longest context that was ever seen. After every block of decisions the weights follow
the gradient of what the block has cost. So the probability of a text is a product over its decisions, each judged
before it is learned from.

1. One pass counts bytes, which gives the tree. 2. A second pass fills the tables, one set a task: the two contexts
within a word are counted once for every distinct word of a task, times its occurrences. The sets are summed in a
tree of ``FAN_IN`` at a time, in parts of ``PART_SLOTS`` slots, so no task holds more than that many parts. All training texts
are counted; the tables grow with the corpus up to ``MOST_SLOTS``, which bounds what a worker holds.
3. A third pass judges the decisions of all training texts, each by the tables without its own segment, and counts how often which
logits met which bit. The weights that every text begins with are those with the least cost over all these counts, which
are summed as the tables are, by the first logit. Here and in the last pass equal bytes in equal contexts are looked up once for
each segment, or each group of short texts.
4. A last pass scores all texts and counts words. The words of a chunk of documents (of bounded size) are sent once, with
their counts; a window adds up the counts of a word over all chunks, and every chunk gets back the totals
of its words. So a word is shuffled once per chunk, however often it occurs.
"""

from __future__ import annotations

import functools
import heapq
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tarmac.llm.common import ship_package, stored
from tarmac.llm.hashing import mix64

PREDICTORS = 3
END = 0xFF  # never a byte of UTF-8
# Slots of a table, as powers of two: of the two bytes before, and of the others at least and at most.
PAIR_SLOTS, LEAST_SLOTS, MOST_SLOTS, PART_SLOTS = 16, 12, 20, 16
FAN_IN = 64
# Contexts start anew every so many bytes of a text.
SEGMENT = 1 << 20
# Bytes of short texts that are taken together: their arrays stay in the processor's cache. For pairs they are more.
GROUP, PAIR_GROUP = 1 << 15, 1 << 20
CHUNK_BYTES, CHUNK_WORDS = 1 << 26, 600_000
BLOCK_FIRST, BLOCK = 256, 4096
# How far weights follow the gradient: so much a decision, and no more than so much of a block's mean.
RATE, MOST_STEP = 0.0008, 0.3
PRIOR, STRETCH, SCALE = 0.4, 10.0, 12
# The weights that every text begins with: where learning starts, rounds at most, and the share of the cost that ends it.
PRIOR_WEIGHT, MOST_ROUNDS, LEAST_GAIN = 0.4, 12, 1e-7
# Decisions whose cases a task counts at most before it gives the counts away, and the values that a logit can have.
MOST_DECISIONS = 1 << 30
_LEVELS = 2 * int(STRETCH * SCALE) + 1
_PAD = 2
_ODD = mix64(np.arange(50, 50 + PREDICTORS, dtype=np.uint64)) | np.uint64(1)
_VALUES = mix64(np.arange(400, 656, dtype=np.uint64))
_ROOT = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
# What ends a word: the white space of `[^\x20\x09-\x0D]+`, and the end of the text.
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[0x20, *range(0x09, 0x0E), END]] = True
_UNIT = re.compile(rb"[^\x20\x09-\x0D\xFF]*[\x20\x09-\x0D\xFF]")
_LAST = np.array([0, 0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF], dtype=np.uint64)


@dataclass
class Tree:
    """Huffman paths: byte b takes the decisions first[b] to first[b] + length[b]."""

    length: np.ndarray
    first: np.ndarray
    node: np.ndarray
    bit: np.ndarray


def huffman(counts: np.ndarray) -> Tree:
    """The tree for byte counts; a byte that was never seen counts as seen once. Nodes are numbered from the root on."""
    heap = [(int(c) + 1, b, b) for b, c in enumerate(counts)]
    heapq.heapify(heap)
    joined = 256
    while len(heap) > 1:
        x, y = heapq.heappop(heap), heapq.heappop(heap)
        heapq.heappush(heap, (x[0] + y[0], joined, (x, y)))
        joined += 1
    paths: dict[int, list[tuple[int, int]]] = {}
    queue, number = [(-heap[0][0], heap[0][1], heap[0][2], [])], 0
    while queue:  # heaviest first, so that frequent nodes lie close together
        _, _, inner, path = heapq.heappop(queue)
        for bit, (weight, name, below) in enumerate(inner):
            longer = [*path, (number, bit)]
            if isinstance(below, tuple):
                heapq.heappush(queue, (-weight, name, below, longer))
            else:
                paths[below] = longer
        number += 1
    length = np.array([len(paths[b]) for b in range(256)], dtype=np.int64)
    flat = [step for b in range(256) for step in paths[b]]
    return Tree(
        length, np.cumsum(length) - length,
        np.array([n for n, _ in flat], dtype=np.int32), np.array([x for _, x in flat], dtype=np.int32),
    )


def segments(data: bytes) -> list[bytes]:
    """A text's bytes, lower-cased, with the end byte, in parts."""
    data = data.lower() + bytes([END])
    return [data[at : at + SEGMENT] for at in range(0, len(data), SEGMENT)]


class Contexts:
    """The bytes of some segments one after the other, and the contexts of each."""

    def __init__(self, parts: list[bytes], tree: Tree):
        pad = bytes(_PAD)
        raw = np.frombuffer(b"".join([x for part in parts for x in (pad, part)]), dtype=np.uint8)
        sizes = np.array([len(part) + _PAD for part in parts])
        self.starts = np.cumsum(sizes) - sizes
        length = tree.length[raw]
        length[(self.starts[:, None] + np.arange(_PAD)).reshape(-1)] = 0
        self.raw, self.length = raw, length
        self.ends = np.cumsum(length)
        self.bounds = np.concatenate([[0], self.ends[self.starts + sizes - 1]])
        begun = np.zeros(len(raw), dtype=np.int64)
        after = np.flatnonzero(_ENDS[raw[:-1]]) + 1
        begun[after] = after
        begun[self.starts + _PAD] = self.starts + _PAD
        self._begun = np.maximum.accumulate(begun)  # the first byte of the word a byte belongs to

    def before(self) -> np.ndarray:
        """The two bytes before."""
        return self._last(2)

    def _last(self, most: int) -> np.ndarray:
        context = np.zeros(len(self.raw), dtype=np.uint64)
        for k in range(1, most + 1):
            context[k:] |= self.raw[:-k].astype(np.uint64) << np.uint64(8 * (k - 1))
        return context

    def within(self) -> tuple[np.ndarray, np.ndarray]:
        """The last four bytes of the word begun, and a hash of all of it."""
        raw, n = self.raw, len(self.raw)
        four = self._last(4)
        four &= _LAST[np.minimum(np.arange(n) - self._begun, 4)]
        # A hash of bytes by prefix sums: powers of an odd number, divided out again.
        forth, back = _powers(max(1 << 17, 1 << (n + 1).bit_length()))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(_VALUES[raw] * forth[:n], out=sums[1:])
        return four, (sums[:n] - sums[self._begun]) * back[self._begun]

    def distinct(self, apart: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[np.ndarray]]:
        """Bytes that differ from each other or in a context, as places in order, where each one's equals begin, and contexts.

        Equal bytes in equal contexts take equal decisions. With ``apart`` those of one segment only are equal, and segments
        stay in order. The places are sorted by a hash; where two hashes clash, equals may come in several runs.
        """
        before, (four, word) = self.before(), self.within()
        n = len(self.raw)
        plain = (four << np.uint64(24)) | (before << np.uint64(8)) | self.raw
        mixed = (plain * _ROOT) ^ word
        mixed ^= mixed >> np.uint64(32)
        mixed *= _ODD[0]
        place_bits = n.bit_length()
        if apart:
            own = np.zeros(n, dtype=np.uint64)
            own[self.starts[1:]] = 1
            own = np.cumsum(own, dtype=np.uint64)
            own_bits = len(self.starts).bit_length()
            mixed >>= np.uint64(own_bits)
            mixed |= own << np.uint64(64 - own_bits)
        mixed >>= np.uint64(place_bits)
        mixed <<= np.uint64(place_bits)
        mixed |= np.arange(n, dtype=np.uint64)
        mixed.sort()
        order = (mixed & np.uint64((1 << place_bits) - 1)).astype(np.int64)
        plain, word = plain[order], word[order]
        new = np.empty(n, dtype=bool)
        new[0] = True
        np.not_equal(plain[1:], plain[:-1], out=new[1:])
        new[1:] |= word[1:] != word[:-1]
        if apart:
            own = own[order]
            new[1:] |= own[1:] != own[:-1]
        runs = np.flatnonzero(new)
        first = order[runs]
        return order, runs, first, [before[first], four[first], word[runs]]


class Steps:
    """The decisions of some bytes one after the other, each in contexts given by byte, and their slots."""

    def __init__(self, raw: np.ndarray, length: np.ndarray, ends: np.ndarray, tree: Tree, bits: int):
        self.raw, self.length, self.ends, self._bits = raw, length, ends, bits
        self.byte = np.repeat(np.arange(len(raw)), length)  # whose decision it is
        at = (tree.first[raw] - (ends - length)).take(self.byte)
        at += np.arange(len(at))
        self.node, self.bit = tree.node.astype(np.int64).take(at), tree.bit.take(at)

    def slots_of(self, context: np.ndarray, predictor: int) -> np.ndarray:
        bits = table_bits(self._bits)[predictor]
        context = context ^ (context >> np.uint64(29))
        context *= _ODD[predictor]
        context += _ODD[predictor]
        hashed = (context >> np.uint64(64 - bits)).astype(np.int64)
        slots = hashed.take(self.byte)
        slots ^= self.node if bits > 8 else self.node & ((1 << bits) - 1)  # 255 nodes
        return slots


class Decisions(Steps):
    """The decisions of some segments one after the other, and the slots of their contexts."""

    def __init__(self, parts: list[bytes], tree: Tree, bits: int):
        self._contexts = Contexts(parts, tree)
        self.bounds = self._contexts.bounds
        super().__init__(self._contexts.raw, self._contexts.length, self._contexts.ends, tree, bits)

    def before(self) -> np.ndarray:
        """Slots of the two bytes before."""
        return self.slots_of(self._contexts.before(), 0)

    def within(self) -> tuple[np.ndarray, np.ndarray]:
        """Slots of the last four bytes of the word begun, and of all of it."""
        four, word = self._contexts.within()
        return self.slots_of(four, 1), self.slots_of(word, 2)

    def slots(self) -> list[np.ndarray]:
        return [self.before(), *self.within()]


@functools.lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    forth, back = np.full(size, _ROOT), np.full(size, _INVERSE)
    forth[0] = back[0] = 1
    return np.multiply.accumulate(forth), np.multiply.accumulate(back)


def table_bits(bits: int) -> tuple[int, int, int]:
    return min(bits, PAIR_SLOTS), bits, bits


@dataclass
class MixingModel:
    tree: Tree
    bits: int
    stretch: list[np.ndarray]  # by predictor: the logit of every slot, in SCALE-ths
    weights: np.ndarray


def stretched(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """The logit of a slot, in SCALE-ths; 0 where nothing was seen."""
    logit = np.log((ones + PRIOR) / (zeros + PRIOR))
    return np.rint(SCALE * np.clip(logit, -STRETCH, STRETCH)).astype(np.int8)


def gated(logits: list[np.ndarray]) -> np.ndarray:
    """The predictors' logits, and beside them what counts only where the second, or the third, knows its context.

    A weight on a gated copy is what the gate adds to the weight, so one row of weights holds all its sets.
    """
    out = np.empty((2 * PREDICTORS, len(logits[0])), dtype=np.float32)
    for k, values in enumerate(logits):
        np.multiply(values, np.float32(1 / SCALE), out=out[k])
    np.multiply(out[0], logits[1] != 0, out=out[3])
    known = logits[2] != 0
    np.multiply(out[0], known, out=out[4])
    np.multiply(out[1], known, out=out[5])
    return out


def mix(inputs: np.ndarray, bit: np.ndarray, weights: np.ndarray, rate: float, done: int = 0) -> tuple[float, np.ndarray]:
    """The cost in nats of a run of decisions, and the weights after it; ``done`` decisions of the text came before."""
    return _mixed((inputs * (2 * bit - 1).astype(np.float32)).T, weights, rate, done)


def _mixed(signed: np.ndarray, weights: np.ndarray, rate: float, done: int) -> tuple[float, np.ndarray]:
    """``mix`` of inputs that speak for what came, a row for each decision: those of a zero are negated."""
    cost, at, n = 0.0, 0, len(signed)
    while at < n:
        # Blocks double from BLOCK_FIRST on: the first of a text teach most.
        stop = min(n, at + min(BLOCK, max(BLOCK_FIRST, done + at)))
        x = signed[at:stop]
        odds = x @ weights
        np.minimum(odds, 30, out=odds)
        np.maximum(odds, -30, out=odds)
        np.negative(odds, out=odds)
        np.exp(odds, out=odds)  # odds against what came
        whole = odds + np.float32(1)
        odds /= whole
        cost += float(np.log(whole, out=whole).sum(dtype=np.float64))
        step = min(MOST_STEP, rate * (stop - at)) / (stop - at)
        weights = weights + np.float32(step) * (odds @ x)
        at = stop
    return cost, weights


def _inputs(found: Decisions, stretch: list[np.ndarray]) -> np.ndarray:
    return gated([table.take(slots) for table, slots in zip(stretch, found.slots())])


def _signed(parts: list[bytes], model: MixingModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The inputs of the distinct decisions of some segments, which of them each decision is, and where segments end.

    Inputs of a zero are negated. Equal bytes in equal contexts are looked up once.
    """
    found = Contexts(parts, model.tree)
    order, runs, first, contexts = found.distinct(apart=False)
    length = found.length[first]
    ends = np.cumsum(length)
    steps = Steps(found.raw[first], length, ends, model.tree, model.bits)
    logits = [table.take(steps.slots_of(context, k)) for k, (table, context) in enumerate(zip(model.stretch, contexts))]
    signed = np.ascontiguousarray((gated(logits) * (2 * steps.bit - 1).astype(np.float32)).T)
    begins = np.empty(len(order), dtype=np.int64)
    begins[order] = np.repeat(ends - length, np.diff(runs, append=len(order)))
    at = np.arange(found.ends[-1]) + np.repeat(begins - (found.ends - found.length), found.length)
    return signed, at, found.bounds


def cost_of(texts: list[bytes], model: MixingModel) -> Iterator[float]:
    """The cost in nats of every text. Short texts are looked up together, long ones a segment at a time."""
    group: list[bytes] = []
    size = 0
    room = np.empty((0, 2 * PREDICTORS), dtype=np.float32)  # one text's inputs, in the same place for all

    def flush():
        nonlocal room
        signed, at, bounds = _signed(group, model)
        if (most := int(np.diff(bounds).max())) > len(room):
            room = np.empty((most, 2 * PREDICTORS), dtype=np.float32)
        for low, high in zip(bounds[:-1], bounds[1:]):
            own = signed.take(at[low:high], axis=0, out=room[: high - low], mode="clip")
            yield _mixed(own, model.weights, RATE, 0)[0]

    for text in texts:
        parts = segments(text)
        if group and (len(parts) > 1 or size + len(parts[0]) > GROUP):
            yield from flush()
            group, size = [], 0
        if len(parts) == 1:
            group.append(parts[0])
            size += len(parts[0])
            continue
        cost, weights, done = 0.0, model.weights, 0
        for part in parts:
            signed, at, bounds = _signed([part], model)
            more, weights = _mixed(signed.take(at, axis=0), weights, RATE, done)
            cost, done = cost + more, done + int(bounds[-1])
        yield cost
    if group:
        yield from flush()


class Judged:
    """How often training decisions, each judged by the tables without its own segment, had which logits for what came.

    The three logits of a decision, negated where a zero came, are one number, its case; the counts of cases are all that the
    weights depend on, and they add up over texts in any order. Equal bytes in equal contexts of a segment are judged once.
    """

    def __init__(self, tree: Tree, bits: int, counts: list[np.ndarray]):
        self.tree, self.bits = tree, bits
        # Zeros and ones of a slot lie side by side and are looked up as one number.
        self._counts = [np.ascontiguousarray(table, dtype=np.float32).view(np.int64).reshape(-1) for table in counts]
        self._own = [np.zeros(len(table), dtype=np.int64) for table in counts]
        self._group, self._size = [], 0
        self._cases, self._held = np.zeros(_LEVELS**PREDICTORS, dtype=np.int32), 0

    def add(self, text: bytes) -> None:
        for part in segments(text):
            if self._group and self._size + len(part) > GROUP:
                self._flush()
            self._group.append(part)
            self._size += len(part)

    def _flush(self) -> None:
        found = Contexts(self._group, self.tree)
        order, runs, first, contexts = found.distinct(apart=True)
        length = found.length[first]
        ends = np.cumsum(length)
        steps = Steps(found.raw[first], length, ends, self.tree, self.bits)
        times = np.diff(runs, append=len(order)).take(steps.byte)
        taught = times << (steps.bit.astype(np.int64) << 5)
        # Segments stay in order, so the distinct bytes of each lie side by side.
        segment = np.searchsorted(found.starts, first, side="right") - 1
        bounds = np.concatenate([[0], ends])[np.searchsorted(segment, np.arange(len(found.starts) + 1))]
        cases = np.zeros(len(times), dtype=np.int64)
        side = (2 * steps.bit - 1).astype(np.int8)
        for k, (table, own, context) in enumerate(zip(self._counts, self._own, contexts)):
            slots = steps.slots_of(context, k)
            mine = np.empty(len(slots), dtype=np.int64)
            for low, high in zip(bounds[:-1], bounds[1:]):
                at = slots[low:high]
                np.add.at(own, at, taught[low:high])
                own.take(at, out=mine[low:high], mode="clip")
                own[at] = 0
            left = table.take(slots).view(np.float32).reshape(-1, 2)
            left -= mine.view(np.int32).reshape(-1, 2).astype(np.float32)
            np.maximum(left, 0, out=left)
            cases *= _LEVELS
            cases += stretched(left[:, 0], left[:, 1]) * side
            cases += _LEVELS // 2
        np.add.at(self._cases, cases, times.astype(np.int32))
        self._held += int(found.bounds[-1])
        self._group, self._size = [], 0

    def full(self) -> bool:
        return self._held > MOST_DECISIONS

    def taken(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """The counts so far, by the first logit: which cases were met, and how often. They begin anew."""
        if self._group:
            self._flush()
        for part, times in enumerate(self._cases.reshape(_LEVELS, -1)):
            if len(met := np.flatnonzero(times)):
                yield part, met.astype(np.uint16), times[met]
        self._cases[:], self._held = 0, 0


def _case_batch(part: int, source: int, cases: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array([part]), pa.array([source], pa.int64()), pa.array([cases.tobytes()]), pa.array([times.astype(np.int64).tobytes()])],
        names=["part", "source", "cases", "times"],
    )


def _cases(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judged = None
        source = TaskContext.get().partitionId()
        for batch in batches:
            for text in batch["text"]:
                judged = judged or Judged(*shared.value)
                judged.add(text.as_py() or b"")
                if judged.full():
                    yield from (_case_batch(part, source, *found) for part, *found in judged.taken())
        if judged:
            yield from (_case_batch(part, source, *found) for part, *found in judged.taken())

    return run


def _cases_added(table: pa.Table) -> pa.Table:
    total = np.zeros(_LEVELS ** (PREDICTORS - 1), dtype=np.int64)
    for cases, times in zip(table["cases"], table["times"]):
        total[np.frombuffer(cases.as_buffer(), dtype=np.uint16)] += np.frombuffer(times.as_buffer(), dtype=np.int64)
    met = np.flatnonzero(total)
    return pa.table(_case_batch(table["part"][0].as_py(), table["next"][0].as_py(), met.astype(np.uint16), total[met]))


def slopes(part: int, cases: np.ndarray, times: np.ndarray, weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Of counted cases with one first logit: the cost in nats of all their decisions, its gradient by the weights, and its
    second derivatives."""
    second, third = np.divmod(cases.astype(np.int64), _LEVELS)
    logits = [(x - _LEVELS // 2).astype(np.int8) for x in (np.full(len(cases), part), second, third)]
    x = gated(logits).astype(np.float64)
    odds = np.clip(weights @ x, -30, 30)
    wrong = 1 / (1 + np.exp(odds))
    cost = float((times * np.log1p(np.exp(-odds))).sum())
    return cost, -(x @ (times * wrong)), (x * (times * wrong * (1 - wrong))) @ x.T


def _slopes(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 + len(weights) + len(weights) ** 2)
        for batch in batches:
            for part, cases, times in zip(batch["part"], batch["cases"], batch["times"]):
                met = np.frombuffer(cases.as_buffer(), dtype=np.uint16), np.frombuffer(times.as_buffer(), dtype=np.int64)
                cost, gradient, second = slopes(part.as_py(), *met, weights)
                total += np.concatenate([[cost], gradient, second.reshape(-1)])
        yield pa.record_batch([pa.array(np.arange(len(total)), pa.int64()), pa.array(total)], names=["place", "value"])

    return run


def first_weights(cases: DataFrame) -> np.ndarray:
    """The weights with the least cost over all counted cases (part, cases, times), by Newton steps that are halved until the cost falls.

    A small pull towards ``PRIOR_WEIGHT`` decides weights that no case depends on.
    """
    start = np.array([PRIOR_WEIGHT] * PREDICTORS + [0.0] * PREDICTORS)

    def at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        total = np.zeros(1 + len(weights) + len(weights) ** 2)
        sums = cases.mapInArrow(_slopes(weights), "place bigint, value double").groupBy("place").agg(F.sum("value").alias("value"))
        for row in sums.collect():  # 43 rows
            total[row["place"]] = row["value"]
        away = weights - start
        second = total[1 + len(weights) :].reshape(len(weights), -1) + np.eye(len(weights))
        return total[0] + away @ away / 2, total[1 : 1 + len(weights)] + away, second

    weights = start
    cost, gradient, second = at(weights)
    step = -np.linalg.solve(second, gradient)
    for _ in range(MOST_ROUNDS):
        found = at(weights + step)
        if found[0] > cost:
            step = step / 2
            continue
        weights, gain = weights + step, cost - found[0]
        cost, gradient, second = found
        if gain <= LEAST_GAIN * cost:
            break
        step = -np.linalg.solve(second, gradient)
    return weights.astype(np.float32)


def _byte_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(256, dtype=np.int64)
    for batch in batches:
        for text in batch["text"]:
            for part in segments(text.as_py() or b""):
                counts += np.bincount(np.frombuffer(part, dtype=np.uint8), minlength=256)
    yield pa.record_batch([pa.array(np.arange(256), pa.int64()), pa.array(counts)], names=["byte", "n"])


class Counts:
    """The tables of a task: zeros and ones of every slot, side by side."""

    def __init__(self, tree: Tree, bits: int):
        self.tree, self.bits = tree, bits
        self.tables = [np.zeros(2 << b, dtype=np.int32) for b in table_bits(bits)]
        self._group, self._size = [], 0
        self._units: Counter = Counter()

    def add(self, text: bytes) -> None:
        for part in segments(text):
            self._group.append(bytes(_PAD) + part)
            self._size += len(part)
            units = _UNIT.findall(part)
            rest = len(part) - sum(map(len, units))
            self._units.update(units)
            if rest:  # a word that the segment cuts
                self._count(part[-rest:], None)
            if self._size >= PAIR_GROUP:
                self._flush_group()
            if len(self._units) >= 300_000:
                self._flush_units()

    def _flush_group(self) -> None:
        """Bytes with the two before each; equal ones are counted together."""
        raw = np.frombuffer(b"".join(self._group), dtype=np.uint8).astype(np.int32)
        triples = (raw[:-2] << 16) | (raw[1:-1] << 8) | raw[2:]
        sizes = np.array([len(part) for part in self._group])
        inner = np.ones(len(raw), dtype=bool)
        starts = np.cumsum(sizes) - sizes
        inner[(starts[:, None] + np.arange(_PAD)).reshape(-1)] = False
        triples, times = np.unique(triples[inner[_PAD:]], return_counts=True)
        raw = (triples & 0xFF).astype(np.uint8)
        length = self.tree.length[raw]
        steps = Steps(raw, length, np.cumsum(length), self.tree, self.bits)
        self._put(0, steps.slots_of((triples >> 8).astype(np.uint64), 0), steps.bit, times.take(steps.byte))
        self._group, self._size = [], 0

    def _flush_units(self) -> None:
        """Words one after the other: each ends with white space or the end, so contexts within words are theirs."""
        units, times = list(self._units), np.fromiter(self._units.values(), np.int64, len(self._units))
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        at = 0
        ends = np.cumsum(lengths)
        while at < len(units):
            stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 4 * GROUP, side="right")))
            self._count(b"".join(units[at:stop]), np.repeat(times[at:stop], lengths[at:stop]))
            at = stop
        self._units = Counter()

    def _count(self, part: bytes, by_byte: np.ndarray | None) -> None:
        found = Decisions([part], self.tree, self.bits)
        often = None if by_byte is None else np.repeat(by_byte, found.length[_PAD:])
        for predictor, slots in enumerate(found.within(), start=1):
            self._put(predictor, slots, found.bit, often)

    def _put(self, predictor: int, slots: np.ndarray, bit: np.ndarray, often: np.ndarray | None) -> None:
        table = self.tables[predictor]
        cells = 2 * slots + bit
        if often is not None:
            np.add.at(table, cells, often.astype(np.int32))
        elif len(cells) * 4 > len(table):
            np.add(table, np.bincount(cells, minlength=len(table)), out=table, casting="unsafe")
        else:
            np.add.at(table, cells, np.int32(1))

    def parts(self) -> list[np.ndarray]:
        """All tables in parts; a small table is one."""
        if self._group:
            self._flush_group()
        if self._units:
            self._flush_units()
        return [p for table in self.tables for p in np.split(table, max(1, len(table) >> (PART_SLOTS + 1)))]


def _tables(tree: Tree, bits: int):
    """Fill a task's tables; give them away in parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = None
        for batch in batches:
            for text in batch["text"]:
                counts = counts or Counts(tree, bits)
                counts.add(text.as_py() or b"")
        if counts:
            source = TaskContext.get().partitionId()
            for part, values in enumerate(counts.parts()):
                yield pa.record_batch(
                    [pa.array([part]), pa.array([source], pa.int64()), pa.array([values.astype(np.float32).tobytes()])],
                    names=["part", "source", "counts"],
                )

    return run


def _summed(table: pa.Table) -> pa.Table:
    total = None
    for counts in table["counts"]:
        values = np.frombuffer(counts.as_buffer(), dtype=np.float32)
        total = values.astype(np.float64) if total is None else total + values
    return pa.table({
        "part": table["part"].slice(0, 1), "source": table["next"].slice(0, 1),
        "counts": pa.array([total.astype(np.float32).tobytes()], pa.binary()),
    })


_PART_SCHEMA = "part bigint, source bigint, counts binary"


def _added(found: DataFrame, add, name: str) -> DataFrame:
    """What all tasks (``source``) found, added up by part, ``FAN_IN`` tasks at a time; a stored table again."""
    found = stored(found, name)
    sources = (found.agg(F.max("source")).first()[0] or 0) + 1
    while True:
        sources = math.ceil(sources / FAN_IN)
        grouped = found.withColumn("next", F.floor(F.col("source") / FAN_IN)).groupBy("part", "next")
        found = stored(grouped.applyInArrow(add, found.schema), name)
        if sources <= 1:
            return found


def _collected(tables: DataFrame, bits: int) -> list[np.ndarray]:
    """The sum of all tasks' tables, slots x 2 each; its size is bounded by the number of slots."""
    tables = _added(tables, _summed, "mixing-tables")
    sizes = [1 << b for b in table_bits(bits)]
    found = [[] for _ in sizes]
    of_part = [k for k, size in enumerate(sizes) for _ in range(max(1, size >> PART_SLOTS))]
    parts = {r["part"]: np.frombuffer(r["counts"], dtype=np.float32) for r in tables.select("part", "counts").toLocalIterator()}
    for part, k in enumerate(of_part):
        found[k].append(parts.get(part, np.zeros(2 << min(PART_SLOTS, table_bits(bits)[k]), dtype=np.float32)))
    return [np.concatenate(p).reshape(-1, 2) for p in found]


def train(learning: DataFrame, text_col: str = "text") -> MixingModel:
    """Learn tables and weights from all rows of ``learning``."""
    ship_package(learning.sparkSession)
    texts = learning.select(F.col(text_col).cast("string").cast("binary").alias("text"))
    counted = texts.mapInArrow(_byte_counts, "byte bigint, n bigint").groupBy("byte").agg(F.sum("n").alias("n"))
    counts = np.zeros(256, dtype=np.int64)
    for row in counted.collect():  # 256 rows
        counts[row["byte"]] = row["n"]
    tree = huffman(counts)
    bits = int(min(MOST_SLOTS, max(LEAST_SLOTS, math.ceil(math.log2(int(counts.sum()) + 1)))))
    slots = _collected(texts.mapInArrow(_tables(tree, bits), _PART_SCHEMA), bits)
    shared = learning.sparkSession.sparkContext.broadcast((tree, bits, slots))
    cases = texts.mapInArrow(_cases(shared), "part bigint, source bigint, cases binary, times binary")
    weights = first_weights(_added(cases, _cases_added, "mixing-cases"))
    shared.unpersist()
    return MixingModel(tree, bits, [stretched(s[:, 0], s[:, 1]) for s in slots], weights)


# Rows of documents (kind 0) and of the words of their chunk (kind 1).
TERM_SCHEMA = (
    "kind int, chunk bigint, id bigint, learns boolean, n_tokens bigint, n_bytes bigint, nats double, "
    "places binary, times binary, place int, word binary, n bigint"
)
_TERM_TYPES = [
    pa.int32(), pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(),
    pa.binary(), pa.binary(), pa.int32(), pa.binary(), pa.int64(),
]
_TERM_NAMES = [part.split()[0] for part in TERM_SCHEMA.split(", ")]


def _term_batch(rows: int, **columns) -> pa.RecordBatch:
    return pa.record_batch(
        [pa.array(columns.get(n, [None] * rows), t) for n, t in zip(_TERM_NAMES, _TERM_TYPES)], names=_TERM_NAMES
    )


def _scored(shared):
    """Score texts and count their words, chunk by chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        place_of: dict[bytes, int] = defaultdict(count().__next__)
        learned = np.zeros(1 << 16, dtype=np.int64)
        chunk = TaskContext.get().partitionId() << 32
        size = 0

        def words() -> Iterator[pa.RecordBatch]:
            names = list(place_of)
            for at in range(0, len(names), 1 << 16):
                part = names[at : at + (1 << 16)]
                yield _term_batch(
                    len(part), kind=[1] * len(part), chunk=[chunk] * len(part), word=part,
                    place=np.arange(at, at + len(part)), n=learned[at : at + len(part)],
                )

        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                part = batch.slice(at, 200)
                texts = [t.as_py() or b"" for t in part["text"]]
                learns = part["learns"].to_pylist()
                tokens, places, times = [], [], []
                for text, taught in zip(texts, learns):
                    found = text.lower().split()  # bytes are split at ASCII white space
                    counts = Counter(found)
                    own = np.fromiter(map(place_of.__getitem__, counts), np.int32, len(counts))
                    often = np.fromiter(counts.values(), np.uint32, len(counts))
                    while len(place_of) > len(learned):
                        learned = np.concatenate([learned, np.zeros_like(learned)])
                    if taught:
                        learned[own] += often  # each word once
                    order = np.argsort(own)
                    tokens.append(len(found) + 1)
                    # Steps between places are small numbers, which compress.
                    places.append(np.diff(own[order], prepend=np.int32(0)).tobytes())
                    times.append(often[order].tobytes())
                    size += len(text)
                yield _term_batch(
                    len(texts), kind=[0] * len(texts), chunk=[chunk] * len(texts), id=part["id"], learns=learns,
                    n_tokens=tokens, n_bytes=[len(t) for t in texts], nats=list(cost_of(texts, model)),
                    places=places, times=times,
                )
                if size >= CHUNK_BYTES or len(place_of) >= CHUNK_WORDS:
                    yield from words()
                    place_of = defaultdict(count().__next__)
                    learned, size, chunk = np.zeros_like(learned), 0, chunk + 1
        yield from words()

    return run


BASE_SCHEMA = (
    "id bigint, learns boolean, n_tokens bigint, n_known bigint, n_bytes bigint, nats double, base_score double"
)


def _based(total: int, distinct: int, ends: int):
    """Add up the base score of a chunk's documents from the totals of its words."""

    def run(documents: pa.Table, words: pa.Table) -> pa.Table:
        counts = np.zeros(words.num_rows + 1, dtype=np.int64)  # the end token comes last
        counts[words["place"].to_numpy()] = words["total"].to_numpy()
        counts[-1] = ends
        logs = np.log10((counts + 0.1) / (total + 0.1 * (distinct + 1)))
        known, base = [], []
        for places, times in zip(documents["places"], documents["times"]):
            at = np.cumsum(np.frombuffer(places.as_buffer(), dtype=np.int32))
            often = np.frombuffer(times.as_buffer(), dtype=np.uint32).astype(np.int64)
            known.append(int(often[counts[at] > 0].sum()) + (ends > 0))
            base.append(math.fsum((often * logs[at]).tolist()) + float(logs[-1]))
        return pa.table({
            "id": documents["id"], "learns": documents["learns"], "n_tokens": documents["n_tokens"],
            "n_known": pa.array(known, pa.int64()), "n_bytes": documents["n_bytes"], "nats": documents["nats"],
            "base_score": pa.array(base, pa.float64()),
        })

    return run


def score(docs: DataFrame, learns, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id_col, learns, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte.

    ``learns`` is a boolean column: the rows that counts and model are learned from; null is false. ``score`` is
    the model's log10 probability of the lower-cased text with its end, ``bits_per_byte`` the same per byte, the
    end counted as one. ``base_score`` is that of the words alone, by their add-0.1 frequency among the learned
    tokens (words between ASCII white space, A-Z lower-cased, and one end per document); ``n_known`` of the document's
    ``n_tokens`` are among these, ``train_tokens`` in all.

    A null text counts as empty; an empty one is its end. Repeated rows, and rows without an id, are scored each.
    Nothing to learn from leaves every decision even. Texts of any length are read whole, a segment at a time.
    An empty table gives none. Other columns are ignored, whatever their names.
    """
    spark = docs.sparkSession
    ship_package(spark)
    columns = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(learns, F.lit(False)).alias("learns"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )
    model = spark.sparkContext.broadcast(train(columns.filter("learns")))
    terms = columns.withColumn("text", F.col("text").cast("binary")).mapInArrow(_scored(model), TERM_SCHEMA)
    terms = stored(terms, "mixing-terms")
    words = terms.filter("kind = 1").select("chunk", "place", "word", "n", F.xxhash64("word").alias("hash"))
    same = Window.partitionBy("hash", "word")
    home = F.min(F.when(F.col("n") > 0, F.col("chunk"))).over(same)
    totals = stored(
        words.select(
            "chunk", "place", "n", F.sum("n").over(same).alias("total"),
            F.coalesce(F.col("chunk") == home, F.lit(False)).alias("is_home"),
        ),
        "mixing-totals",
    )
    tokens, distinct = totals.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count_if("is_home")).first()
    documents = terms.filter("kind = 0").select(
        "chunk", "id", "learns", "n_tokens", "n_bytes", "nats", "places", "times"
    )
    ends = documents.filter("learns").count()
    total = tokens + ends
    found = (
        documents.groupBy("chunk")
        .cogroup(totals.select("chunk", "place", "total").groupBy("chunk"))
        .applyInArrow(_based(total, distinct + (ends > 0), ends), BASE_SCHEMA)
    )
    return found.select(
        F.col("id").alias(id_col),
        "learns",
        "n_tokens",
        "n_known",
        F.lit(total).cast("bigint").alias("train_tokens"),
        "base_score",
        (-F.col("nats") / math.log(10)).alias("score"),
        (F.col("nats") / math.log(2) / (F.col("n_bytes") + 1)).alias("bits_per_byte"),
    )
