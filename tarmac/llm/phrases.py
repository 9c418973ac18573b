"""Repeated passages: find, compile and remove.

A window is a run of 50 words. Every word covered by a window that also starts in a document with a smaller
id is removed; windows are judged on the input.

1. Recurring anchors: of every window the 20-word run with the smallest hash is its anchor. Equal windows have
   equal anchors, so a window can recur only if its anchor is met in two documents. Documents with one
   word sequence are judged once, by their smallest id.
2. Confirmed windows: only windows over recurring anchors are hashed in full and grouped. A recurring window
   belongs to the smallest document that has it. Exclusive-or sums over its occurrences tell
   whether it is followed by the next window at every occurrence.
3. Passages: windows that always follow each other are joined, and each document writes out the passages
   that belong to it. Every occurrence of a window of a passage lies in an occurrence of the passage.
4. Automata: documents are dealt to blocks by their id. A block compiles the passages its documents can hold
   into one Aho-Corasick automaton over words and streams its documents through it. The automaton
   compares real words, so nothing is removed on a hash alone.

Blocks are sized by the passages' words, so an automaton is bounded and the work grows with the input:
no document is streamed through the passages of others. Counts of a very common passage are combined
in each task before the shuffle, and it is sent once to each block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import ahocorasick
import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.llm.common import keep_ids, shards, ship_package, stored
from tarmac.llm.hashing import windows, word_hashes

WINDOW = 50
ANCHOR = 20
# Words of the passages in one automaton, on average; a word takes about 100 bytes.
BLOCK_WORDS = 600_000
_STRIDE = 1 << 16

SCAN_SCHEMA = "id bigint, n_words bigint, sequence binary, anchors array<bigint>"
WINDOW_SCHEMA = "hash bigint, id bigint, pos bigint, is_first boolean"
PASSAGE_SCHEMA = "head bigint, first_id bigint, n_words bigint, passage binary"
REMOVED_SCHEMA = (
    "id bigint, n_removed bigint, kept_sha256 string, removed array<struct<start:bigint,stop:bigint>>"
)


def anchor_places(grams: np.ndarray, size: int) -> np.ndarray:
    """For each window, the place of its run with the smallest hash, the leftmost of equals."""
    count = len(grams) - size + 1
    if count <= 0:
        return np.empty(0, dtype=np.int64)
    out = np.empty(count, dtype=np.int64)
    for at in range(0, count, _STRIDE):
        part = grams[at : min(len(grams), at + _STRIDE + size - 1)]
        places = sliding_window_view(part, size).argmin(axis=1)
        out[at : at + len(places)] = places + np.arange(at, at + len(places))
    return out


def _scan(window: int, anchor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, anchors = [], [], []
            for text in batch["text"]:
                data = text.as_py() or b""
                hashes = word_hashes(data)[0]
                counts.append(len(hashes))
                digests.append(sha256(b" ".join(data.split())).digest())
                grams = windows(hashes, anchor)
                chosen = np.unique(anchor_places(grams, window - anchor + 1))
                anchors.append(np.unique(grams[chosen]).view(np.int64))
            yield pa.record_batch(
                [
                    batch["id"],
                    pa.array(counts, pa.int64()),
                    pa.array(digests, pa.binary()),
                    pa.array(anchors, pa.list_(pa.int64())),
                ],
                names=["id", "n_words", "sequence", "anchors"],
            )

    return run


def _gathered(parts: Iterator[tuple], names: list[str], rows: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """Record batches of about ``rows`` rows from parts, each a tuple of columns."""
    held, size = [], 0
    for part in parts:
        held.append(part)
        size += len(part[0])
        if size >= rows:
            yield _joined(held, names)
            held, size = [], 0
    if held:
        yield _joined(held, names)


def _joined(parts: list[tuple], names: list[str]) -> pa.RecordBatch:
    columns = []
    for column in zip(*parts, strict=True):
        if isinstance(column[0], list):
            columns.append(pa.array([x for c in column for x in c], pa.binary()))
        else:
            columns.append(pa.array(np.concatenate(column)))
    return pa.record_batch(columns, names=names)


def _candidate_windows(window: int, anchor: int):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                hashes = word_hashes(batch["text"][i].as_py())[0]
                grams = windows(hashes, anchor)
                places = anchor_places(grams, window - anchor + 1)
                recurring = batch["anchors"][i].values.to_numpy().view(np.uint64)
                pos = np.flatnonzero(np.isin(grams[places], recurring))
                ids = np.full(len(pos), batch["id"][i].as_py(), dtype=np.int64)
                found = windows(hashes, window)[pos].view(np.int64)
                is_first = np.zeros(len(pos), dtype=bool)
                is_first[np.unique(found, return_index=True)[1]] = True
                yield found, ids, pos.astype(np.int64), is_first

    return lambda batches: _gathered(parts(batches), ["hash", "id", "pos", "is_first"])


def _passages(window: int):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for i in range(batch.num_rows):
                own = batch["own"][i].values
                known = own.field("hash").to_numpy()
                order = np.argsort(known)
                known = known[order]
                here = own.field("here").to_numpy()[order]
                before = own.field("before").to_numpy()[order]
                data = batch["text"][i].as_py()
                hashes = windows(word_hashes(data)[0], window).view(np.int64)
                at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                is_own = known[at] == hashes
                joined = is_own[1:] & is_own[:-1] & (before[at[1:]] == here[at[:-1]])
                starts = np.flatnonzero(is_own & ~np.concatenate([[False], joined]))
                stops = np.flatnonzero(is_own & ~np.concatenate([joined, [False]])) + window
                words, heads = data.split(), hashes[starts]
                _, first = np.unique(heads, return_index=True)  # a passage may recur within its document
                yield (
                    heads[first],
                    np.full(len(first), batch["first_id"][i].as_py(), dtype=np.int64),
                    (stops - starts)[first].astype(np.int64),
                    [b" ".join(words[starts[k] : stops[k]]) for k in first],
                )

    names = ["head", "first_id", "n_words", "passage"]
    return lambda batches: _gathered(parts(batches), names, rows=2048)


class PassageAutomaton:
    """An Aho-Corasick automaton whose letters are words."""

    def __init__(self):
        self.vocabulary: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        self.first_ids: list[int] = []
        self.sizes: list[int] = []
        self.ready = False

    def add(self, passage: bytes, first_id: int) -> None:
        number = self.vocabulary
        words = tuple([number.setdefault(w, len(number) + 1) for w in passage.split()])
        self.automaton.add_word(words, len(self.sizes))
        self.first_ids.append(first_id)
        self.sizes.append(len(words))

    def covered(self, words: list[bytes], doc_id: int) -> np.ndarray:
        """Which words lie in a passage of a document with a smaller id."""
        marks = np.zeros(len(words) + 1, dtype=np.int64)
        if self.sizes:
            if not self.ready:
                self.automaton.make_automaton()
                self.ready = True
            get = self.vocabulary.get
            for end, which in self.automaton.iter(tuple([get(w, 0) for w in words])):
                if self.first_ids[which] < doc_id:
                    marks[end - self.sizes[which] + 1] += 1
                    marks[end + 1] -= 1
        return np.cumsum(marks[:-1]) > 0


def _stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by block, passages before documents."""
    block, automaton = None, None
    for batch in batches:
        ids, removed, digests, spans = [], [], [], []
        for i in range(batch.num_rows):
            if batch["block"][i].as_py() != block:
                block, automaton = batch["block"][i].as_py(), PassageAutomaton()
            text, doc_id = batch["text"][i].as_py(), batch["id"][i].as_py()
            if batch["kind"][i].as_py() == 0:
                automaton.add(text, doc_id)
                continue
            words = text.split()
            gone = automaton.covered(words, doc_id)
            edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(np.int8)))
            kept = b" ".join([words[k] for k in np.flatnonzero(~gone)])
            ids.append(doc_id)
            removed.append(int(gone.sum()))
            digests.append(sha256(kept).hexdigest())
            spans.append([{"start": int(a), "stop": int(b)} for a, b in edges.reshape(-1, 2)])
        span = pa.struct([("start", pa.int64()), ("stop", pa.int64())])
        yield pa.record_batch(
            [
                pa.array(ids, pa.int64()),
                pa.array(removed, pa.int64()),
                pa.array(digests, pa.string()),
                pa.array(spans, pa.list_(span)),
            ],
            names=["id", "n_removed", "kept_sha256", "removed"],
        )


def repeated_passages(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    anchor: int = ANCHOR,
    block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """One row per document: id, n_words, n_removed, kept_sha256, removed.

    Words are runs without ASCII white space, unchanged; null and empty texts have none. ``removed`` lists
    the removed spans as word positions [start, stop); ``kept_sha256`` is the digest of the kept words
    joined by one space. ``anchor`` must be less than ``window``.

    Repeated rows of one id are one document and returned each. A row without an id has no smaller
    document and is none: nothing is removed from it or for it. Other columns are ignored.
    """
    ship_package(docs.sparkSession)
    texts = docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.col(text_col).cast("string").cast("binary").alias("text"),
    )
    scanned = stored(texts.mapInArrow(_scan(window, anchor), SCAN_SCHEMA), "phrases-scan")
    sequences = (
        scanned.filter(f"n_words >= {window} and id is not null")
        .groupBy("sequence")
        .agg(F.min("id").alias("first_of_sequence"))
    )
    sequences = stored(sequences.withColumnRenamed("sequence", "known_sequence"), "phrases-sequences")
    first = (F.col("id") == F.col("first_of_sequence")) & (F.col("sequence") == F.col("known_sequence"))
    anchors = (
        scanned.join(sequences, first, "left_semi")
        .select("id", F.explode("anchors").alias("anchor"))
    )
    anchors = stored(anchors, "phrases-anchors")
    recurring = (
        anchors.groupBy("anchor")
        .agg(F.min("id").alias("low"), F.max("id").alias("high"))
        .filter("low < high")
        .select(F.col("anchor").alias("met"))
    )
    marks = stored(
        anchors.join(recurring, F.col("anchor") == F.col("met"), "left_semi")
        .groupBy("id")
        .agg(F.collect_set("anchor").alias("anchors")),
        "phrases-marks",
    )
    marked = stored(
        keep_ids(texts, marks, "id").dropDuplicates(["id"]).join(marks, "id"), "phrases-marked"
    )

    candidates = stored(
        marked.mapInArrow(_candidate_windows(window, anchor), WINDOW_SCHEMA), "phrases-windows"
    )
    confirmed = stored(
        candidates.groupBy("hash")
        .agg(
            F.min("id").alias("first_id"),
            F.max("id").alias("last_id"),
            F.bit_xor(F.xxhash64("id", "pos")).alias("here"),
            F.bit_xor(F.xxhash64("id", F.col("pos") - 1)).alias("before"),
        )
        .filter("first_id < last_id"),
        "phrases-confirmed",
    )
    owned = confirmed.groupBy("first_id").agg(
        F.collect_list(F.struct("hash", "here", "before")).alias("own")
    )
    passages = stored(
        marked.join(owned, F.col("id") == F.col("first_id"))
        .select("first_id", "text", "own")
        .mapInArrow(_passages(window), PASSAGE_SCHEMA),
        "phrases-passages",
    )

    heads = passages.select("head", "first_id", "n_words")
    routes = stored(
        # A window that a document repeats asks for its passage once.
        candidates.filter("is_first")
        .join(heads, (F.col("hash") == F.col("head")) & (F.col("id") > F.col("first_id")))
        .select("id", "head", "n_words")
        .distinct(),
        "phrases-routes",
    )
    blocks = shards(routes.agg(F.coalesce(F.sum("n_words"), F.lit(0))).first()[0], block_words)
    block = F.pmod(F.xxhash64("id"), F.lit(blocks))
    wanted = routes.select(block.alias("block"), F.col("head").alias("wanted")).distinct()
    compiled = passages.join(wanted, F.col("head") == F.col("wanted")).select(
        "block", F.lit(0).alias("kind"), F.col("first_id").alias("id"), F.col("passage").alias("text")
    )
    streamed = marked.join(routes.select(F.col("id").alias("routed")).distinct(), F.col("id") == F.col("routed"), "left_semi")
    streamed = streamed.select(block.alias("block"), F.lit(1).alias("kind"), "id", "text")
    removed = stored(
        compiled.unionByName(streamed)
        .repartition(blocks, "block")
        .sortWithinPartitions("block", "kind")
        .mapInArrow(_stream, REMOVED_SCHEMA),
        "phrases-removed",
    ).withColumnsRenamed({"id": "cut_id", "kept_sha256": "cut_sha256"})

    copy = F.col("id") > F.col("first_of_sequence")
    own_span = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("stop")))
    none = F.array().cast("array<struct<start:bigint,stop:bigint>>")
    return (
        scanned.drop("anchors")
        .join(sequences, F.col("sequence") == F.col("known_sequence"), "left")
        .join(removed, F.col("id") == F.col("cut_id"), "left")
        .select(
            F.col("id").alias(id_col),
            "n_words",
            F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
            F.when(copy, F.lit(sha256(b"").hexdigest()))
            .otherwise(F.coalesce("cut_sha256", F.lower(F.hex("sequence"))))
            .alias("kept_sha256"),
            F.when(copy, own_span).otherwise(F.coalesce("removed", none)).alias("removed"),
        )
    )


def kept_text(text: str | None, removed: list) -> str:
    """The kept words of a text joined by one space, given its removed spans."""
    words = (text or "").encode().split()
    gone = np.zeros(len(words), dtype=bool)
    for start, stop in removed:
        gone[start:stop] = True
    return b" ".join([w for w, g in zip(words, gone, strict=True) if not g]).decode()
