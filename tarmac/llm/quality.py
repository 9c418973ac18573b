"""Quality scores by histogram gradient-boosted trees over document statistics.

Statistics of the whole text are put into quantile bins. Each boosting round fits a tree of fixed depth to the
logistic loss, choosing splits from sums of gradients per bin. A trained forest is three flat arrays
(feature, threshold, leaf value); a batch of documents walks all trees in lockstep with numpy.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import held_out, ship_package, stored
from tarmac.llm.hashing import windows, word_hashes

# Bound of the learning sample: about this many labelled rows, chosen by the hash of their id.
SAMPLE_ROWS = 20_000
BINS = 48
DEPTH = 4
ROUNDS = 80
LEARNING_RATE = 0.15
LEAST_HESSIAN = 3.0
SHRINKAGE = 2.0

_SYMBOLS = b"#*&$%!|@<>{}=_~^"
NAMES = [
    "log_bytes", "log_words", "mean_word", "deviation_word", "longest_word", "upper", "lower", "digit", "space",
    "punctuation", "other_bytes", "symbols", "pipes", "exclamations", "full_stops", "commas", "byte_entropy",
    "capital_words", "shouted_words", "symbol_ended_words", "distinct_words", "top_word", "repeated_neighbours",
    "distinct_pairs", "words_per_line", "distinct_lines", "short_words",
]


def _kinds() -> np.ndarray:
    kinds = np.zeros((256, 6), dtype=np.float64)
    for b in range(256):
        c = chr(b)
        kinds[b] = [
            65 <= b <= 90, 97 <= b <= 122, 48 <= b <= 57, c in " \t\n\r\x0b\x0c",
            33 <= b <= 126 and not c.isalnum(), b >= 128,
        ]
    return kinds


_KINDS = _kinds()
_UPPER, _LOWER = _KINDS[:, 0] > 0, _KINDS[:, 1] > 0
_IS_SYMBOL = np.zeros(256, dtype=bool)
_IS_SYMBOL[list(_SYMBOLS)] = True


def statistics(data: bytes) -> np.ndarray:
    """The statistics of a UTF-8 text, in the order of ``NAMES``; all zero for an empty text."""
    out = np.zeros(len(NAMES))
    if not data:
        return out
    raw = np.frombuffer(data, dtype=np.uint8)
    counts = np.bincount(raw, minlength=256)
    size = len(raw)
    share = counts / size
    present = share[share > 0]
    hashes, starts, ends = word_hashes(data)
    out[0] = np.log1p(size)
    out[5:11] = share @ _KINDS
    out[11] = share[_IS_SYMBOL].sum()
    out[12:16] = share[[ord("|"), ord("!"), ord("."), ord(",")]]
    out[16] = -(present * np.log2(present)).sum()
    words = len(hashes)
    if not words:
        return out
    lengths = ends - starts
    first, last = raw[starts], raw[ends - 1]
    upper = np.concatenate([[0], np.cumsum(_UPPER[raw])])
    lower = np.concatenate([[0], np.cumsum(_LOWER[raw])])
    shouted = (upper[ends] - upper[starts] > 1) & (lower[ends] == lower[starts])
    _, times = np.unique(hashes, return_counts=True)
    out[1] = np.log1p(words)
    out[2], out[3], out[4] = lengths.mean(), lengths.std(), lengths.max()
    out[17], out[18] = _UPPER[first].mean(), shouted.mean()
    out[19] = _IS_SYMBOL[last].mean()
    out[20], out[21] = len(times) / words, times.max() / words
    if words > 1:
        out[22] = (hashes[1:] == hashes[:-1]).mean()
        pairs = windows(hashes, 2)
        out[23] = len(np.unique(pairs)) / len(pairs)
    lines = [line for line in data.split(b"\n") if line.strip()]
    out[24], out[25] = words / max(1, len(lines)), len(set(lines)) / max(1, len(lines))
    out[26] = (lengths <= 3).mean()
    return out


@dataclass(frozen=True)
class Forest:
    """Complete trees of one depth as flat arrays: inner nodes breadth first, then leaf values."""

    base: float
    feature: np.ndarray  # trees x (2^depth - 1)
    threshold: np.ndarray  # trees x (2^depth - 1)
    leaf: np.ndarray  # trees x 2^depth

    def margins(self, x: np.ndarray) -> np.ndarray:
        trees, inner = self.feature.shape
        total = np.full(len(x), self.base)
        if not trees:
            return total
        tree = np.arange(trees)[None, :]
        row = np.arange(len(x))[:, None]
        node = np.zeros((len(x), trees), dtype=np.int64)
        while node[0, 0] < inner:
            right = x[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        return total + self.leaf[tree, node - inner].sum(axis=1)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def _best_splits(sums: np.ndarray, hessians: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node, the feature and bin of the best split and its gain, from (node, feature, bin) sums."""
    left_g, left_h = sums.cumsum(axis=2), hessians.cumsum(axis=2)
    all_g, all_h = left_g[:, :1, -1:], left_h[:, :1, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + SHRINKAGE) + right_g**2 / (right_h + SHRINKAGE)
    gain -= all_g**2 / (all_h + SHRINKAGE)
    gain[(left_h < LEAST_HESSIAN) | (right_h < LEAST_HESSIAN)] = -np.inf
    flat = gain.reshape(len(gain), -1)
    best = flat.argmax(axis=1)
    return best // gain.shape[2], best % gain.shape[2], flat[np.arange(len(flat)), best]


def boost(x: np.ndarray, y: np.ndarray, rounds: int = ROUNDS, depth: int = DEPTH) -> Forest:
    """Fit a forest to labels 0 and 1. Without rows of both labels it is a constant."""
    inner, leaves = 2**depth - 1, 2**depth
    rate = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(rate / (1 - rate)))
    if not 0 < y.sum() < len(y):
        empty = np.zeros((0, inner))
        return Forest(base, empty.astype(np.int64), empty, np.zeros((0, leaves)))
    features = x.shape[1]
    cuts = [np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)) for f in range(features)]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], axis=1)
    cell = binned + np.arange(features) * BINS
    margin = np.full(len(y), base)
    feature = np.zeros((rounds, inner), dtype=np.int64)
    threshold = np.full((rounds, inner), np.inf)
    leaf = np.zeros((rounds, leaves))
    for k in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, hessian = y - p, p * (1 - p)
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            spot = ((node - first)[:, None] * (features * BINS) + cell).ravel()
            shape = (count, features, BINS)
            size = count * features * BINS
            sums = np.bincount(spot, np.repeat(gradient, features), size).reshape(shape)
            weights = np.bincount(spot, np.repeat(hessian, features), size).reshape(shape)
            chosen, at, gain = _best_splits(sums, weights)
            for i in np.flatnonzero(gain > 1e-6):
                if at[i] < len(cuts[chosen[i]]):
                    feature[k, first + i] = chosen[i]
                    threshold[k, first + i] = cuts[chosen[i]][at[i]]
            right = x[np.arange(len(x)), feature[k, node]] > threshold[k, node]
            node = 2 * node + 1 + right
        end = node - inner
        total = np.bincount(end, gradient, leaves)
        weight = np.bincount(end, hessian, leaves)
        leaf[k] = LEARNING_RATE * total / (weight + SHRINKAGE)
        margin += leaf[k, end]
    return Forest(base, feature, threshold, leaf)


def _labelled_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [statistics(t.as_py() or b"").tolist() for t in batch["text"]]
        yield pa.record_batch(
            [batch["id"], pa.array(rows, pa.list_(pa.float64())), batch["label"]],
            names=["id", "x", "label"],
        )


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> Forest:
    """Learn from labelled documents that are not held out (crc32 of the id modulo 3 is not 1).

    Labels other than 0 and 1, and ids whose labels disagree, are not learned from. Beyond about ``sample_rows``
    labelled ids, those with the smallest hash are taken; their statistics reach the driver.
    """
    ship_package(docs.sparkSession)
    sure = (
        labels.select(F.col(id_col).alias("key"), F.col(label_col).cast("int").alias("label"))
        .filter("label in (0, 1) and key is not null")
        .filter(~held_out("key", 3, 1))
        .groupBy("key")
        .agg(F.min("label").alias("label"), F.max("label").alias("high"))
        .filter("label = high")
        .select("key", "label")
    )
    share = min(1.0, sample_rows / max(1, sure.count()))
    mixed = F.xxhash64(F.col("key").cast("string"))
    chosen = stored(sure.filter(mixed <= min(2**63 - 1, int((2 * share - 1) * 2**63))), "quality-labels")
    joined = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")
    ).join(F.broadcast(chosen), F.col("id") == F.col("key"))  # about sample_rows rows
    rows = (
        joined.select(F.col("id").cast("string").alias("id"), "text", "label")
        .mapInArrow(_labelled_statistics, "id string, x array<double>, label int")
        .collect()
    )
    rows.sort(key=lambda r: (r["id"], r["x"]))
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(NAMES))
    return boost(x, np.array([r["label"] for r in rows], dtype=np.float64))


def score(
    docs: DataFrame, forest: Forest, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, score, predicted) for every row, from the whole text alone.

    The score is the chance of label 1; predicted is 1 from 0.5 on. Null counts as empty, and empty texts get the
    score of their (zero) statistics. Repeated rows are scored each; other columns are ignored.
    """
    ship_package(docs.sparkSession)
    kind = docs.select(id_col).schema[0].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, kind),
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t.as_py() or b"") for t in batch["text"]]
            x = np.stack(rows) if rows else np.zeros((0, len(NAMES)))
            scores = np.concatenate(
                [np.zeros(0), *(forest.scores(x[at : at + 2048]) for at in range(0, len(x), 2048))]
            )
            yield pa.record_batch(
                [batch["id"], pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                names=schema.names,
            )

    columns = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text")
    )
    return columns.mapInArrow(run, schema)
