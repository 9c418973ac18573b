"""Language identification by error-correcting output codes.

Every language has a codeword of +1 and -1. For each bit, a linear classifier over hashed
character pairs and triples learns to tell the languages with +1 from those with -1. A text's
language is the codeword nearest to the classifiers' outputs: their logistic losses, weighted by
each bit's reliability in training, add up to the distance. A second codeword nearly as
near makes the answer ambiguous.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm.common import held_out, ship_package, stored

FEATURES = 1 << 13
# Bound of the learning sample: this many texts of all languages together.
SAMPLE_TEXTS = 2400
RIDGE = 0.02
SHARPNESS = 4.0
AMBIGUOUS_MARGIN = 0.2
UNKNOWN = "und"
_BLOCK = 1 << 18


@dataclass(frozen=True)
class LanguageModel:
    languages: list[str]
    codes: np.ndarray  # languages x bits, +1 or -1
    weights: np.ndarray  # features x bits
    reliability: np.ndarray  # per bit, sums to 1


def codewords(count: int) -> np.ndarray:
    """A code for ``count`` languages: all two-way splits up to six, else well-spread random words."""
    if count <= 6:
        columns = [
            [1, *rest] for rest in itertools.product([1, -1], repeat=count - 1) if -1 in rest
        ]
        return np.array(columns, dtype=np.float32).T.reshape(count, -1)
    rng = np.random.default_rng(count)
    bits = 10 * int(np.ceil(np.log2(count)))
    best, spread = None, -1
    for _ in range(50):
        codes = rng.choice(np.float32([1, -1]), (count, bits))
        near = np.min(((bits - codes @ codes.T) / 2)[~np.eye(count, dtype=bool)])
        split = np.all(np.abs(codes.sum(axis=0)) < count)
        if split and near > spread:
            best, spread = codes, near
    return best


def ngram_counts(text: str) -> np.ndarray:
    """Counts of the hashed character pairs and triples of the whole lower-case text."""
    counts = np.zeros(FEATURES, dtype=np.int64)
    text = f" {text.lower()} "
    shift = np.uint32(32 - FEATURES.bit_length() + 1)
    for at in range(0, len(text), _BLOCK):
        block = text[at : at + _BLOCK + 2]
        c = np.frombuffer(block.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        pair = c[:-1] * np.uint32(0x9E3779B1) + c[1:] * np.uint32(0x85EBCA77)
        triple = (pair[:-1] ^ (pair[:-1] >> np.uint32(15))) * np.uint32(0xC2B2AE3D) + c[
            2:
        ] * np.uint32(0x27D4EB2F)
        for grams, left in ((pair, 1), (triple, 0)):
            # The two characters a block shares with the next are counted there.
            own = grams[: max(0, min(len(grams), len(text) - at - (2 - left)))][:_BLOCK]
            own = (own ^ (own >> np.uint32(16))) * np.uint32(0x165667B1)
            counts += np.bincount(own >> shift, minlength=FEATURES)
    return counts


def features(text: str) -> np.ndarray:
    counts = ngram_counts(text)
    return np.sqrt(counts / counts.sum()).astype(np.float32)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs, where, values = [], [], []
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if has_letter(text):
                x = features(text)
                at = np.flatnonzero(x)
                langs.append(lang)
                where.append(at.astype("<i4").tobytes())
                values.append(x[at].astype("<f4").tobytes())
        yield pa.record_batch(
            [pa.array(langs, pa.string()), pa.array(where, pa.binary()), pa.array(values, pa.binary())],
            names=["lang", "at", "value"],
        )


def train(
    labelled: DataFrame, id_col: str = "doc_id", sample_texts: int = SAMPLE_TEXTS
) -> LanguageModel:
    """Learn from (id, text, lang) rows; rows without a label or text must be gone.

    Per language, the texts with the smallest hash of the id are taken, ``sample_texts`` of all
    languages together at most (but eight of each). Their features reach the driver.
    """
    ship_package(labelled.sparkSession)
    held = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    langs = sorted(held)
    if not langs:
        return LanguageModel([], np.ones((0, 0)), np.zeros((FEATURES, 0)), np.ones(0))
    each = max(8, sample_texts // len(langs))
    mixed = F.xxhash64(F.col(id_col).cast("string"))
    order = Window.partitionBy("lang").orderBy(mixed, id_col)
    # Twice the share that is needed goes into the ranking, so no task ranks a whole language.
    low = {lang: int((2 * min(1, (2 * each + 50) / held[lang]) - 1) * 2**63) for lang in langs}
    near = F.lit(False)
    for lang in langs:
        near = near | ((F.col("lang") == lang) & (mixed <= min(low[lang], 2**63 - 1)))
    chosen = stored(
        labelled.filter(near)
        .select("lang", id_col)
        .withColumn("_rank", F.row_number().over(order))
        .filter(F.col("_rank") <= each)
        .select(F.col(id_col).alias("_chosen")),
        "language-sample",
    )
    texts = labelled.join(F.broadcast(chosen), labelled[id_col] == chosen["_chosen"], "left_semi")
    rows = (
        texts.select("lang", "text")
        .mapInArrow(_sample_features, "lang string, at binary, value binary")
        .collect()
    )
    rows.sort(key=lambda r: (r["lang"], bytes(r["at"]), bytes(r["value"])))
    codes = codewords(len(langs))
    x = np.zeros((len(rows), FEATURES), dtype=np.float32)
    for i, row in enumerate(rows):
        x[i, np.frombuffer(row["at"], "<i4")] = np.frombuffer(row["value"], "<f4")
    index = {lang: i for i, lang in enumerate(langs)}
    target = codes[[index[r["lang"]] for r in rows]].astype(np.float64)
    del rows
    # Regularised least squares in its dual form: one small system for all bits.
    gram = (x @ x.T).astype(np.float64)
    gram[np.diag_indices_from(gram)] += RIDGE
    dual = np.linalg.solve(gram, target).astype(np.float32)
    del gram
    weights = x.T @ dual  # all single precision: no second copy of x
    wrong = np.mean((x @ weights) * target <= 0, axis=0)
    reliability = 1 - 2 * np.minimum(wrong, 0.49)
    return LanguageModel(langs, codes, weights, reliability / max(reliability.sum(), 1e-9))


def decode(model: LanguageModel, outputs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword, its score and the lead over the second, for each row of bit outputs."""
    margins = SHARPNESS * outputs[:, None, :] * model.codes[None, :, :]
    losses = np.logaddexp(0, -margins) @ model.reliability
    odds = np.exp(-SHARPNESS * (losses - losses.min(axis=1, keepdims=True)))
    odds /= odds.sum(axis=1, keepdims=True)
    top = np.sort(odds, axis=1)
    lead = top[:, -1] - (top[:, -2] if odds.shape[1] > 1 else 0)
    return odds.argmax(axis=1), top[:, -1], lead


def identify(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(id, lang_pred, score, ambiguous) for every row, from the text alone.

    A text that is null or has no letter, and any text when nothing was learned, is ``und`` with
    score 0. Ties go to the first language in order. Repeated rows are judged each; other columns
    are ignored.
    """
    ship_package(docs.sparkSession)
    languages = model.languages

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch["text"].to_pylist()
            known = [i for i, t in enumerate(texts) if t and languages and has_letter(t)]
            pred, score, unsure = [UNKNOWN] * len(texts), np.zeros(len(texts)), [False] * len(texts)
            for at in range(0, len(known), 256):
                part = known[at : at + 256]
                outputs = np.stack([features(texts[i]) for i in part]) @ model.weights
                best, odds, lead = decode(model, outputs)
                for i, b, o, m in zip(part, best, odds, lead, strict=True):
                    pred[i], score[i], unsure[i] = languages[b], o, bool(m < AMBIGUOUS_MARGIN)
            yield pa.record_batch(
                [batch["id"], pa.array(pred), pa.array(score), pa.array(unsure, pa.bool_())],
                names=schema.names,
            )

    ids = docs.select(id_col).schema[0].dataType
    schema = T.StructType(
        [
            T.StructField(id_col, ids),
            T.StructField("lang_pred", T.StringType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("ambiguous", T.BooleanType()),
        ]
    )
    columns = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return columns.mapInArrow(run, schema)


def learning_rows(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """Labelled rows with text that are not held out (crc32 of the id modulo 5 is not 0)."""
    return docs.filter(~held_out(id_col, 5, 0)).select(
        F.col(id_col), F.col(text_col).cast("string").alias("text"), F.col(lang_col).alias("lang")
    ).filter("lang is not null and text is not null")
