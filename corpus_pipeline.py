"""The corpus pipeline: documents to token ids in five stages.

Each stage takes what the one before kept, written as Parquet and read again, and works on
all of it. Every stage but the last returns the columns of its input. Columns of any other name pass
through. A row is known by ``doc_id`` and its text, so rows that share an id are judged each by its own text, and repeated
rows become one in the second stage; rows without an id are dropped only by the first stage. An empty table passes
through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import bpe, decontaminate, exact, language, minhash
from tarmac.llm.common import BROADCAST_IDS, matched_rows, stored
from tarmac.llm.queries import bpe_digests

# The similarity from which the near-duplicate stage links; the query op1 has its own threshold, 85.
NEAR_PERCENT = 80
# A text is rejected when its likeliest language has less than this share of the odds: it reads like none of them.
LEAST_SCORE = 0.3


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language: a null text, one without a letter, or one that is like no learned language.

    With nothing to learn from only the first two are dropped; they are whatever else is in the table.
    """
    spoken = docs.filter(F.coalesce(F.col("text").rlike("\\p{L}"), F.lit(False)))
    model = language.train(language.learning_rows(spoken))
    if not model.languages:
        return spoken
    # A key of its own for every text: ids may be missing, or name several texts.
    marked = spoken.select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    found = language.identify(marked, model)
    rejected = found.filter((F.col("score") < LEAST_SCORE) | (F.col("lang_pred") == language.UNKNOWN))
    rejected = stored(rejected.select("doc_id"), "pipeline-language")
    return spoken.join(_few(rejected), F.xxhash64("doc_id", "text") == F.col("_key"), "left_anti")


def _few(keys: DataFrame) -> DataFrame:
    """Keys (a stored table) for an anti join: broadcast where they are few, else shuffled."""
    keys = keys.select(F.col("doc_id").alias("_key"))
    return F.broadcast(keys) if keys.count() <= BROADCAST_IDS else keys


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the largest doc_id of equal texts, and of repeated rows one."""
    found = stored(exact.exact_duplicates(docs), "pipeline-exact")
    digest = {"text_sha256": F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)}
    dropped = found.filter("not kept").select("doc_id", "text_sha256")
    kept = matched_rows(docs, dropped, digest, "left_anti")
    rows = found.filter("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n"))
    repeated = stored(rows.filter("n > 1").select("doc_id", "text_sha256"), "pipeline-repeated")
    if repeated.isEmpty():
        return kept
    again = matched_rows(kept, repeated, digest, "left_semi").withColumns(digest)
    again = again.dropDuplicates(["doc_id", "text_sha256"]).drop("text_sha256")
    return matched_rows(kept, repeated, digest, "left_anti").unionByName(again)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the smallest doc_id of each component of near duplicates: similarity 0.80 or more over five words.

    Of rows that share an id, the text with the smallest hash is judged for it; the others stay.
    """
    mark = {"text_hash": F.xxhash64("text")}
    texts = docs.select("doc_id", mark["text_hash"].alias("text_hash")).groupBy("doc_id")
    shared = texts.agg(F.count("*").alias("n"), F.min("text_hash").alias("text_hash")).filter("n > 1")
    shared = stored(shared.select("doc_id", "text_hash"), "pipeline-shared-ids")
    judged = docs
    if not shared.isEmpty():
        others = matched_rows(docs, shared.select("doc_id"), {}, "left_semi")
        others = matched_rows(others, shared, mark, "left_anti").select("doc_id", mark["text_hash"].alias("text_hash"))
        judged = matched_rows(docs, stored(others, "pipeline-other-texts"), mark, "left_anti")
    found = minhash.near_duplicates(judged, percent=NEAR_PERCENT).filter("not kept").select("doc_id", "text_hash")
    return matched_rows(docs, stored(found, "pipeline-near"), mark, "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = docs.filter("doc_id is not null").select(F.xxhash64("doc_id", "text").alias("doc_id"), "text")
    found = stored(decontaminate.contaminated(marked, benchmark).select("doc_id").distinct(), "pipeline-leaks")
    return docs.join(_few(found), F.xxhash64("doc_id", "text") == F.col("_key"), "left_anti")


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lengths and digests of the ids and of the text they decode to."""
    return bpe_digests(bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

# Classifiers, hashing and BPE are beyond SQL: tests/llm/test_pipeline.py compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
