"""One registered query per operator, over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.llm import bpe, conversation, decontaminate, exact, language, minhash, mixing, phrases, quality, recompression, secrets, urls, warc
from tarmac.llm.common import held_out

_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    _REGISTRY[function.__name__] = function
    return function


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_minhash_dedup(spark, sf):
    return minhash.near_duplicates(table(spark, sf, "documents"))


@query
def op2_decontaminate(spark, sf):
    return decontaminate.contaminated(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op3_repeated_passages(spark, sf):
    return phrases.repeated_passages(table(spark, sf, "documents")).drop("removed")


@query
def op4_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    model = language.train(language.learning_rows(docs))
    found = language.identify(docs, model)
    return found.select("doc_id", held_out("doc_id", 5, 0).alias("held_out"), "lang_pred", "score", "ambiguous")


def bpe_digests(coded: DataFrame) -> DataFrame:
    """Lengths and digests of ids and decoded text."""
    ids = F.concat_ws(",", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op5_bpe_round_trip(spark, sf):
    docs = table(spark, sf, "documents")
    return bpe_digests(bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json")))


@query
def op6_quality(spark, sf):
    docs = table(spark, sf, "documents")
    forest = quality.train(docs, table(spark, sf, "labels"))
    scored = quality.score(docs, forest)
    return scored.select("doc_id", held_out("doc_id", 3, 1).alias("held_out"), "score", "predicted")


@query
def op7_url_filter(spark, sf):
    return urls.judge(table(spark, sf, "pages"))


@query
def op8_exact_dedup(spark, sf):
    return exact.exact_duplicates(table(spark, sf, "documents"))


@query
def op9_secret_scan(spark, sf):
    return secrets.scan(table(spark, sf, "documents"))


@query
def op10_warc(spark, sf):
    captures = warc.archive_and_index(table(spark, sf, "pages"))
    return captures.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op11_context_mixing(spark, sf):
    scored = mixing.score(table(spark, sf, "documents"), ~held_out("doc_id", 10, 0))
    return scored.withColumn("learns", ~F.col("learns")).withColumnRenamed("learns", "held_out")


def with_planted_periods(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten, by the crc32 of its id, has words repeated with one period from some place on."""
    words = F.filter(F.split("text", "[\\x20\\x09-\\x0D]+"), lambda w: w != "")
    n = F.greatest(F.size(words), F.lit(1)).cast("bigint")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    a = g % n
    p = F.floor((n - a) / (3 + g % 8)) + 1
    at, period, left = (a + 1).cast("int"), p.cast("int"), (n - a).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, at, period), F.ceil(left / period).cast("int")))
    planted = F.concat(F.slice(words, F.lit(1), at - 1), F.slice(again, F.lit(1), left))
    chosen = (h % 10 == 0) & (F.size(words) > 0)
    return docs.withColumn("text", F.when(chosen, F.array_join(planted, " ")).otherwise(F.col("text")))


@query
def op12_periodic_runs(spark, sf):
    found = recompression.periodic_runs(with_planted_periods(table(spark, sf, "documents")))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    text = F.array_join(F.transform(lines, lambda line: F.concat(line, F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(
        "doc_id",
        "n_words",
        F.size("runs").cast("bigint").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).alias("exponent_milli"),
        F.sha2(text.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults, chosen by the crc32 of ``conv_id:turn``; ``copies`` is 0, 1 or 2."""
    turn = F.concat(*[F.coalesce(c, F.lit(" ")) for c in (F.col("conv_id").cast("string"), F.lit(":"), F.col("turn").cast("string"))])
    kind = F.crc32(turn.cast("binary")) % 20
    text = F.coalesce("text", F.lit(" "))
    return turns.select(
        "conv_id",
        "turn",
        F.when(kind == 4, "user").otherwise(F.coalesce("role", F.lit(" "))).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"),
    )


@query
def op13_conversation_repair(spark, sf):
    return conversation.repair(damaged(table(spark, sf, "conversations")), copies_col="copies")
