"""Helpers the operators share: stored intermediates, held-out rows, checked semi joins."""

from __future__ import annotations

import functools
import io
import math
import os
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import tarmac
from tarmac.session import scratch_path

# Ids are broadcast up to this many (a hashed long takes about 32 bytes, so 16 MB at most).
BROADCAST_IDS = 500_000


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    """Write a small file wherever Spark can write."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target)
    out.write(bytearray(data))
    out.close()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package wherever they run; once per application."""
    _ship(spark, spark.sparkContext.applicationId)


@functools.lru_cache(maxsize=1)
def _ship(spark: SparkSession, application_id: str) -> None:
    root = os.path.dirname(os.path.abspath(tarmac.__file__))
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    archive.write(path, os.path.relpath(path, os.path.dirname(root)))
    target = scratch_path(spark, "package") + "/tarmac.zip"
    write_bytes(spark, target, packed.getvalue())
    spark.sparkContext.addPyFile(target)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a DataFrame to the shared scratch folder and read it back: lineage ends here."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(column: str) -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of the id written in decimal, modulo ``modulus``; null for a null id."""
    return (F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus).cast("int")


def held_out(id_col: str, modulus: int, value: int) -> Column:
    """Whether a row is outside the learning rows. A row without an id is held out."""
    return F.coalesce(remainder(id_col, modulus) == value, F.lit(True))


def shards(rows: int, per_shard: int) -> int:
    return max(1, math.ceil(rows / per_shard))


def _narrow(ids: DataFrame, id_col: str) -> DataFrame:
    ids = ids.select(F.col(id_col).alias("_id")).filter("_id is not null")
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def keep_ids(docs: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Rows whose id is among ``ids`` (a stored table). Few ids are broadcast, more are shuffled."""
    ids = _narrow(ids, id_col)
    return docs.join(ids, docs[id_col] == ids["_id"], "left_semi")


def matched_rows(docs: DataFrame, keys: DataFrame, marks: dict[str, Column], how: str, id_col: str = "doc_id") -> DataFrame:
    """Rows that are (``left_semi``) or are not (``left_anti``) among ``keys``, a stored table, by id and marks.

    ``marks`` has an expression over ``docs`` for every other column of ``keys``, so that rows which share an
    id are told apart by their text. A row without an id is never among the keys. Few keys are broadcast,
    more are shuffled.
    """
    given = keys.select(*(F.col(c).alias(f"_key_{c}") for c in [id_col, *marks])).filter(F.col(f"_key_{id_col}").isNotNull())
    if given.count() <= BROADCAST_IDS:
        given = F.broadcast(given)
    same = docs[id_col] == given[f"_key_{id_col}"]
    for name, mark in marks.items():
        same = same & mark.eqNullSafe(given[f"_key_{name}"])
    return docs.join(given, same, how)
