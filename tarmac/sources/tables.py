"""Tables by path. The format is a parameter; Parquet is the default."""

from __future__ import annotations

import contextlib
import math
from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.session import released_shuffles, scratch_path
from tarmac.sources import drift, files
from tarmac.sources.layout import interleaved

PARTITIONS = ("year", "month")
CLUSTER_BY = ("airline_code", "origin_code")
RANGE_BYTES = 64 << 20
# What the rows of one range take in memory while they are sorted, about.
SORT_BYTES = 128 << 20
# Bytes of a stored copy whose rows are shuffled at a time, about: what a shuffle of all rows would have on disk at once.
BATCH_BYTES = 3 << 30
_CURVE = "_curve"
_OVERWRITE = {"table": "static", "partitions": "dynamic"}


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The table at ``path``, with the schema that lies beside it if there is one (``drift``)."""
    schema = drift.stored_schema(spark, path)
    reader = spark.read.format(fmt)
    return (reader.schema(schema) if schema else reader).load(path)


def table_exists(spark: SparkSession, path: str) -> bool:
    """Whether there is anything at a path, wherever Spark can reach."""
    return files.exists(spark, path)


def read_query(spark: SparkSession, query: str, fmt: str = "jdbc", **options) -> DataFrame:
    """What a serving database answers to a query, through its Spark connector.

    The connector's jar and its connection options are up to the session. Not covered by a test: that takes a
    server; ``serving.query_export`` asks the exported files instead.
    """
    return spark.read.format(fmt).options(**options).option("query", query).load()


def read_months(
    spark: SparkSession,
    path: str,
    first: tuple[int, int],
    last: tuple[int, int],
    fmt: str = "parquet",
) -> DataFrame:
    """The rows from one (year, month) to another, reading only those partitions.

    The bounds are on the partition columns: a filter on ``flight_year`` or on
    the date would read every partition.
    """
    (y1, m1), (y2, m2) = first, last
    year, month = F.col("year"), F.col("month")
    after = (year > y1) | ((year == y1) & (month >= m1))
    before = (year < y2) | ((year == y2) & (month <= m2))
    return read_table(spark, path, fmt).filter(year.between(y1, y2) & after & before)


def in_months(df: DataFrame, months: Sequence[tuple]) -> DataFrame:
    """The rows of some (year, month) partitions, reading only those; None stands for a missing one."""
    wanted = F.lit(False)
    for values in months:
        parts = [
            F.col(c).isNull() if v is None else F.col(c) == v for c, v in zip(PARTITIONS, values)
        ]
        wanted = wanted | (parts[0] & parts[1])
    return df.filter(wanted)


def partition_folder(path: str, values: Sequence, partitions: Sequence[str] = PARTITIONS) -> str:
    parts = (f"{c}={'__HIVE_DEFAULT_PARTITION__' if v is None else v}" for c, v in zip(partitions, values))
    return "/".join([path.rstrip("/"), *parts])


def write_table(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Replace the table at ``path``."""
    with released_shuffles(df.sparkSession):
        df.write.format(fmt).mode("overwrite").save(path)


@contextlib.contextmanager
def stored_apart(df: DataFrame, name: str) -> Iterator[tuple[DataFrame, int]]:
    """``df`` stored in the shared folder and read back, and its bytes there; deleted in the end. Shuffles do not outlast their
    queries meanwhile."""
    spark = df.sparkSession
    copy = scratch_path(spark, name)
    with released_shuffles(spark):
        try:
            df.write.parquet(copy)
            size = spark.read.format("binaryFile").load(copy).agg(F.sum("length")).first()[0]
            yield spark.read.schema(df.schema).parquet(copy), size or 0
        finally:
            files.delete(spark, copy)


def _batches(rows: DataFrame, partitions: Sequence[str], size: int, batch_bytes: int) -> list[tuple[DataFrame, int]]:
    """Stored rows of ``size`` bytes, and their number, in batches of about ``batch_bytes``. A batch has whole partitions: those
    from one to another in their order, nulls first, or a single larger one."""
    if size <= batch_bytes:
        return [(rows, rows.count())]
    counts = rows.groupBy(*partitions).agg(F.count("*").alias("_rows")).orderBy(*partitions).collect()
    most = sum(r["_rows"] for r in counts) * batch_bytes / size
    groups, held = [], most
    for row in counts:
        if held + row["_rows"] > most:
            groups.append([])
            held = 0
        groups[-1].append(row)
        held += row["_rows"]
    place = F.struct(*partitions)

    def bound(row):
        return F.struct(*(F.lit(row[c]).cast(rows.schema[c].dataType).alias(c) for c in partitions))

    return [
        (rows.filter((place >= bound(found[0])) & (place <= bound(found[-1]))), sum(r["_rows"] for r in found))
        for found in groups
    ]


def _save(df: DataFrame, path: str, partitions: Sequence[str], fmt: str, replace: str, **options) -> None:
    """Write rows below ``path``; ``replace`` is that of ``write_partitioned``."""
    writer = df.write.format(fmt).options(**options).partitionBy(*partitions)
    with released_shuffles(df.sparkSession):
        if replace == "nothing":
            writer.mode("append").save(path)
            return
        (
            writer.mode("overwrite")
            .option("overwriteSchema", "true")
            .option("partitionOverwriteMode", _OVERWRITE[replace])
            .save(path)
        )


def _then(replace: str) -> str:
    """How the batches after the first are written."""
    return "nothing" if replace == "table" else replace


def write_partitioned(
    df: DataFrame,
    path: str,
    partitions: Sequence[str] = PARTITIONS,
    fmt: str = "parquet",
    replace: str = "table",
    gather: bool = True,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    copied: Callable[[], None] | None = None,
    batch_bytes: int = BATCH_BYTES,
) -> None:
    """Write a table partitioned by year and month.

    ``replace="table"`` overwrites everything, schema included;
    ``replace="partitions"`` overwrites just the partitions the rows belong to,
    so writing a batch again leaves the table as it is; ``replace="nothing"``
    appends. Rebalancing gives each
    partition few files of even size, and a very large one several. ``gather=False`` leaves that out, for rows that lie by
    partition already: every task writes what it reads.

    ``finish`` makes rows wide, each on its own and in place, once they are gathered. The narrow rows are then stored in the
    shared folder first and gathered from there, some partitions at a time (about ``batch_bytes`` of the copy), so the disk that
    shuffles take is bounded; a table that is replaced has its first partitions while the others are still written.
    ``copied`` is called once they are stored: what they were made from is read no more.
    """
    if finish is None:
        _save(df.hint("rebalance", *partitions) if gather else df, path, partitions, fmt, replace)
        return
    with stored_apart(df, "gathered") as (rows, size):
        if copied:
            copied()
        for batch, _ in _batches(rows, partitions, size, batch_bytes):
            gathered = batch.hint("rebalance", *partitions) if gather else batch
            _save(finish(gathered.sortWithinPartitions(*partitions)), path, partitions, fmt, replace)
            replace = _then(replace)


def write_clustered(
    df: DataFrame,
    path: str,
    cluster_by: Sequence[str] = CLUSTER_BY,
    partitions: Sequence[str] = PARTITIONS,
    spread_by: Sequence[str] = ("FlightDate", "Flight_Number_Reporting_Airline"),
    fmt: str = "parquet",
    range_bytes: int = RANGE_BYTES,
    replace: str = "table",
    months: Sequence[tuple] = (),
    interleave: bool = False,
    finish: Callable[[DataFrame], DataFrame] | None = None,
    sort_bytes: int = SORT_BYTES,
    copied: Callable[[], None] | None = None,
    batch_bytes: int = BATCH_BYTES,
    **options,
) -> None:
    """Write a partitioned table whose files each cover a narrow range of the
    clustering columns, so that a filter on them skips files and row groups.

    The rows are stored once in the shared folder: sampling the range bounds and
    sorting then read the copy and do not compute the rows again, and the table may
    be written from itself. The copy is deleted in the end. There is a range
    per ``range_bytes`` of the copy, or more where their rows would take over ``sort_bytes`` in memory: a task sorts
    no more than that, however large the table and well compressed the copy. ``finish`` makes rows wide, each on its own
    and in place: it is applied when they are in order, so that the copy, shuffle and sort are of the narrow rows. Ranges end with ``spread_by``, which lets one
    very frequent airline and origin be cut over several tasks. With ``interleave`` rows
    lie along a curve through all clustering columns (``layout.interleaved``), so that a filter on any of them
    skips files, where the plain order serves the first. Some partitions are laid out at a time, as ``write_partitioned`` does with
    ``finish``, and ``copied`` is called as there. ``replace="partitions"`` overwrites just
    the partitions the rows belong to, and empties those of ``months`` that have none any more. ``options`` go to
    the writer, for formats that keep statistics of their own.
    """
    spark = df.sparkSession
    with stored_apart(df, "clustered") as (rows, size):
        if copied:
            copied()
        order = list(cluster_by)
        if interleave:
            # A column of its own: sorting would compute the expression for both sides of every comparison.
            rows = rows.withColumn(_CURVE, interleaved(rows, cluster_by))
            order = [_CURVE, *order]
        batches = _batches(rows, partitions, size, batch_bytes)
        total = sum(n for _, n in batches)
        for batch, n in batches:
            share = size * n / total if total else 0
            ranges = max(1, math.ceil(share / range_bytes), math.ceil(n * _row_bytes(rows) / sort_bytes))
            laid_out = batch.repartitionByRange(ranges, *partitions, *order, *spread_by)
            laid_out = laid_out.sortWithinPartitions(*partitions, *order).drop(_CURVE)
            _save(finish(laid_out) if finish else laid_out, path, partitions, fmt, replace, **options)
            replace = _then(replace)
        if months:
            left = {tuple(r) for r in rows.select(*partitions).distinct().collect()}
            for emptied in set(map(tuple, months)) - left:
                files.delete(spark, partition_folder(path, emptied, partitions))


def _row_bytes(df: DataFrame) -> int:
    """What a row takes while it is sorted, about: a word for every column, and some for what has no fixed size."""
    fixed = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)
    return 32 + sum(8 if isinstance(f.dataType, fixed) else 24 for f in df.schema)


def export_parquet(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def difference_counts(source: DataFrame, copy: DataFrame, name: str) -> DataFrame:
    """One row: rows of each side, and how many of them the other side lacks.

    Counts every distinct row on both sides in one aggregate, rather than
    subtracting each side from the other.
    """
    columns = source.columns
    both = source.select(*columns, F.lit(1).alias("_s"), F.lit(0).alias("_c")).unionAll(
        copy.select(*columns, F.lit(0).alias("_s"), F.lit(1).alias("_c"))
    )
    counts = both.groupBy(*columns).agg(F.sum("_s").alias("s"), F.sum("_c").alias("c"))

    def total(value):
        return F.coalesce(F.sum(value), F.lit(0)).cast("bigint")

    zero = F.lit(0)
    return counts.agg(
        total(F.col("s")).alias("source_rows"),
        total(F.col("c")).alias("copy_rows"),
        total(F.greatest(F.col("s") - F.col("c"), zero)).alias("only_in_source"),
        total(F.greatest(F.col("c") - F.col("s"), zero)).alias("only_in_copy"),
    ).select(F.lit(name).alias("table_name"), "*")
