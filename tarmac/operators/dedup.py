"""Filings of the same flight: keep the latest, number them, list the superseded.

A flight may be filed several times. Filings are ordered by load time, latest
first, and then by content, so that the result does not depend on the order in
which rows arrive.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.model import FLIGHT_KEY
from tarmac.session import released_shuffles, scratch_path

LOAD_TIME = "load_timestamp"

# Filings of one flight that one task numbers at most.
CROWD = 1_000_000
# Most copies of one row that a single output row is expanded into at a time.
_COPY_CHUNK = 100_000
# Bits that mark refiled flights, at most, and in a block; as powers of two.
MOST_BITS = 29
_BLOCK_BITS = 16


def filing_order(
    df: DataFrame,
    key: Sequence[str] = FLIGHT_KEY,
    load_time: str = LOAD_TIME,
    tie_break: Sequence[str] | None = None,
) -> list[Column]:
    """Latest load first, ties by content: every other column unless named.

    Rows that tie on all columns are copies, and any of them is as good.
    """
    if tie_break is None:
        tie_break = [c for c in df.columns if c not in {*key, load_time}]
    return [F.col(load_time).desc_nulls_last(), *(F.col(c).asc_nulls_last() for c in tie_break)]


def latest_filing(
    df: DataFrame,
    key: Sequence[str] = FLIGHT_KEY,
    load_time: str = LOAD_TIME,
    tie_break: Sequence[str] | None = None,
    apart: bool = False,
) -> DataFrame:
    """One row per flight: its latest filing.

    Spark keeps only the first row per flight and task before it shuffles
    (``WindowGroupLimit``), so a flight with very many filings stays small.
    ``apart`` reads the keys of all rows first, and then shuffles and sorts those of refiled flights only: for large
    stored tables, most of whose flights were filed once.
    """
    if apart:
        parts = split_refiled(df, key)
        if parts is None:
            return df
        refiled, single = parts
        return latest_filing(refiled, key, load_time, tie_break).unionByName(single)
    return _first(df, key, filing_order(df, key, load_time, tie_break))


def _first(df: DataFrame, key: Sequence[str], order: list[Column]) -> DataFrame:
    return _number(df, key, order).filter("row_num = 1").drop("row_num")


def _number(df: DataFrame, key: Sequence[str], order: list[Column]) -> DataFrame:
    """``row_num`` within the key, by a window.

    The hash of the key leads the partitioning: it changes no group, and sorting
    then compares one number per pair of rows where it would compare dates and texts.
    """
    window = Window.partitionBy("_key_hash", *key).orderBy(*order)
    hashed = df.withColumn("_key_hash", F.xxhash64(*key))
    return hashed.withColumn("row_num", F.row_number().over(window)).drop("_key_hash")


def first_version_dedup(
    df: DataFrame, key: Sequence[str] = FLIGHT_KEY, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """The earlier form, which orders by flight date before load time.

    The date is part of the key and hence the same within a flight, so this
    keeps the same filing; the helper columns of the row status are dropped.
    """
    helpers = [c for c in ("status", "total_null_flag_count") if c in df.columns]
    df = df.drop(*helpers)
    order = [F.col("FlightDate"), *filing_order(df, key, tie_break=tie_break)]
    return _first(df, key, order)


def dedup_report(df: DataFrame, key: Sequence[str] = FLIGHT_KEY) -> DataFrame:
    """One row: all rows, superseded rows, rows to keep.

    Needs counts per flight only, which combine before the shuffle.
    """
    filings = df.groupBy(*key).agg(F.count("*").alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("bigint")
    return filings.agg(
        total.alias("total_rows"),
        (total - F.count("*")).alias("duplicate_rows"),
        F.count("*").alias("unique_rows"),
    )


def superseded_filings(df: DataFrame, **options) -> DataFrame:
    """Every filing but the latest of its flight, with its number (2, 3, ...)."""
    return _refiled_numbered(df, **options)[0].filter("row_num > 1")


def numbered_filings(df: DataFrame, **options) -> DataFrame:
    """All rows with ``row_num``: 1 for the latest filing of a flight, then 2, 3, ...

    Filings per flight are counted first, by the hash of the key alone, which combines before the shuffle. A flight
    that was filed once has number 1 where it lies, but for a few that share a bit with another. Only rows of the others
    are shuffled, once, and numbered by a window; flights with more than ``crowd`` filings are numbered in slices.
    """
    refiled, single = _refiled_numbered(df, **options)
    return refiled.unionByName(single.withColumn("row_num", F.lit(1).cast("bigint")))


def split_refiled(df: DataFrame, key: Sequence[str] = FLIGHT_KEY) -> tuple[DataFrame, DataFrame] | None:
    """All rows of flights that were filed several times, with a few others, and the rest; None where every flight was
    filed once. Reads the key columns once more, to count them by their hash."""
    hashed = F.xxhash64(*key)
    counts = _refiled_hashes(df, hashed)
    return None if counts.isEmpty() else _split(df, counts, hashed)


def _refiled_hashes(df: DataFrame, hashed: Column) -> DataFrame:
    counts = df.select(hashed.alias("_hash")).groupBy("_hash").agg(F.count("*").alias("_n")).filter("_n > 1")
    return _kept_apart(counts, "refiled")


def _refiled_numbered(
    df: DataFrame,
    key: Sequence[str] = FLIGHT_KEY,
    load_time: str = LOAD_TIME,
    tie_break: Sequence[str] | None = None,
    slices: int | None = None,
    crowd: int = CROWD,
) -> tuple[DataFrame, DataFrame]:
    """The numbered rows of flights that were filed several times, and the rows of the others.

    Flights are counted by the hash of their key, and a bitmap tells the rows of refiled ones where they lie; the few
    others that it lets through are numbered like them, and have number 1.
    """
    hashed = F.xxhash64(*key)
    counts = _refiled_hashes(df, hashed)
    # At most one flight in ``crowd`` rows.
    many = F.broadcast(counts.filter(F.col("_n") > crowd).select("_hash"))
    refiled, single = _split(df, counts, hashed)
    order = filing_order(df, key, load_time, tie_break)
    if many.isEmpty():
        return _number(refiled, key, order).withColumn("row_num", F.col("row_num").cast("bigint")), single
    few = refiled.join(many, hashed == F.col("_hash"), "left_anti")
    crowded = refiled.join(many, hashed == F.col("_hash"), "left_semi")
    numbered = _number(few, key, order).withColumn("row_num", F.col("row_num").cast("bigint"))
    return numbered.unionByName(_numbered_in_slices(crowded, key, order, slices)), single


def _split(df: DataFrame, hashes: DataFrame, hashed: Column) -> tuple[DataFrame, DataFrame]:
    """The rows whose hash may be among the (stored) hashes, and the rows whose hash is not.

    A bit for every hash, in blocks that are broadcast: about two bytes a hash, and 64 MB at most (``MOST_BITS``). Other
    hashes may share a bit, so the first part has all rows that are asked for, and a few more.
    """
    most = min(MOST_BITS, max(_BLOCK_BITS, math.ceil(math.log2(16 * hashes.count() + 1))))

    def place(value: Column, low: int, bits: int) -> Column:
        return F.shiftrightunsigned(value, low).bitwiseAND(F.lit((1 << bits) - 1).cast("bigint"))

    def parts(value: Column) -> tuple[Column, Column, Column]:
        return place(value, _BLOCK_BITS, most - _BLOCK_BITS), place(value, 6, _BLOCK_BITS - 6).cast("int"), place(value, 0, 6).cast("int")

    block, word, bit = parts(F.col("_hash"))
    one = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.col("_bit"))
    words = hashes.select(block.alias("_block"), word.alias("_word"), bit.alias("_bit"))
    words = words.groupBy("_block", "_word").agg(F.bit_or(one).alias("_bits"))
    held = words.groupBy("_block").agg(F.map_from_entries(F.collect_list(F.struct("_word", "_bits"))).alias("_held"))
    every = F.sequence(F.lit(0), F.lit((1 << (_BLOCK_BITS - 6)) - 1))
    blocks = held.select("_block", F.transform(every, lambda i: F.coalesce(F.col("_held")[i], F.lit(0).cast("bigint"))).alias("_words"))
    blocks = _kept_apart(blocks, "bitmap")

    block, word, bit = parts(hashed)
    marked = df.join(F.broadcast(blocks), block == F.col("_block"), "left")
    lit = F.call_function("shiftright", F.get("_words", word), bit).bitwiseAND(F.lit(1).cast("bigint")) == 1
    lit = F.coalesce(lit, F.lit(False))
    return marked.filter(lit).select(*df.columns), marked.filter(~lit).select(*df.columns)


def _numbered_in_slices(
    df: DataFrame, key: Sequence[str], order: list[Column], slices: int | None = None
) -> DataFrame:
    """The numbers of all filings, for flights of any size.

    Equal rows are counted together, which reads
    the input once and stores it. A range partitioning by flight and filing order
    cuts the rows into slices (``slices``, by default the session's shuffle
    partitions), a flight with many filings into several. A row's number is its
    place in its slice, plus the sizes of the flight's earlier slices. The slices
    are stored too, because range bounds are sampled: every use must see the same.
    """
    counted = _kept_apart(df.groupBy(*df.columns).agg(F.count("*").alias("_copies")), "filings")
    ranges = [*key, *order]
    cut = counted.repartitionByRange(slices, *ranges) if slices else counted.repartitionByRange(*ranges)
    sliced = _kept_apart(cut.withColumn("_slice", F.spark_partition_id()), "slices")

    within = Window.partitionBy(*key, "_slice").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    ranked = sliced.withColumn("_last", F.sum("_copies").over(within))
    placed = (
        ranked.alias("r")
        .join(F.broadcast(_slice_offsets(sliced, key)).alias("o"), _same([*key, "_slice"], "r", "o"), "left")
        .select("r.*", (F.coalesce("_offset", F.lit(0)) + F.col("_last")).alias("_end"))
    )
    # Back to one row per copy, a bounded number at a time.
    chunk_starts = F.sequence(
        F.col("_end") - F.col("_copies") + 1, F.col("_end"), F.lit(_COPY_CHUNK).cast("bigint")
    )
    chunks = placed.withColumn("_from", F.explode(chunk_starts)).withColumn(
        "_to", F.least(F.col("_from") + (_COPY_CHUNK - 1), F.col("_end"))
    )
    return chunks.repartition(*key, "_from").select(
        *df.columns, F.explode(F.sequence("_from", "_to")).alias("row_num")
    )


def _slice_offsets(sliced: DataFrame, key: Sequence[str]) -> DataFrame:
    """Filings of a flight before each of its slices, for flights that may cross a bound.

    Only the first and the last flight of a slice can, so there are at most two rows
    per slice, and these are broadcast.
    """
    flight = F.struct(*key)
    edges = sliced.groupBy("_slice").agg(F.min(flight).alias("_low"), F.max(flight).alias("_high"))
    crossing = edges.select(F.explode(F.array("_low", "_high")).alias("_flight")).select("_flight.*")
    sizes = (
        sliced.alias("s")
        .join(F.broadcast(crossing.distinct()).alias("c"), _same(key, "s", "c"), "left_semi")
        .groupBy(*key, "_slice")
        .agg(F.sum("_copies").alias("_size"))
    )
    before = Window.partitionBy(*key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    return sizes.select(
        *key, "_slice", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )


def _same(columns: Sequence[str], left: str, right: str) -> list[Column]:
    return [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]


def _kept_apart(df: DataFrame, name: str) -> DataFrame:
    """Stored in the shared folder and read back."""
    path = scratch_path(df.sparkSession, name)
    with released_shuffles(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
