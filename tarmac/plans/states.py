"""Aggregate states by month of Silver, from which annual tables are finished without reading Silver again.

A state table has a row per month and key with what merges: counts, sums, exact counts of values, bitmaps of
dictionary codes, quantile sketches. Each is partitioned like Silver, so a changed month replaces its own partition, from
its own rows. Annual tables merge states, which are as many as months and keys, however many flights there are.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tarmac.functions.rates import percent
from tarmac.model import ROUTE_YEAR
from tarmac.operators.ranking import with_dense_rank
from tarmac.plans.gold import operated
from tarmac.plans.silver import on_time_columns, route_columns
from tarmac.sources import files, tables

MONTH = list(tables.PARTITIONS)
AIRLINE = ["flight_year", "flight_month", "airline_code"]
# What the states read of Silver.
SILVER_COLUMNS = [
    *MONTH, *AIRLINE, "origin_code", "destination_code", "is_cancelled", "is_arrival_delayed",
    "ArrDelayMinutes", "ArrDelay", "Distance",
]
# Accuracy of the stored quantile sketches.
SKETCH_K = 800


def rank_error(k: int = SKETCH_K) -> float:
    """How far, as a share of all values, the rank of a sketch's quantile may be from the one asked for.

    Three times the published single-sided error of a sketch of that size at 99 % confidence, merged or not.
    """
    return 3 * 2.296 / k**0.9021


def _sum_and_count(name: str, value: Column) -> list[Column]:
    return [F.sum(value).alias(f"{name}_sum"), F.count(value).alias(f"{name}_n")]


def _mean(name: str) -> Column:
    return F.round(F.try_divide(F.sum(f"{name}_sum"), F.sum(f"{name}_n")), 2)


# --- states ---------------------------------------------------------------------


def route_states(silver: DataFrame) -> DataFrame:
    routed = silver.withColumns({**route_columns(), **on_time_columns()})
    return routed.groupBy(*MONTH, *ROUTE_YEAR).agg(
        F.count("*").alias("flights"),
        *_sum_and_count("delay", F.when(operated(), F.col("ArrDelayMinutes"))),
        *_sum_and_count("distance", F.col("Distance")),
        F.count_if("is_arrival_delayed").alias("delayed"),
        F.sum("on_time_flight").alias("on_time"),
    )


def airline_states(silver: DataFrame, k: int = SKETCH_K) -> DataFrame:
    """Per airline-month what the scorecard merges, and a quantile sketch of the signed arrival delay."""
    return silver.groupBy(*MONTH, *AIRLINE).agg(
        F.count("*").alias("flights"),
        F.count_if(operated() & ~F.col("is_arrival_delayed")).alias("on_time"),
        F.count_if("is_cancelled").alias("cancelled"),
        *_sum_and_count("delay", F.when(operated(), F.col("ArrDelayMinutes"))),
        F.kll_sketch_agg_double("ArrDelay", F.lit(k)).alias("delay_sketch"),
    )


def delay_counts(silver: DataFrame) -> DataFrame:
    """Per airline-month how often each arrival delay occurs: delays are whole minutes, so these are few."""
    return silver.filter("ArrDelay is not null").groupBy(*MONTH, *AIRLINE, "ArrDelay").agg(F.count("*").alias("n"))


def route_airlines(silver: DataFrame, dictionary: DataFrame) -> DataFrame:
    """Per route and month a bitmap of the codes of its airlines, in buckets of a bitmap's size."""
    routed = silver.withColumns(route_columns()).filter("airline_code is not null")
    seen = routed.select(*MONTH, *ROUTE_YEAR, "airline_code").distinct()
    coded = seen.join(dictionary, seen["airline_code"] == dictionary["value"])
    return coded.groupBy(*MONTH, *ROUTE_YEAR, F.bitmap_bucket_number("code").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("airlines")
    )


def extend_dictionary(values: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """(value, code) of all values ever seen; values keep their codes, new ones get the next, in order.

    For dimensions such as airlines: numbering the new values happens in one task. New codes are
    appended, and a value that two broken runs have coded twice keeps its smaller code.
    """
    spark = values.sparkSession
    new = values.toDF("value").filter("value is not null").distinct()
    last = 0
    if files.exists(spark, path):
        held = dictionary(spark, path, fmt)
        last = held.agg(F.coalesce(F.max("code"), F.lit(0))).first()[0]
        new = new.join(held, "value", "left_anti")
    order = Window.orderBy("value")
    coded = new.select("value", (F.row_number().over(order) + F.lit(last)).cast("bigint").alias("code"))
    coded.coalesce(1).write.format(fmt).mode("append").save(path)
    return dictionary(spark, path, fmt)


def dictionary(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return tables.read_table(spark, path, fmt).groupBy("value").agg(F.min("code").alias("code"))


def refresh(
    spark: SparkSession, silver: str, root: str, months: Sequence[tuple] | None = None, fmt: str = "parquet"
) -> None:
    """Bring the state tables below ``root`` up to date with Silver: all of it, or the (year, month) named.

    Of the named months only the partitions are read and written; a month that Silver has no more is removed. Every
    state of a month comes from the month's rows alone, so a refresh that broke off is simply made again.
    """
    rows = tables.read_table(spark, silver, fmt).select(*SILVER_COLUMNS)
    replace = "table"
    if months is not None:
        rows, replace = tables.in_months(rows, months), "partitions"
    codes = extend_dictionary(rows.select("airline_code"), f"{root}/airline_codes", fmt)
    states = {
        "routes": route_states(rows),
        "airlines": airline_states(rows),
        "delay_counts": delay_counts(rows),
        "route_airlines": route_airlines(rows, codes),
    }
    for name, table in states.items():
        tables.write_partitioned(table, f"{root}/{name}", fmt=fmt, replace=replace)
    if months:
        left = {tuple(r) for r in rows.select(*MONTH).distinct().collect()}
        for gone in set(map(tuple, months)) - left:
            for name in states:
                files.delete(spark, tables.partition_folder(f"{root}/{name}", gone))


# --- annual tables from states -----------------------------------------------------


def _state(spark: SparkSession, root: str, name: str, fmt: str) -> DataFrame:
    return tables.read_table(spark, f"{root}/{name}", fmt)


def airlines_on_routes(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """How many different airlines flew a route in a year, from the bitmaps of its months."""
    merged = (
        _state(spark, root, "route_airlines", fmt)
        .groupBy(*ROUTE_YEAR, "bucket")
        .agg(F.bitmap_count(F.bitmap_or_agg("airlines")).alias("n"))
    )
    return merged.groupBy(*ROUTE_YEAR).agg(F.sum("n").alias("number_of_airlines_on_route"))


def gold_route_kpi(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The annual route table, from the states of the months."""
    routes = _state(spark, root, "routes", fmt).groupBy(*ROUTE_YEAR).agg(
        F.sum("flights").alias("number_of_flights"),
        _mean("delay").alias("avg_arrival_delay"),
        _mean("distance").alias("avg_distance_travelled"),
        F.sum("delayed").alias("total_delayed_flights"),
        F.sum("on_time").alias("total_on_time_flights"),
        percent(F.sum("on_time"), F.sum("flights")).alias("on_time_percentage_airline_percentage"),
    )
    airlines = airlines_on_routes(spark, root, fmt)
    airlines = airlines.select(*(F.col(c).alias(f"_{c}") for c in ROUTE_YEAR), "number_of_airlines_on_route")
    joined = routes.join(airlines, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in ROUTE_YEAR], "left")
    return joined.select(
        *ROUTE_YEAR, "number_of_flights", "avg_arrival_delay", "avg_distance_travelled", "total_delayed_flights",
        "total_on_time_flights",
        F.coalesce("number_of_airlines_on_route", F.lit(0).cast("bigint")).alias("number_of_airlines_on_route"),
        "on_time_percentage_airline_percentage",
    )


def airline_scorecard(spark: SparkSession, root: str, fmt: str = "parquet") -> DataFrame:
    """The annual scorecard of airlines, from the states of the months."""
    yearly = _state(spark, root, "airlines", fmt).groupBy("flight_year", "airline_code").agg(
        F.sum("flights").alias("total_flights"),
        F.sum("on_time").alias("on_time"),
        percent(F.sum("on_time"), F.sum("flights")).alias("on_time_percentage"),
        percent(F.sum("cancelled"), F.sum("flights")).alias("cancelled_percentage"),
        _mean("delay").alias("avg_arrival_delay"),
    )
    share = yearly.withColumn("share", F.col("on_time") / F.col("total_flights"))
    return with_dense_rank(share, ["flight_year"], "share", "annual_rank").drop("share", "on_time")


def percentile_from_counts(
    spark: SparkSession, root: str, share: float, keys: Sequence[str] = ("flight_year", "airline_code"), fmt: str = "parquet"
) -> DataFrame:
    """The exact percentile of the arrival delay per key, and how many values there are."""
    counts = _state(spark, root, "delay_counts", fmt).groupBy(*keys, "ArrDelay").agg(F.sum("n").alias("n"))
    upward = Window.partitionBy(*keys).orderBy("ArrDelay")
    ranked = counts.withColumns(
        {"up_to": F.sum("n").over(upward), "all": F.sum("n").over(Window.partitionBy(*keys))}
    )
    reached = F.when(F.col("up_to") >= F.lit(share) * F.col("all"), F.col("ArrDelay"))
    return ranked.groupBy(*keys).agg(F.max("all").alias("arrivals"), F.min(reached).alias("arrival_delay"))


def percentile_from_sketches(
    spark: SparkSession, root: str, share: float, keys: Sequence[str] = ("flight_year", "airline_code"), fmt: str = "parquet"
) -> DataFrame:
    """The percentile of the arrival delay per key from merged sketches, within ``rank_error`` of the rank."""
    merged = _state(spark, root, "airlines", fmt).groupBy(*keys).agg(
        F.kll_merge_agg_double("delay_sketch").alias("sketch")
    )
    held = F.kll_sketch_get_n_double("sketch")
    value = F.when(held > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(share)))
    return merged.select(*keys, held.alias("arrivals"), value.alias("arrival_delay"))
