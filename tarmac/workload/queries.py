"""The registered queries: each reads the given tables and returns a DataFrame.

Dates and timestamps are returned as text, so that any two engines print them
alike; everything else is returned as it is.
"""

from __future__ import annotations

import contextlib
import functools
from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.functions import (
    flight_number_extract,
    flight_number_extract_udf,
    register_sql_functions,
)
from tarmac.model import FLIGHT_COLUMNS, FLIGHT_KEY, NULL_FLAGS, NULL_PROFILE_COLUMNS
from tarmac.operators import airports as dimension
from tarmac.operators import completeness, dedup, quality
from tarmac.operators.counts import StepCounts
from tarmac.plans import bronze, gold, jobs, kpis, silver, states, views
from tarmac.session import scratch_path
from tarmac.sources import catalog, ledger, raw, serving, tables
from tarmac.workload.flights import FILING_ID, SOURCE_KEY, airports, flights

TIE_BREAK = [FILING_ID]
_REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(function):
    _REGISTRY[function.__name__] = function
    return function


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(_REGISTRY)


# --- shared inputs ------------------------------------------------------------


def printable(df: DataFrame) -> DataFrame:
    """Dates and timestamps as text."""
    formats = {"date": "yyyy-MM-dd", "timestamp": "yyyy-MM-dd HH:mm:ss"}
    return df.withColumns(
        {
            name: F.date_format(name, formats[kind])
            for name, kind in df.dtypes
            if kind in formats
        }
    )


def us_airports(spark: SparkSession, sf: str) -> DataFrame:
    return dimension.home_airports(airports(spark, sf))


def bronze_table(spark: SparkSession, sf: str) -> DataFrame:
    return bronze.bronze_flights(flights(spark, sf), carry=[dedup.LOAD_TIME, FILING_ID])


def deduplicated(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.latest_filing(flights(spark, sf), tie_break=TIE_BREAK)


def silver_table(spark: SparkSession, sf: str, gather: Sequence[str] = ()) -> DataFrame:
    """All of Silver. Queries that read few columns make Spark build just those."""
    table = silver.silver_flights(bronze_table(spark, sf), us_airports(spark, sf), TIE_BREAK, gather=gather)
    return table.drop(FILING_ID)


def silver_features(spark: SparkSession, sf: str) -> DataFrame:
    """Silver without the airports, for queries that read none of their columns."""
    return silver.with_features(deduplicated(spark, sf))


def stored(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back."""
    path = scratch_path(spark, name)
    tables.write_table(df, path)
    return tables.read_table(spark, path)


def _feature(spark, sf, sources: list[str], features: dict) -> DataFrame:
    """Feature columns beside the columns they come from."""
    rows = flights(spark, sf, *SOURCE_KEY, *sources)
    return rows.withColumns(features)


def _coded(spark, sf, *sources: str) -> DataFrame:
    return flights(spark, sf, *SOURCE_KEY, *sources).withColumns(silver.code_columns())


# --- sources and sinks --------------------------------------------------------


@query
def scan_csv_bronze(spark, sf):
    path = scratch_path(spark, "landing")
    raw.write_landing(flights(spark, sf, *FLIGHT_COLUMNS), path)
    return printable(raw.required_columns(raw.read_landing(spark, path)))


@query
def corrupt_records(spark, sf):
    """Per month, lines whose departure delay is no number, as the written table has them."""
    rows = flights(spark, sf, *FLIGHT_COLUMNS, "l_linenumber").withColumn(
        "DepDelay",
        F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("DepDelay").cast("string")),
    )
    path = scratch_path(spark, "landing")
    raw.write_landing(rows, path)
    scanned = bronze.bronze_flights(raw.required_columns(raw.read_landing(spark, path)))
    written = stored(spark, scanned, "bronze")
    return written.groupBy("year", "month").agg(
        F.count("*").alias("total_rows"),
        F.count("corrupt_record").alias("corrupt_rows"),
        F.sum("departure_delay_null").alias("departure_delay_null_rows"),
    )


def _airport_files(spark, sf) -> str:
    """The dimension as it is delivered: each file holds one array."""
    path = scratch_path(spark, "airports-json")
    arrays = airports(spark, sf).select(F.to_json(F.array(F.struct("*"))).alias("value"))
    arrays.write.option("maxRecordsPerFile", 1).text(path)
    return path


@query
def scan_json_airports(spark, sf):
    return raw.read_airport_json(spark, _airport_files(spark, sf))


@query
def scan_json_airports_inferred(spark, sf):
    """The same files with the types Spark infers."""
    return raw.read_airport_json(spark, _airport_files(spark, sf), infer=True)


@query
def sink_airports_roundtrip(spark, sf):
    return stored(spark, us_airports(spark, sf), "airports")


@query
def airports_us(spark, sf):
    return us_airports(spark, sf)


@query
def landing_layout_roundtrip(spark, sf):
    """Rows per folder of the landing layout, as the folder names tell them."""
    path = scratch_path(spark, "landing")
    raw.write_landing(flights(spark, sf, *FLIGHT_COLUMNS), path)
    lines = spark.read.option("header", "true").csv(path)
    return lines.groupBy("year", "month").agg(F.count("*").alias("flights"))


def _bronze_roundtrip(spark, sf) -> DataFrame:
    path = scratch_path(spark, "bronze")
    tables.write_partitioned(bronze_table(spark, sf).drop(FILING_ID), path)
    return tables.read_table(spark, path)


@query
def bronze_partitioned_roundtrip(spark, sf):
    return printable(_bronze_roundtrip(spark, sf))


def _silver_by_month(spark, sf) -> str:
    """Silver written by month, from filings that are stored first: joins, deduplication and gathering take disk in turn."""
    path = scratch_path(spark, "silver")
    with contextlib.ExitStack() as held:
        filings, _ = held.enter_context(tables.stored_apart(bronze_table(spark, sf), "filings"))
        kept, finish = silver.silver_in_steps(
            filings, us_airports(spark, sf), TIE_BREAK, drop=[FILING_ID], apart=True, codes=False
        )
        tables.write_partitioned(kept, path, finish=finish, copied=held.close)
    return path


@query
def silver_partitioned_roundtrip(spark, sf):
    """The whole Silver table as written by month and read back."""
    return _printable_silver(tables.read_table(spark, _silver_by_month(spark, sf)))


@query
def silver_month_pruning(spark, sf):
    """Three months of the written Silver table, read by partition."""
    part = tables.read_months(spark, _silver_by_month(spark, sf), (1996, 11), (1997, 1))
    return part.groupBy("year", "month", "airline_code").agg(
        F.count("*").alias("flights"), F.sum("Distance").alias("distance")
    )


@query
def silver_clustered_scan(spark, sf):
    """One airline and a range of origins from the clustered Silver table."""
    path = scratch_path(spark, "silver-clustered")
    with contextlib.ExitStack() as held:
        filings, _ = held.enter_context(tables.stored_apart(bronze_table(spark, sf), "filings"))
        kept, finish = silver.silver_in_steps(
            filings, us_airports(spark, sf), TIE_BREAK, drop=[FILING_ID], apart=True
        )
        tables.write_clustered(kept, path, finish=finish, copied=held.close)
    picked = tables.read_table(spark, path).filter("airline_code = 'AL05' AND origin_code < 'N15'")
    return picked.groupBy("year", "month", "airline_code", "origin_code").agg(
        F.count("*").alias("flights"), F.sum("Distance").alias("distance")
    )


@query
def silver_interleaved_scan(spark, sf):
    """A range of origins, of any airline, from a Silver table that is laid out along both."""
    path = scratch_path(spark, "silver-interleaved")
    with contextlib.ExitStack() as held:
        filings, _ = held.enter_context(tables.stored_apart(flights(spark, sf), "filings"))
        rows = dedup.latest_filing(filings, tie_break=TIE_BREAK, apart=True).withColumns(
            {**silver.code_columns(), "year": F.year("FlightDate"), "month": F.month("FlightDate")}
        )
        tables.write_clustered(rows, path, interleave=True, finish=silver.with_features, copied=held.close)
    picked = tables.read_table(spark, path).filter("origin_code >= 'N20'")
    return picked.groupBy("year", "month", "airline_code", "origin_code").agg(
        F.count("*").alias("flights"), F.sum("Distance").alias("distance")
    )


@query
def ingest_missing_months(spark, sf):
    held = completeness.held_months(
        flights(spark, sf, "FlightDate").select(
            F.year("FlightDate").alias("year"), F.month("FlightDate").alias("month")
        )
    )
    grid = completeness.month_grid(spark, "1994-01-01", "2002-12-01")
    return completeness.missing_months(grid, held)


@query
def incremental_batch_rerun(spark, sf):
    """Years up to 1996 delivered and loaded, then the others, then a run with nothing new."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "bronze-incremental")
    rows = flights(spark, sf, *FLIGHT_COLUMNS)
    early = F.year("FlightDate") <= 1996
    raw.write_landing(rows.filter(early), landing)
    jobs.load_bronze(spark, landing, path)
    raw.write_landing(rows.filter(~early), landing, mode="append")
    for _ in range(2):
        jobs.extend_bronze(spark, landing, path)
    return tables.read_table(spark, path).groupBy("year", "month").agg(
        F.count("*").alias("flights"), F.sum("DepDelay").alias("departure_delay")
    )


@query
def incremental_late_file(spark, sf):
    """Every month delivered in two files, some lines of each with a bad date; loaded after
    each delivery and once more. Rows and bad dates per landing folder."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "bronze-late")
    bad = F.col("l_orderkey") % 50 == 0
    rows = flights(spark, sf, *FLIGHT_COLUMNS, *SOURCE_KEY).withColumns(
        {
            "_day": F.col("FlightDate"),
            "FlightDate": F.when(bad, "soon").otherwise(F.col("FlightDate").cast("string")),
        }
    )
    first = F.col("l_linenumber") <= 3
    raw.write_landing(rows.filter(first), landing, day="_day")
    jobs.load_bronze(spark, landing, path)
    raw.write_landing(rows.filter(~first), landing, day="_day", mode="append")
    for _ in range(2):
        jobs.extend_bronze(spark, landing, path)
    return tables.read_table(spark, path).groupBy("year", "month").agg(
        F.count("*").alias("flights"),
        F.count_if(F.col("FlightDate").isNull()).alias("bad_dates"),
        F.count("corrupt_record").alias("corrupt_rows"),
    )


@query
def refiled_latest_wins(spark, sf):
    """Flights delivered, then those of line 1 filed again in a later file: per month the flights
    kept, and those kept from the later file. By content the earlier filing would win."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "bronze-refiled")
    rows = flights(spark, sf, *FLIGHT_COLUMNS, "l_linenumber")
    raw.write_landing(rows, landing)
    jobs.load_bronze(spark, landing, path)
    again = rows.filter("l_linenumber = 1").withColumn("Tail_Number", F.lit("REFILED"))
    raw.write_landing(again, landing, mode="append")
    jobs.extend_bronze(spark, landing, path)
    kept = dedup.latest_filing(tables.read_table(spark, path))
    return kept.groupBy("year", "month").agg(
        F.count("*").alias("flights"),
        F.count_if(F.col("Tail_Number") == "REFILED").alias("refiled"),
    )


# --- incremental loads: ledger, Silver, headers, columns ------------------------


def _refiled_year(spark: SparkSession, sf: str) -> tuple[str, str]:
    """A landing folder with all flights, loaded into Bronze; flights of line 1 of one year are about to be filed again."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "bronze")
    raw.write_landing(flights(spark, sf, *FLIGHT_COLUMNS), landing)
    jobs.load_bronze(spark, landing, path)
    return landing, path


def _file_again(spark: SparkSession, sf: str, landing: str, path: str) -> None:
    rows = flights(spark, sf, *FLIGHT_COLUMNS, "l_linenumber")
    again = rows.filter("l_linenumber = 1 AND year(FlightDate) = 1997").withColumn("Tail_Number", F.lit("REFILED"))
    raw.write_landing(again, landing, mode="append")
    jobs.extend_bronze(spark, landing, path)


@query
def incremental_ledger_rerun(spark, sf):
    """Years up to 1996 loaded, then the others, then a run with nothing new: what the ledger has per month."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "bronze-ledger")
    rows = flights(spark, sf, *FLIGHT_COLUMNS)
    early = F.year("FlightDate") <= 1996
    raw.write_landing(rows.filter(early), landing)
    jobs.extend_bronze(spark, landing, path)
    raw.write_landing(rows.filter(~early), landing, mode="append")
    for _ in range(2):
        jobs.extend_bronze(spark, landing, path)
    held = ledger.entries(spark, path).filter("rows > 0").groupBy("year", "month").agg(
        F.sum("rows").alias("flights"),
        F.countDistinct("batch").alias("loads"),
        F.min("first_day").alias("first_day"),
        F.max("last_day").alias("last_day"),
    )
    return printable(held)


@query
def incremental_silver_merge(spark, sf):
    """Silver loaded, flights of a year filed again and merged in, then a run with nothing new; per month."""
    landing, path = _refiled_year(spark, sf)
    dimension_path, target = scratch_path(spark, "airports"), scratch_path(spark, "silver-merged")
    tables.write_table(us_airports(spark, sf), dimension_path)
    jobs.load_silver(spark, path, dimension_path, target)
    _file_again(spark, sf, landing, path)
    for _ in range(2):
        jobs.refresh_silver(spark, path, dimension_path, target)
    return tables.read_table(spark, target).groupBy("year", "month").agg(
        F.count("*").alias("flights"),
        F.count_if(F.col("Tail_Number") == "REFILED").alias("refiled"),
        F.count("origin_airport_name").alias("with_origin"),
    )


@query
def incremental_silver_months(spark, sf):
    """The months a merge has written, and how many of the flights there were filed again."""
    landing, path = _refiled_year(spark, sf)
    dimension_path, target = scratch_path(spark, "airports"), scratch_path(spark, "silver-months")
    tables.write_table(us_airports(spark, sf), dimension_path)
    jobs.load_silver(spark, path, dimension_path, target)
    _file_again(spark, sf, landing, path)
    written = jobs.refresh_silver(spark, path, dimension_path, target)
    months = tables.in_months(tables.read_table(spark, target), written)
    return months.groupBy("year", "month").agg(F.count_if(F.col("Tail_Number") == "REFILED").alias("refiled"))


@query
def csv_header_rejects(spark, sf):
    """One month's file has two fields swapped in its header: rows let in, and reasons, per landing folder."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "bronze-headers")
    rows = flights(spark, sf, *FLIGHT_COLUMNS)
    odd = (F.year("FlightDate") == 1997) & (F.month("FlightDate") == 6)
    raw.write_landing(rows.filter(~odd), landing)
    swapped = {"OriginCityName": "OriginState", "OriginState": "OriginCityName"}
    raw.write_landing(rows.filter(odd), landing, mode="append", names=swapped)
    jobs.extend_bronze(spark, landing, path)
    folder = [F.regexp_extract("source_file", f"/{n}=([0-9]+)/", 1).cast("int").alias(n) for n in ("year", "month")]
    held = tables.read_table(spark, path).groupBy("year", "month").agg(
        F.count("*").alias("flights"), F.lit(None).cast("string").alias("reason")
    )
    bad = ledger.rejected(spark, path).select(*folder, F.lit(0).cast("bigint").alias("flights"), "reason")
    return held.unionByName(bad.distinct())


@query
def bronze_schema_drift(spark, sf):
    """Three deliveries: whole distances; distances with decimals and a gate; neither. One table, per month."""
    path = scratch_path(spark, "bronze-drift")
    rows = flights(spark, sf, "FlightDate", "Distance", *SOURCE_KEY, "load_timestamp").select(
        "*", F.year("FlightDate").alias("year"), F.month("FlightDate").alias("month"),
        F.col("Distance").cast("int").alias("miles"), (F.col("l_orderkey") % 50).cast("string").alias("gate"),
    )
    given = ["FlightDate", "load_timestamp", "l_orderkey", "l_linenumber", "year", "month"]
    parts = {
        "first": (F.col("l_linenumber") <= 2, [*given, "miles"]),
        "second": (F.col("l_linenumber").between(3, 4), [*given, (F.col("Distance") + 0.5).alias("miles"), "gate"]),
        "third": (F.col("l_linenumber") >= 5, given),
    }
    for name, (chosen, columns) in parts.items():
        part = rows.filter(chosen).select(*columns).withColumn("source_file", F.lit(name))
        ledger.load(part, part.select(*ledger.DELIVERY).distinct(), path, "FlightDate")
    return tables.read_table(spark, path).groupBy("year", "month").agg(
        F.count("*").alias("flights"), F.sum("miles").alias("miles"), F.count("gate").alias("gates")
    )


# --- Gold from the states of the months ------------------------------------------


def _states(spark: SparkSession, sf: str) -> str:
    """State tables of Silver, of which one month was stored and refreshed later than the others."""
    path, root = scratch_path(spark, "silver-states"), scratch_path(spark, "states")
    rows = silver_features(spark, sf).withColumns({"year": F.year("FlightDate"), "month": F.month("FlightDate")})
    rows = stored(spark, rows.select(*states.SILVER_COLUMNS), "silver")
    late = (F.col("year") == 1997) & (F.col("month") == 6)
    tables.write_partitioned(rows.filter(~late), path)
    states.refresh(spark, path, root)
    tables.write_partitioned(rows.filter(late), path, replace="partitions")
    states.refresh(spark, path, root, months=[(1997, 6)])
    return root


@query
def gold_route_from_months(spark, sf):
    return states.gold_route_kpi(spark, _states(spark, sf))


@query
def route_airlines_from_bitmaps(spark, sf):
    return states.airlines_on_routes(spark, _states(spark, sf))


@query
def vw_airline_scorecard_from_months(spark, sf):
    return states.airline_scorecard(spark, _states(spark, sf))


@query
def kpi_p95_annual_from_counts(spark, sf):
    return states.percentile_from_counts(spark, _states(spark, sf), 0.95)


@query
def kpi_p95_from_sketches(spark, sf):
    """Per airline and year, whether the rank of the sketches' 95th percentile is within the bound."""
    root = _states(spark, sf)
    keys = ["flight_year", "airline_code"]
    found = states.percentile_from_sketches(spark, root, 0.95)
    counts = tables.read_table(spark, f"{root}/delay_counts").groupBy(*keys, "ArrDelay").agg(F.sum("n").alias("n"))
    same = [found[c].eqNullSafe(counts[c]) for c in keys]
    below = F.coalesce(F.sum(F.when(F.col("ArrDelay") < F.col("arrival_delay"), F.col("n"))), F.lit(0))
    up_to = F.coalesce(F.sum(F.when(F.col("ArrDelay") <= F.col("arrival_delay"), F.col("n"))), F.lit(0))
    whole, slack = F.sum("n"), F.lit(states.rank_error()) * F.sum("n")
    joined = found.join(counts, same).select(*(found[c] for c in keys), "arrivals", "arrival_delay", "ArrDelay", "n")
    return joined.groupBy(*keys, "arrivals").agg(
        ((below - slack <= 0.95 * whole) & (up_to + slack >= 0.95 * whole)).alias("within_bound")
    )


# --- catalog ------------------------------------------------------------------


def _new_database(spark: SparkSession) -> str:
    location = scratch_path(spark, "db")
    name = f"flight_analytics_{location.rsplit('-', 1)[1]}"
    catalog.use_database(spark, name, location)
    return name


@query
def catalog_external_table(spark, sf):
    path = scratch_path(spark, "silver")
    columns = [*FLIGHT_KEY, "Distance", "is_cancelled", "flight_year", "year", "month"]
    tables.write_partitioned(
        silver.with_features(
            dedup.latest_filing(bronze_table(spark, sf), tie_break=TIE_BREAK)
        ).select(*columns),
        path,
    )
    name = catalog.register_external(spark, _new_database(spark), "silver_flights", path)
    return spark.sql(
        f"SELECT year, count(*) AS row_count, sum(Distance) AS distance FROM {name} GROUP BY year"
    )


@query
def sql_row_count(spark, sf):
    silver_features(spark, sf).createOrReplaceTempView("silver_flights")
    return catalog.row_count(spark, "silver_flights")


@query
def gold_saved_tables(spark, sf):
    """The four Gold tables as saved in a database, a row per key and measure."""
    database = _new_database(spark)
    saved = {
        name: spark.table(catalog.save_managed(table, database, name))
        for name, table in _gold_tables(spark, sf, _stored_silver(spark, sf)).items()
    }
    return _measures(saved)


# What tells the rows of a Gold table apart; its other columns are numbers.
_GOLD_KEYS = {
    "gold_airline_kpi": ["flight_year", "flight_month", "airline_code", "Reporting_Airline"],
    "gold_route_kpi": ["flight_year", "route", "origin_code", "destination_code"],
    "gold_airport_departure_kpi": [
        "flight_year", "flight_month", "origin_code", "origin_airport_name", "origin_airport_city",
        "origin_airport_state",
    ],
    "delay_cause_table": ["flight_year", "flight_month", "airline_code"],
}


def _measures(gold_tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_key, measure, value) of all the tables."""
    lines = []
    for name, table in gold_tables.items():
        key = F.concat_ws("|", *(F.col(c).cast("string") for c in _GOLD_KEYS[name]))
        numbers = [c for c in table.columns if c not in _GOLD_KEYS[name]]
        wide = table.select(
            F.lit(name).alias("table_name"),
            key.alias("row_key"),
            *(F.col(c).cast("double") for c in numbers),
        )
        lines.append(wide.unpivot(["table_name", "row_key"], numbers, "measure", "value"))
    return functools.reduce(DataFrame.unionAll, lines)


def _stored_silver(spark, sf) -> DataFrame:
    """The Silver columns that Gold reads, stored once for several tables."""
    return stored(spark, silver_table(spark, sf).select(*gold.SILVER_COLUMNS), "silver")


def _gold_tables(spark, sf, table: DataFrame) -> dict[str, DataFrame]:
    return jobs.gold_tables(table, us_airports(spark, sf))


@query
def silver_cached_multi_gold(spark, sf):
    """The four Gold tables from one cached Silver, released once they are written."""
    table = silver_table(spark, sf).select(*gold.SILVER_COLUMNS)
    table = table.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        results = {
            name: stored(spark, result, name)
            for name, result in _gold_tables(spark, sf, table).items()
        }
    finally:
        table.unpersist()
    return _measures(results)


@query
def gold_parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "delay-cause")
    tables.export_parquet(gold.gold_delay_cause(silver_features(spark, sf)), path)
    return spark.read.parquet(path)


@query
def export_readback_diff(spark, sf):
    """The exported table against its source, which is computed once."""
    source = stored(spark, gold.gold_delay_cause(silver_features(spark, sf)), "source")
    path = scratch_path(spark, "delay-cause")
    tables.export_parquet(source, path)
    return tables.difference_counts(source, spark.read.parquet(path), "delay_cause_table")


@query
def export_query_readback(spark, sf):
    """What the exported table answers to a query, through the data source that reads exports."""
    path = scratch_path(spark, "delay-cause")
    tables.export_parquet(gold.gold_delay_cause(silver_features(spark, sf)), path)
    asked = "SELECT * FROM {table} WHERE flight_year >= 1996 AND airline_code >= 'AL05'"
    return serving.query_export(spark, path, asked)


@query
def gold_published_together(spark, sf):
    """Rows of the four Gold tables as published in one version, after a second publication of all."""
    database, root = _new_database(spark), scratch_path(spark, "gold-versions")
    silver_rows = _stored_silver(spark, sf)
    for _ in range(2):
        names = catalog.publish_together(_gold_tables(spark, sf, silver_rows), database, root)
    counted = [
        spark.table(n).agg(F.lit(n.split("`")[3]).alias("table_name"), F.count("*").alias("row_count")) for n in names
    ]
    return functools.reduce(DataFrame.unionAll, counted)


# --- Bronze and data quality --------------------------------------------------


@query
def bronze_projection(spark, sf):
    return printable(flights(spark, sf, *FLIGHT_COLUMNS))


@query
def bronze_flights(spark, sf):
    return printable(bronze_table(spark, sf).drop(FILING_ID))


@query
def bronze_short(spark, sf):
    columns = {*bronze.SHORT_COLUMNS, *bronze.SHORT_EXTRA, *NULL_FLAGS.values()}
    return printable(bronze.bronze_short(flights(spark, sf, *sorted(columns))))


@query
def dq_null_flags(spark, sf):
    columns = sorted(set(NULL_FLAGS.values()))
    flagged = quality.with_null_flags(flights(spark, sf, *SOURCE_KEY, *columns))
    return flagged.select(*SOURCE_KEY, *NULL_FLAGS)


def _with_status(spark, sf) -> DataFrame:
    columns = sorted(set(NULL_FLAGS.values()))
    return quality.with_row_status(
        quality.with_null_flags(flights(spark, sf, *SOURCE_KEY, *columns))
    )


@query
def dq_row_status(spark, sf):
    return _with_status(spark, sf).select(*SOURCE_KEY, "total_null_flag_count", "status")


@query
def dq_clean_count(spark, sf):
    return quality.clean_count(_with_status(spark, sf))


def _range_flag(spark, sf, name: str, *sources: str) -> DataFrame:
    rows = flights(spark, sf, *SOURCE_KEY, *sources)
    return rows.withColumn(name, quality.range_flag_columns()[name])


@query
def dq_delay_range(spark, sf):
    return _range_flag(spark, sf, "departure_delay_range_flag", "DepDelay")


@query
def dq_same_origin_dest(spark, sf):
    return _range_flag(spark, sf, "same_origin_destination", "Origin", "Dest")


@query
def dq_distance_range(spark, sf):
    return _range_flag(spark, sf, "check_distance_range", "Distance")


@query
def dq_flag_distribution(spark, sf):
    return quality.flag_distribution(bronze_table(spark, sf))


@query
def dq_validation_summary(spark, sf):
    return quality.validation_summary(bronze_table(spark, sf))


@query
def dq_expected_rates(spark, sf):
    return quality.expected_rates(bronze_table(spark, sf))


@query
def dq_null_profile(spark, sf):
    return quality.null_profile(flights(spark, sf, *NULL_PROFILE_COLUMNS))


# --- features -----------------------------------------------------------------

_CLOCK = ["CRSDepTime", "CRSArrTime"]
_STATUS = ["Cancelled", "Diverted", "DepDel15", "ArrivalDelayGroups"]


def _picked(columns: dict, kind: str) -> dict:
    return {name: column for name, column in columns.items() if kind in name}


@query
def feat_hhmm(spark, sf):
    return _feature(spark, sf, _CLOCK, _picked(silver.clock_columns(), "_std"))


@query
def feat_hhmm_v1(spark, sf):
    return _feature(spark, sf, _CLOCK, silver.strict_clock_columns())


@query
def feat_minutes(spark, sf):
    minutes = _picked(silver.clock_columns(), "_minutes")
    return _feature(spark, sf, _CLOCK, {f"{name}_safe": c for name, c in minutes.items()})


@query
def feat_minutes_v1(spark, sf):
    return _feature(spark, sf, _CLOCK, _picked(silver.clock_columns(), "_minutes"))


@query
def feat_status_flags(spark, sf):
    return _feature(spark, sf, _STATUS, silver.status_columns())


@query
def feat_delay_category(spark, sf):
    return _feature(spark, sf, ["Cancelled", "ArrDelayMinutes"], silver.category_columns())


@query
def feat_cancellation_reason(spark, sf):
    return _feature(spark, sf, ["CancellationCode"], silver.reason_columns())


@query
def feat_date_parts(spark, sf):
    return printable(_feature(spark, sf, ["FlightDate"], silver.date_columns()))


_CODED = ["IATA_CODE_Reporting_Airline", "Origin", "Dest"]


@query
def feat_codes(spark, sf):
    return _feature(spark, sf, _CODED, silver.code_columns())


@query
def feat_route(spark, sf):
    return _coded(spark, sf, *_CODED).withColumns(silver.route_columns()).drop(*_CODED)


@query
def feat_on_time(spark, sf):
    flagged = _feature(spark, sf, _STATUS, silver.status_columns())
    return flagged.withColumns(silver.on_time_columns()).select(*SOURCE_KEY, "on_time_flight")


@query
def feat_departure_on_time(spark, sf):
    flagged = _feature(spark, sf, _STATUS, silver.status_columns())
    return flagged.withColumns(silver.departure_on_time_columns()).select(
        *SOURCE_KEY, "departure_on_time_flight"
    )


@query
def feat_load_timestamp(spark, sf):
    """Rows, rows without a load time, and load times of one load."""
    loaded = silver.with_load_time(flights(spark, sf, "FlightDate"))
    return loaded.agg(
        F.count("*").alias("total_rows"),
        F.count_if(F.col("load_timestamp").isNull()).alias("without_load_time"),
        F.countDistinct("load_timestamp").alias("load_times"),
    )


_NUMBER = "Flight_Number_Reporting_Airline"


@query
def feat_flight_num_extract(spark, sf):
    return _feature(
        spark, sf, [_NUMBER], {"flight_num_extract": flight_number_extract(F.col(_NUMBER))}
    )


@query
def udf_flight_num_extract(spark, sf):
    return _feature(
        spark, sf, [_NUMBER], {"flight_num_extract": flight_number_extract_udf(F.col(_NUMBER))}
    )


@query
def sql_flight_num_extract(spark, sf):
    register_sql_functions(spark)
    rows = flights(spark, sf, *SOURCE_KEY, _NUMBER)
    return spark.sql(
        f"SELECT *, extract_flight_chars({_NUMBER}) AS flight_num_extract FROM {{rows}}",
        rows=rows,
    )


# --- deduplication ------------------------------------------------------------


@query
def dedup_unique(spark, sf):
    return printable(deduplicated(spark, sf))


@query
def dedup_first_version(spark, sf):
    """The first form, on rows that carry the row status."""
    rows = quality.with_row_status(quality.with_null_flags(flights(spark, sf)))
    return printable(dedup.first_version_dedup(rows, tie_break=TIE_BREAK))


@query
def dedup_duplicates(spark, sf):
    return printable(dedup.superseded_filings(flights(spark, sf), tie_break=TIE_BREAK))


@query
def dedup_report(spark, sf):
    return dedup.dedup_report(flights(spark, sf, *FLIGHT_KEY))


@query
def step_row_counts(spark, sf):
    """Rows after each step from Bronze to the joined table."""
    report = dedup.dedup_report(flights(spark, sf, *FLIGHT_KEY))
    joined = silver_table(spark, sf).agg(
        F.count("*").alias("joined"), F.count("origin_airport_name").alias("with_origin")
    )
    counts = report.select(
        _named("bronze", "total_rows"), _named("deduplicated", "unique_rows")
    ), joined.select(
        _named("joined_to_airports", "joined"), _named("origin_matched", "with_origin")
    )
    steps = [row.select(F.inline(F.array(*row.columns))) for row in counts]
    return steps[0].unionAll(steps[1])


@query
def step_counts_observed(spark, sf):
    """The same counts, taken by the job that writes the joined table while it runs."""
    counts = StepCounts(active=True)
    table = silver.silver_flights(bronze_table(spark, sf), us_airports(spark, sf), TIE_BREAK, counts, apart=True)
    tables.write_table(table, scratch_path(spark, "silver-observed"))
    return spark.createDataFrame(counts.rows(), "step string, row_count bigint")


def _named(step: str, column: str):
    line = F.struct(F.lit(step).alias("step"), F.col(column).alias("row_count"))
    return line.alias(step)


# --- airports -----------------------------------------------------------------


@query
def join_origin_airport(spark, sf):
    rows = _coded(spark, sf, *_CODED).drop(*_CODED)
    return dimension.with_airport(rows, us_airports(spark, sf), "origin")


@query
def join_both_airports(spark, sf):
    rows = _coded(spark, sf, *_CODED).drop(*_CODED)
    return dimension.with_both_airports(rows, us_airports(spark, sf))


@query
def join_inner_origin_airport(spark, sf):
    rows = _coded(spark, sf, *_CODED).drop(*_CODED)
    return dimension.joined_on_origin(rows, us_airports(spark, sf))


@query
def unmatched_airports(spark, sf):
    return dimension.unmatched_codes(_coded(spark, sf, *_CODED), us_airports(spark, sf))


@query
def feat_haversine(spark, sf):
    rows = silver.enriched(
        _coded(spark, sf, *_CODED, _NUMBER), us_airports(spark, sf)
    )
    return rows.select(
        *SOURCE_KEY,
        "origin_code",
        "destination_code",
        F.round("haversine_distance_km", 3).alias("haversine_distance_km"),
    )


@query
def haversine_vs_reported(spark, sf):
    rows = silver.enriched(
        _coded(spark, sf, *_CODED, _NUMBER, "Distance"), us_airports(spark, sf)
    )
    return rows.filter(F.col("haversine_distance_km").isNotNull()).select(
        "origin_code",
        "destination_code",
        "Distance",
        F.round("haversine_distance_km", 2).alias("haversine_km"),
    )


# --- Silver -------------------------------------------------------------------


@query
def silver_flights(spark, sf):
    return _printable_silver(silver_table(spark, sf))


def _printable_silver(table: DataFrame) -> DataFrame:
    rounded = F.round("haversine_distance_km", 3)
    return printable(table.withColumn("haversine_distance_km", rounded))


# --- aggregates ---------------------------------------------------------------

_MONTH = ["flight_year", "flight_month"]


@query
def flights_by_year(spark, sf):
    return gold.flights_by(silver_features(spark, sf), ["flight_year"]).orderBy("flight_year")


@query
def flights_by_year_month(spark, sf):
    return gold.flights_by(silver_features(spark, sf), _MONTH).orderBy(*_MONTH)


@query
def cancelled_by_year_month(spark, sf):
    return gold.cancelled_by(silver_features(spark, sf), _MONTH).orderBy(*_MONTH)


def _airline_month(spark, sf, measures) -> DataFrame:
    return gold.airline_month(silver_features(spark, sf), measures)


@query
def airline_base(spark, sf):
    return _airline_month(spark, sf, gold.base_counts())


@query
def airline_delay_stats(spark, sf):
    return gold.airline_delay_stats(silver_features(spark, sf))


@query
def airline_on_time(spark, sf):
    return _airline_month(spark, sf, [*gold.base_counts()[:1], *gold.on_time_measures()])


@query
def airline_cancelled_pct(spark, sf):
    return _airline_month(spark, sf, [*gold.base_counts()[:1], *gold.cancelled_measures()])


@query
def airline_delay_types(spark, sf):
    return _airline_month(spark, sf, gold.cause_means())


@query
def airline_distance(spark, sf):
    return _airline_month(spark, sf, gold.distance_measures())


@query
def airline_monthly_rank(spark, sf):
    return gold.airline_monthly_rank(silver_features(spark, sf))


# --- Gold ---------------------------------------------------------------------


@query
def gold_airline_kpi(spark, sf):
    return gold.gold_airline_kpi(silver_features(spark, sf))


@query
def gold_airline_kpi_joined(spark, sf):
    return gold.gold_airline_kpi_joined(_stored_silver(spark, sf))


@query
def gold_route_kpi(spark, sf):
    return gold.gold_route_kpi(silver_features(spark, sf))


@query
def gold_airport_departure_kpi(spark, sf):
    return gold.gold_airport_departure_kpi(silver_table(spark, sf), us_airports(spark, sf))


@query
def gold_delay_cause(spark, sf):
    return gold.gold_delay_cause(silver_features(spark, sf))


@query
def route_preview_top(spark, sf):
    """The fifteen busiest routes of a year, with a total order."""
    routes = gold.gold_route_kpi(silver_features(spark, sf))
    order = [F.col("number_of_flights").desc(), "flight_year", "route"]
    return routes.orderBy(*order).limit(15)


# --- KPIs and views -----------------------------------------------------------


@query
def kpi_on_time_rate(spark, sf):
    return kpis.on_time_rate(silver_features(spark, sf))


@query
def kpi_avg_arrival_delay(spark, sf):
    return kpis.average_arrival_delay(silver_features(spark, sf))


@query
def kpi_cancellation_rate(spark, sf):
    return kpis.cancellation_rate(silver_features(spark, sf))


@query
def kpi_delay_cause_mix(spark, sf):
    return kpis.delay_cause_mix(silver_features(spark, sf))


@query
def kpi_p95_arrival_delay(spark, sf):
    return kpis.p95_arrival_delay(silver_features(spark, sf))


@query
def network_summary(spark, sf):
    return kpis.network_summary(silver_features(spark, sf))


@query
def vw_airline_scorecard(spark, sf):
    return views.reporting_view(spark, "vw_airline_scorecard", silver_features(spark, sf))


@query
def vw_delay_trend_monthly(spark, sf):
    return views.reporting_view(spark, "vw_delay_trend_monthly", silver_features(spark, sf))


@query
def vw_airport_performance_map(spark, sf):
    departures = gold.gold_airport_departure_kpi(silver_table(spark, sf), us_airports(spark, sf))
    return views.reporting_view(spark, "vw_airport_performance_map", None, departures)
