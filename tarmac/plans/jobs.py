"""The three batch jobs: landing files to Bronze, Bronze to Silver, Silver to Gold.

Each reads what the one before has stored, so a job can run again on its own.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.model import FLIGHT_KEY, GOLD_COLUMNS
from tarmac.operators.airports import home_airports
from tarmac.operators.completeness import not_yet_loaded
from tarmac.operators.counts import StepCounts
from tarmac.operators.dedup import latest_filing
from tarmac.plans import gold
from tarmac.plans.bronze import bronze_flights
from tarmac.plans.silver import silver_flights, silver_in_steps
from tarmac.session import released_shuffles, setting
from tarmac.sources import catalog, files, ledger, raw, tables
from tarmac.sources.ledger import DELIVERY

# The day of a row, by which the ledger knows what a delivery is about.
DAY = "FlightDate"

# Bytes of a landing file (compressed) on average from which loads do not shuffle, and how many a task of them then reads.
LARGE_FILE, TASK_BYTES = 1 << 20, 16 << 20
_READ_BYTES = "spark.sql.files.maxPartitionBytes"


def load_airports(spark: SparkSession, source: str, path: str, fmt: str = "parquet") -> None:
    """Store the home airports of the JSON dimension."""
    tables.write_table(home_airports(raw.read_airport_json(spark, source)), path, fmt)


def load_bronze(spark: SparkSession, landing: str, path: str, fmt: str = "parquet") -> None:
    """Replace Bronze by everything in the landing folder with the right header, and start its ledger anew."""
    ledger.recover(spark, path)
    files.delete(spark, f"{path.rstrip('/')}.rejected")
    admitted = admit(spark, ledger.listed(raw.landing_files(spark, landing)), path)
    if admitted:
        _load(spark, admitted, path, fmt, replace=True)


def extend_bronze(spark: SparkSession, landing: str, path: str, fmt: str = "parquet") -> None:
    """Add the landing files that Bronze does not hold yet, and read no others.

    A file is known by its path and delivery time, which the ledger beside Bronze has of every
    load: a late file of a month already there is added, and one delivered again under its
    old name is added beside the first, whose filings it supersedes in Silver.
    Running it again adds nothing and reads nothing of Bronze; a load that broke off is undone first. The
    names of the new files reach the driver, which lists them for Spark anyway. A file whose header
    is not the expected one is not let in, but listed with the reason (``ledger.rejected``).
    """
    new = new_deliveries(spark, raw.landing_files(spark, landing), path, fmt)
    admitted = admit(spark, ledger.listed(new), path)
    if admitted:
        _load(spark, admitted, path, fmt)


def _load(spark: SparkSession, deliveries: list[tuple], path: str, fmt: str, replace: bool = False) -> None:
    lines = raw.with_delivery(raw.read_flight_csv(spark, [row[0] for row in deliveries]))
    found = ledger.as_deliveries(spark, deliveries)
    # Large files lie by month already: a task writes what it reads. Small ones are gathered, so that Bronze has few files.
    gather = raw.mean_size(spark, [row[0] for row in deliveries]) < LARGE_FILE
    size = spark.conf.get(_READ_BYTES) if gather else f"{TASK_BYTES}b"
    with setting(spark, _READ_BYTES, size):
        ledger.load(bronze_flights(lines), found, path, DAY, fmt, replace=replace, gather=gather)


def admit(spark: SparkSession, deliveries: list[tuple], path: str) -> list[tuple]:
    """The (file, time) deliveries whose header is right; the others are noted beside the table, with the reason."""
    problems = raw.header_problems(spark, [row[0] for row in deliveries])
    bad = [(*row, problem) for row, problem in zip(deliveries, problems) if problem]
    if bad:
        ledger.reject(bad, path, spark)
    return [row for row, problem in zip(deliveries, problems) if not problem]


def new_deliveries(spark: SparkSession, found: DataFrame, path: str, fmt: str = "parquet") -> DataFrame:
    """Those of the deliveries that Bronze neither holds nor has rejected. A Bronze without a ledger gets one."""
    ledger.recover(spark, path)
    ledger.adopt(spark, path, DAY, fmt)
    known = ledger.entries(spark, path).select(*DELIVERY).union(ledger.rejected(spark, path).select(*DELIVERY))
    return not_yet_loaded(found, known, DELIVERY)


def append_lines(lines: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add lines that know their delivery to Bronze: those of new files with the right header."""
    spark = lines.sparkSession
    new = new_deliveries(spark, lines.select(*DELIVERY).distinct(), path, fmt)
    admitted = admit(spark, ledger.listed(new), path)
    if admitted:
        found = ledger.as_deliveries(spark, admitted)
        given = found.select(*(F.col(c).alias(f"_{c}") for c in DELIVERY))
        same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DELIVERY]
        ledger.load(bronze_flights(lines.join(given, same, "left_semi")), found, path, DAY, fmt)


def load_silver(
    spark: SparkSession,
    bronze: str,
    airports: str,
    path: str,
    fmt: str = "parquet",
    interleave: bool = False,
) -> list[tuple[str, int]]:
    """Replace Silver, clustered so that filters on airline and origin skip files (``interleave``: on either).

    Returns the rows after each step, which the one job that computes them has counted.
    """
    held = _loads(ledger.entries(spark, bronze))
    counts = StepCounts(active=True)
    kept, finish = silver_in_steps(
        tables.read_table(spark, bronze, fmt), tables.read_table(spark, airports, fmt), counts=counts, apart=True
    )
    tables.write_clustered(kept, path, fmt=fmt, interleave=interleave, finish=finish)
    ledger.take(held, path, spark, replace=True)
    return counts.rows()


def refresh_silver(
    spark: SparkSession, bronze: str, airports: str, path: str, fmt: str = "parquet"
) -> list[tuple]:
    """Merge what Bronze has loaded since into Silver; returns the (year, month) it has written.

    The ledger tells the new deliveries, and the months whose flights they can concern: those with rows of the
    same calendar months. Of these, only the months in which a flight of the new rows is held, or will be, are
    written: their rows and the new ones, the latest filing of each flight. The others keep their files. The
    result is that of a full rebuild, as long as the airports are the same. A refresh that breaks off is
    made again by the next one: merging the same rows twice changes nothing.
    """
    if not tables.table_exists(spark, path):
        load_silver(spark, bronze, airports, path, fmt)
        return []
    held = ledger.entries(spark, bronze).cache()
    try:
        with released_shuffles(spark):
            return _merge(spark, held, bronze, airports, path, fmt)
    finally:
        held.unpersist()


def _merge(spark: SparkSession, held: DataFrame, bronze: str, airports: str, path: str, fmt: str) -> list[tuple]:
    new = held.join(ledger.taken(spark, path).withColumnRenamed("taken", "batch"), "batch", "left_anti")
    loads = _loads(new)
    if not loads:
        return []
    rows = _rows_of(tables.read_table(spark, bronze, fmt), new)
    fresh = silver_flights(rows, tables.read_table(spark, airports, fmt))
    months = _months(_same_calendar_months(held, new))
    now = tables.read_table(spark, path, fmt)
    keys = rows.select(*(F.col(c).alias(f"_{c}") for c in FLIGHT_KEY)).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in FLIGHT_KEY]
    refiled = tables.in_months(now, months).select(*FLIGHT_KEY, *tables.PARTITIONS).join(keys, same, "left_semi")
    touched = _months(refiled.select(*tables.PARTITIONS).union(new.filter("rows > 0").select(*tables.PARTITIONS)))
    if touched:
        content = [c for c in rows.columns if c not in {*FLIGHT_KEY, *DELIVERY}]
        kept = tables.in_months(now, touched).unionByName(fresh)
        tables.write_clustered(latest_filing(kept, tie_break=content), path, fmt=fmt, replace="partitions", months=touched)
    ledger.take(loads, path, spark)
    return touched


def _loads(found: DataFrame) -> list[str]:
    """Names of loads, of which there are few."""
    return sorted(row[0] for row in found.select("batch").distinct().collect())


def _months(found: DataFrame) -> list[tuple]:
    """Distinct (year, month), which are bounded by the calendar; months without a date come last."""
    rows = found.select(*tables.PARTITIONS).distinct().collect()
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is None, r))


def _same_calendar_months(held: DataFrame, new: DataFrame) -> DataFrame:
    """(year, month) folders with days of the calendar months that the new entries have, or like them without."""

    def calendar(found: DataFrame) -> DataFrame:
        first, last = (F.trunc(c, "month") for c in ("first_day", "last_day"))
        days = F.when(F.col("first_day").isNotNull(), F.sequence(first, last, F.expr("interval 1 month")))
        undated = F.when(F.col("undated") > 0, F.array(F.lit(None).cast("date")))
        both = F.concat(F.coalesce(days, F.array().cast("array<date>")), F.coalesce(undated, F.array().cast("array<date>")))
        return found.select(*tables.PARTITIONS, F.explode(both).alias("calendar"))

    wanted = calendar(new).select(F.col("calendar").alias("_calendar")).distinct()
    return calendar(held).join(wanted, F.col("calendar").eqNullSafe(F.col("_calendar")), "left_semi")


def _rows_of(bronze: DataFrame, new: DataFrame) -> DataFrame:
    """The rows of the given deliveries; only their months are read, and of these only files that can hold them."""
    deliveries = new.filter("rows > 0").select(*(F.col(c).alias(f"_{c}") for c in DELIVERY)).distinct()
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in DELIVERY]
    first, last = new.agg(F.min(DELIVERY[0]), F.max(DELIVERY[0])).first()
    near = tables.in_months(bronze, _months(new.filter("rows > 0"))).filter(F.col(DELIVERY[0]).between(first, last))
    return near.join(deliveries, same, "left_semi")


def gold_tables(silver: DataFrame, airports: DataFrame) -> dict[str, DataFrame]:
    return {
        "gold_airline_kpi": gold.gold_airline_kpi(silver),
        "gold_route_kpi": gold.gold_route_kpi(silver),
        "gold_airport_departure_kpi": gold.gold_airport_departure_kpi(silver, airports),
        "delay_cause_table": gold.gold_delay_cause(silver),
    }


def load_gold(
    spark: SparkSession,
    silver: str,
    airports: str,
    database: str,
    fmt: str = "parquet",
    cache: bool = False,
    versions: str | None = None,
) -> list[str]:
    """Save the four Gold tables in the database; returns their names.

    Each table reads its own few columns of Silver, which is cheap from a
    columnar table; ``cache`` keeps the columns of all four in memory and on
    disk instead, for storage that is slow to read. With ``versions``, a folder, the four are written there as
    one version, and the names in the database show it only when all are written; without, each
    replaces its table as it is saved. Either way their columns are checked before anything is written.
    """
    flights = tables.read_table(spark, silver, fmt)
    if cache:
        flights = flights.select(*gold.SILVER_COLUMNS).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        built = gold_tables(flights, tables.read_table(spark, airports, fmt))
        for name, df in built.items():
            if df.columns != GOLD_COLUMNS[name]:
                raise ValueError(f"{name} has columns {df.columns}, not {GOLD_COLUMNS[name]}")
        if versions:
            return catalog.publish_together(built, database, versions, fmt)
        return [catalog.save_managed(df, database, name, fmt) for name, df in built.items()]
    finally:
        if cache:
            flights.unpersist()
