"""Flights and airports derived from the given star-schema tables.

Every ``lineitem`` row is one flight: its ship date is the day, supplier and
customer nations are the airports, the order date is the load time. Rows with
line number 1 are filed a second time, a day later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.model import FLIGHT_COLUMNS, FLIGHT_TYPES

# Unique per filing but for exact copies; breaks ties between equal load times.
FILING_ID = "filing_id"
SOURCE_KEY = ["l_orderkey", "l_linenumber"]

_FROM_SUPPLIER = {"Origin"}
_FROM_CUSTOMER = {"Dest"}
_FROM_LINEITEM = {
    "FlightDate", "Reporting_Airline", "IATA_CODE_Reporting_Airline", "Tail_Number",
    "Flight_Number_Reporting_Airline", "CRSDepTime", "CRSArrTime", "Cancelled",
    "CancellationCode", "Diverted", "AirTime", "Distance", FILING_ID, *SOURCE_KEY,
}

_CANCELLED = "l_returnflag = 'R' AND l_quantity > 45"

# In order: an expression may use the columns above it.
_STEPS = [
    {
        "_cx": _CANCELLED,
        "_days": "datediff(l_shipdate, o_orderdate)",
        "FlightDate": "cast(l_shipdate AS date)",
        "Reporting_Airline": "concat('Al', lpad(cast(l_suppkey % 20 AS string), 2, '0'))",
        "IATA_CODE_Reporting_Airline": "concat('al', lpad(cast(l_suppkey % 20 AS string), 2, '0'))",
        "Tail_Number": "concat('N', cast(l_orderkey % 5000 AS string))",
        "Flight_Number_Reporting_Airline": "cast(l_partkey AS int)",
        "Origin": "concat('n', lpad(cast(s_nationkey AS string), 2, '0'))",
        "Dest": "concat('n', lpad(cast(c_nationkey AS string), 2, '0'))",
        "CRSDepTime": """CASE WHEN l_suppkey % 97 = 0 THEN NULL
            WHEN l_orderkey % 24 = 0 AND l_partkey % 60 = 0 THEN 2400
            ELSE cast((l_orderkey % 24) * 100 + l_partkey % 60 AS int) END""",
        "CRSArrTime": """CASE WHEN l_suppkey % 97 = 0 THEN NULL
            WHEN l_orderkey % 24 = 12 AND l_partkey % 60 = 0 THEN 2400
            ELSE cast(((l_orderkey + 3) % 24) * 100 + (l_partkey * 7) % 60 AS int) END""",
        "Cancelled": f"CASE WHEN {_CANCELLED} THEN 1e0 ELSE 0e0 END",
        "CancellationCode": f"""CASE WHEN {_CANCELLED}
            THEN element_at(array('A', 'B', 'C', 'D', 'Z'), l_linenumber % 5 + 1) END""",
        "Diverted": "CASE WHEN l_linestatus = 'F' AND l_quantity = 1 THEN 1e0 ELSE 0e0 END",
        "AirTime": f"CASE WHEN {_CANCELLED} THEN NULL ELSE l_quantity * 6 END",
        "Distance": "CASE WHEN l_suppkey % 89 = 0 THEN NULL ELSE cast(floor(l_extendedprice / 10) AS double) END",
        FILING_ID: """concat_ws('|', l_orderkey, l_linenumber, l_suppkey,
            floor(l_quantity * 100 + 0.5e0), floor(l_extendedprice * 100 + 0.5e0),
            l_returnflag, l_linestatus)""",
    },
    {
        "DepDelay": "CASE WHEN _cx THEN NULL ELSE cast(_days AS double) END",
        "ArrDelay": "CASE WHEN _cx THEN NULL ELSE cast(_days % 181 AS double) END",
    },
    {
        "DepDelayMinutes": "CASE WHEN _cx THEN NULL ELSE greatest(DepDelay, 0e0) END",
        "DepDel15": "CASE WHEN DepDelay >= 15 THEN 1e0 WHEN DepDelay < 15 THEN 0e0 END",
        "ArrDel15": "CASE WHEN ArrDelay >= 15 THEN 1e0 WHEN ArrDelay < 15 THEN 0e0 END",
        "ArrDelayMinutes": """CASE WHEN _cx THEN NULL WHEN l_linenumber = 7 THEN ArrDelay
            ELSE greatest(ArrDelay, 0e0) END""",
        "ArrivalDelayGroups": """CASE WHEN ArrDelay IS NOT NULL
            THEN cast(least(greatest(floor(ArrDelay / 15), -2), 12) AS int) END""",
    },
    {
        cause: f"CASE WHEN ArrDelayMinutes >= 15 THEN cast(floor(ArrDelayMinutes / {part}) AS double) END"
        for cause, part in (
            ("CarrierDelay", 2),
            ("WeatherDelay", 4),
            ("NASDelay", 8),
            ("SecurityDelay", 16),
        )
    },
    {
        "LateAircraftDelay": "ArrDelayMinutes - CarrierDelay - WeatherDelay - NASDelay - SecurityDelay"
    },
]

# Columns that later steps use; Spark drops those that end up unused.
_USED_LATER = {
    "_cx", "_days", "DepDelay", "ArrDelay", "ArrDelayMinutes",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def flights(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """All flights, with the given columns or, by default, all of them.

    Order, supplier and customer are looked up by their unique keys with left
    joins, so a lookup none of the columns needs is left out without changing
    the rows. Orders look up their customer first, so that lines are shuffled for
    their order only. How the needed ones are joined is left to Spark, which broadcasts
    by the size of the table and splits skewed partitions otherwise.
    """
    names = list(columns) or [*FLIGHT_COLUMNS, "load_timestamp", FILING_ID]
    wanted = set(names)
    from_orders = wanted - _FROM_LINEITEM - _FROM_SUPPLIER

    rows = table(spark, sf_dir, "lineitem")
    if from_orders:
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
        if wanted & _FROM_CUSTOMER:
            customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            orders = orders.join(customer, orders.o_custkey == customer.c_custkey, "left")
        rows = rows.join(orders, rows.l_orderkey == orders.o_orderkey, "left")
    else:
        rows = rows.withColumn("o_orderdate", F.lit(None).cast("timestamp"))
    if wanted & _FROM_SUPPLIER:
        supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
        rows = rows.join(supplier, rows.l_suppkey == supplier.s_suppkey, "left")
    else:
        rows = rows.withColumn("s_nationkey", F.lit(None).cast("int"))
    if not wanted & _FROM_CUSTOMER:
        rows = rows.withColumn("c_nationkey", F.lit(None).cast("int"))

    needed = wanted | _USED_LATER
    defined = set()
    for step in _STEPS:
        picked = {name: F.expr(sql) for name, sql in step.items() if name in needed}
        if picked:
            rows = rows.withColumns(picked)
        defined |= set(step)
    absent = {name: kind for name, kind in FLIGHT_TYPES.items() if name in wanted - defined}
    if absent:
        rows = rows.withColumns({name: F.lit(None).cast(kind) for name, kind in absent.items()})
    # The second filing, in the same pass over the rows.
    filed = F.expr("explode(CASE WHEN l_linenumber = 1 THEN array(0, 1) ELSE array(0) END)")
    load_time = F.expr(
        "cast(cast(o_orderdate AS date) AS timestamp) + make_dt_interval(_refiled)"
    )
    return rows.withColumn("_refiled", filed).withColumn("load_timestamp", load_time).select(*names)


def airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One airport per nation; the first twenty are at home."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    joined = nation.join(region, nation.n_regionkey == region.r_regionkey)
    return joined.selectExpr(
        "concat('City_', n_nationkey) AS city",
        "concat('N', lpad(cast(n_nationkey AS string), 2, '0')) AS code",
        "CASE WHEN n_nationkey < 20 THEN 'US' ELSE 'CA' END AS country",
        "cast(n_nationkey * 10 AS bigint) AS elevation",
        "concat('N', lpad(cast(n_nationkey AS string), 2, '0')) AS iata",
        "concat('KN', lpad(cast(n_nationkey AS string), 2, '0')) AS icao",
        "25e0 + n_nationkey AS lat",
        "-120e0 + 2e0 * n_nationkey AS lon",
        "n_name AS name",
        "r_name AS state",
        "r_name AS tz",
    )
