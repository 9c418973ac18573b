"""States by month, layouts, exports, versions, counts."""

from __future__ import annotations

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from tarmac.operators.counts import StepCounts
from tarmac.plans import gold, silver, states
from tarmac.session import scratch_path
from tarmac.sources import catalog, files, serving, tables


@pytest.fixture()
def held(spark, make_flights, tmp_path):
    """Silver of three months over two years, with null keys and values, and its states."""
    rows = [
        {"FlightDate": dt.date(year, month, 1 + n % 28), "IATA_CODE_Reporting_Airline": code, "Origin": f"n{n % 3}", "Dest": None if n % 11 == 0 else f"n{n % 4}",
         "ArrDelay": None if n % 13 == 0 else float((n * 7) % 90 - 20), "ArrDelayMinutes": float((n * 7) % 70), "ArrivalDelayGroups": n % 5 - 1,
         "Cancelled": float(n % 9 == 0), "Distance": None if n % 17 == 0 else float(n)}
        for year, month in ((2021, 3), (2021, 4), (2022, 3)) for n, code in enumerate(["aa", "bb", "cc", None, "dd"] * 12)
    ]
    table = silver.with_features(make_flights(*rows)).withColumns({"year": F.year("FlightDate"), "month": F.month("FlightDate")})
    path, root = str(tmp_path / "silver"), str(tmp_path / "states")
    tables.write_partitioned(table, path)
    states.refresh(spark, path, root)
    return tables.read_table(spark, path), path, root


def same(a, b):
    assert rows_of(a.select(*b.columns)) == rows_of(b)


def annual(flights):
    """The scorecard's measures straight from Silver."""
    return flights.groupBy("flight_year", "airline_code").agg(
        F.count("*").alias("total_flights"),
        F.round(F.avg(F.when(~F.col("is_cancelled"), F.col("ArrDelayMinutes"))), 2).alias("avg_arrival_delay"),
    )


def test_annual_tables_from_states_equal_those_from_silver(spark, held):
    flights, _, root = held
    same(states.gold_route_kpi(spark, root), gold.gold_route_kpi(flights))
    same(states.airline_scorecard(spark, root), annual(flights))
    exact = flights.filter("ArrDelay is not null").groupBy("flight_year", "airline_code").agg(
        F.count("ArrDelay").alias("arrivals"), gold.percentile("ArrDelay", 0.95).alias("arrival_delay")
    )
    same(states.percentile_from_counts(spark, root, 0.95), exact)
    sketched = {tuple(r)[:2]: r["arrival_delay"] for r in states.percentile_from_sketches(spark, root, 0.95).collect()}
    assert sketched == {tuple(r)[:2]: r["arrival_delay"] for r in exact.collect()}, "few values are kept exactly"


def test_a_changed_month_replaces_its_own_states(spark, held):
    flights, path, root = held
    untouched = {f: os.stat(f).st_mtime_ns for f in parquet_files(f"{root}/routes") if "year=2021/month=4" not in f}
    part = flights.filter("year = 2021 and month = 4")
    more = part.unionByName(part.withColumns({"airline_code": F.lit("ZZ"), "is_cancelled": F.lit(False)}))
    more.write.parquet(f"{path}-next")
    tables.write_partitioned(spark.read.parquet(f"{path}-next"), path, replace="partitions")
    states.refresh(spark, path, root, months=[(2021, 4)])
    now = tables.read_table(spark, path)
    same(states.gold_route_kpi(spark, root), gold.gold_route_kpi(now))
    same(states.airline_scorecard(spark, root), annual(now))
    assert untouched == {f: os.stat(f).st_mtime_ns for f in untouched}
    files.delete(spark, f"{path}/year=2021/month=4")
    states.refresh(spark, path, root, months=[(2021, 4)])
    same(states.gold_route_kpi(spark, root), gold.gold_route_kpi(tables.read_table(spark, path)))


def test_one_month_reads_one_month(spark, held):
    _, path, _ = held
    part = tables.in_months(tables.read_table(spark, path), [(2021, 4)])
    assert "PartitionFilters: [" in plan_of(part) and part.select("year", "month").distinct().collect() == [(2021, 4)]
    assert len(part.inputFiles()) >= 1 and plan_of(states.route_states(part)).count("FileScan") == 1


def test_codes_of_a_dictionary_stay(spark, tmp_path):
    path = str(tmp_path / "codes")
    first = spark.createDataFrame([("b",), ("a",), ("b",), (None,)], "airline string")
    assert rows_of(states.extend_dictionary(first, path)) == [("a", 1), ("b", 2)]
    more = spark.createDataFrame([("0",), ("b",), ("c",)], "airline string")
    assert rows_of(states.extend_dictionary(more, path)) == [("0", 3), ("a", 1), ("b", 2), ("c", 4)]


def test_merged_sketches_stay_within_the_bound(spark):
    rows = spark.range(200_000).select(
        (F.xxhash64("id") % 100_003).cast("double").alias("ArrDelay"), (F.col("id") % 24).alias("month")
    )
    parts = rows.groupBy("month").agg(F.kll_sketch_agg_double("ArrDelay", F.lit(states.SKETCH_K)).alias("s"))
    for share in (0.05, 0.5, 0.95):
        merged = parts.agg(F.kll_merge_agg_double("s").alias("m"))
        value = merged.select(F.kll_sketch_get_quantile_double("m", F.lit(share))).first()[0]
        rank = rows.filter(F.col("ArrDelay") <= value).count() / 200_000
        assert abs(rank - share) <= states.rank_error()
    assert states.rank_error() < 0.02


def parquet_files(path):
    return [os.path.join(d, f) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")]


def met(path, column, value):
    """Files whose footer range of a column holds a value."""
    found = 0
    for file in parquet_files(path):
        footer = pq.ParquetFile(file).metadata
        at = [footer.row_group(0).column(i).path_in_schema for i in range(footer.num_columns)].index(column)
        parts = [footer.row_group(g).column(at).statistics for g in range(footer.num_row_groups)]
        found += any(s.min <= value <= s.max for s in parts)
    return found


def test_interleaved_files_are_skipped_by_either_column(spark, tmp_path):
    rows = spark.range(40_000).select(
        F.concat(F.lit("A"), F.lpad((F.xxhash64("id") % 16 + 16).cast("string"), 2, "0")).alias("airline_code"),
        F.concat(F.lit("N"), F.lpad((F.xxhash64("id", F.lit(1)) % 32 + 32).cast("string"), 2, "0")).alias("origin_code"),
        F.lit(dt.date(2021, 3, 1)).alias("FlightDate"), F.col("id").alias("Flight_Number_Reporting_Airline"),
        F.lit(2021).alias("year"), F.lit(3).alias("month"),
    )
    plain, curve = str(tmp_path / "plain"), str(tmp_path / "curve")
    tables.write_clustered(rows, plain, range_bytes=6_000)
    tables.write_clustered(rows, curve, range_bytes=6_000, interleave=True)
    whole = len(parquet_files(curve))
    assert whole >= 16
    by_origin, by_airline = met(curve, "origin_code", "N33"), met(curve, "airline_code", "A20")
    assert by_origin <= whole / 2 and by_airline <= whole / 2
    assert met(plain, "origin_code", "N33") > 0.9 * len(parquet_files(plain)), "the plain order serves airlines only"
    assert rows_of(tables.read_table(spark, curve).groupBy("origin_code").count()) == rows_of(rows.groupBy("origin_code").count())


def test_ranges_are_small_enough_to_sort_and_rows_made_wide_in_order(spark, tmp_path):
    """Equal rows compress to nothing, so the copy's bytes alone would put them all into one task."""
    rows = spark.range(20_000).selectExpr(
        "'A1' AS airline_code", "concat('N', id % 7) AS origin_code", "DATE '2021-03-01' AS FlightDate",
        "id % 5 AS Flight_Number_Reporting_Airline", "2021 AS year", "3 AS month",
    )
    path, seen = str(tmp_path / "t"), []
    finish = lambda df: seen.append(df.columns) or df.withColumn("wide", F.repeat("origin_code", 50))
    tables.write_clustered(rows, path, sort_bytes=200_000, finish=finish, interleave=True)
    assert len(parquet_files(path)) >= 5
    assert seen == [rows.columns]
    back = tables.read_table(spark, path)
    assert back.filter("wide = repeat(origin_code, 50)").count() == 20_000
    assert rows_of(back.select(*rows.columns).groupBy("origin_code").count()) == rows_of(rows.groupBy("origin_code").count())


def test_nulls_and_few_values_have_a_place_in_the_layout(spark, tmp_path):
    rows = spark.createDataFrame([(a, o, n) for n, (a, o) in enumerate([("A", None), (None, "x"), (None, None), ("A", "y")])], "a string, o string, n int")
    rows = rows.withColumns({"year": F.lit(2021), "month": F.lit(3)})
    path = str(tmp_path / "t")
    tables.write_clustered(rows, path, cluster_by=("a", "o"), spread_by=("n",), interleave=True)
    assert tables.read_table(spark, path).count() == 4


def test_exports_answer_queries_with_pushed_filters(spark, tmp_path):
    path = str(tmp_path / "export")
    rows = spark.createDataFrame(
        [(n, None if n % 7 == 0 else f"A{n % 5}", float(n), dt.date(2021, 1, 1 + n % 28)) for n in range(300)],
        "n int, code string, value double, day date",
    )
    tables.export_parquet(rows.repartition(3), path)
    back = serving.read_export(spark, path)
    same(back, rows)
    assert tuple(tables.difference_counts(rows, back, "t").first()) == ("t", 300, 300, 0, 0)
    for condition in (
        "n >= 100 AND n < 120", "code = 'A3'", "code IN ('A1', 'A2') AND value > 50.5", "code IS NULL", "n % 2 = 0 AND n <= 9",
        "day = DATE '2021-01-05'", "NOT (code = 'A1')", "n > 1000",
    ):
        asked = serving.query_export(spark, path, f"SELECT value, n FROM {{table}} WHERE {condition}")
        assert rows_of(asked) == rows_of(rows.filter(condition).select("value", "n"))
    plan = back.filter("n >= 100")._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan, "the source answers the comparison itself"
    reader = serving.ExportReader(path, ["n"])
    assert list(reader.pushFilters([serving.source.GreaterThan(("n",), 1000)])) == []
    assert [p.groups for p in reader.partitions()] == [[]], "no row group can hold such rows"


def test_versions_are_shown_when_all_tables_are_written(spark, tmp_path):
    database = f"db_{os.path.basename(scratch_path(spark, 'x')).split('-')[1]}"
    catalog.use_database(spark, database, str(tmp_path / "db"))
    root = str(tmp_path / "versions")

    def frames(n, broken=False):
        bad = F.raise_error(F.lit("lost")) if broken else F.lit(n)
        return {f"t{k}": spark.range(n).select("id", (bad if k == 3 else F.lit(n)).alias("v")) for k in range(1, 5)}

    def shown():
        return [spark.table(f"{database}.t{k}").count() for k in range(1, 5)]

    catalog.publish_together(frames(1), database, root)
    assert shown() == [1] * 4
    with pytest.raises(Exception, match="lost"):
        catalog.publish_together(frames(2, broken=True), database, root)
    assert shown() == [1] * 4 and catalog.current_version(spark, root) == "v00000001"
    for n in (3, 4):
        catalog.publish_together(frames(n), database, root)
        assert shown() == [n] * 4
    assert sorted(os.listdir(root))[-2:] == ["v00000002", "v00000003"]
    catalog.show_version(spark, ["t1"], database, root, "v00000002")
    assert spark.table(f"{database}.t1").count() == 3


def test_steps_are_counted_by_the_job_that_writes_them(spark, make_flights, make_airports, tmp_path):
    rows = make_flights({}, {}, {"Flight_Number_Reporting_Airline": 2, "Origin": "X"})
    bronze = rows.withColumns({"year": F.lit(2021), "month": F.lit(3)})
    counts = StepCounts(active=True)
    table = silver.silver_flights(bronze, make_airports(("N01",)), counts=counts)
    tables.write_table(table, str(tmp_path / "t"))
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    assert counts.rows() == [("bronze", 3), ("deduplicated", 2), ("joined_to_airports", 2), ("origin_matched", 1)]
    assert len(tracker.getJobIdsForGroup(None)) == before
    assert StepCounts().at("x", rows) is rows


@pytest.mark.parametrize("refiled", [0, 1, 40])
def test_steps_are_counted_where_flights_filed_once_stay_apart(spark, make_flights, make_airports, tmp_path, refiled):
    """Refiled flights are shuffled, the others are not, and every row is counted once; none, some or all are refiled."""
    one = make_flights({}).drop("Flight_Number_Reporting_Airline")
    numbers = spark.range(40).selectExpr("cast(id AS int) AS Flight_Number_Reporting_Airline")
    rows = numbers.unionByName(numbers.limit(refiled)).crossJoin(one)
    bronze = rows.withColumns({"year": F.lit(2021), "month": F.lit(3)})
    counts = StepCounts(active=True)
    table = silver.silver_flights(bronze, make_airports(("N01",)), counts=counts, apart=True)
    tables.write_table(table, str(tmp_path / "t"))
    assert [n for _, n in counts.rows()][:3] == [40 + refiled, 40, 40]
    plain = silver.silver_flights(bronze, make_airports(("N01",)))
    number = "Flight_Number_Reporting_Airline"
    assert table.columns == plain.columns
    assert sorted(r[number] for r in spark.read.parquet(str(tmp_path / "t")).collect()) == sorted(r[number] for r in plain.collect())
