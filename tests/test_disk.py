"""What jobs have on disk while they run: shuffles end with the step that needs them, and are of narrow rows and parts of them."""

from __future__ import annotations

import datetime as dt
import os
import time

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from tarmac.operators import dedup
from tarmac.plans import jobs, silver
from tarmac.plans.bronze import bronze_flights
from tarmac.sources import raw, tables
from tarmac.workload.flights import flights


def left_over(spark, before: set[str]) -> set[str]:
    """The shuffle files of since then; they are deleted in the background."""
    until = time.time() + 10
    while (left := shuffle_files(spark) - before) and time.time() < until:
        time.sleep(0.1)
    return left


def shuffle_files(spark) -> set[str]:
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (found.apply(i).getName() for i in range(found.size()))
    return {n for n in names if n.startswith("shuffle_")}


@pytest.fixture()
def filings(make_flights):
    """Forty flights of eight months and some of no date; every tenth flight filed again."""
    months = [None if n % 9 == 8 else dt.date(2021, n % 9 + 1, 1) for n in range(40)]
    rows = [
        {"FlightDate": day, "Flight_Number_Reporting_Airline": n, "Origin": f"n0{n % 4}", "IATA_CODE_Reporting_Airline": f"a{n % 3}"}
        for n, day in enumerate(months)
    ]
    again = [{**row, "load_timestamp": dt.datetime(2021, 5, 1), "Tail_Number": "AGAIN"} for row in rows[::10]]
    return make_flights(*rows, *again)


@pytest.fixture()
def saves(monkeypatch):
    """The (year, month) that every write of a table brought, and how."""
    made, plain = [], tables._save

    def noted(df, path, partitions, fmt, replace, **options):
        made.append((replace, {tuple(r) for r in df.select(*partitions).distinct().collect()}))
        plain(df, path, partitions, fmt, replace, **options)

    monkeypatch.setattr(tables, "_save", noted)
    return made


def test_shuffles_of_a_write_end_with_it(spark, filings, tmp_path):
    rows = bronze_flights(filings)
    writes = [
        lambda: raw.write_landing(filings, str(tmp_path / "landing")),
        lambda: tables.write_partitioned(rows, str(tmp_path / "t")),
        lambda: tables.write_clustered(dedup.latest_filing(rows).withColumns(silver.code_columns()), str(tmp_path / "c")),
        lambda: dedup._kept_apart(rows.distinct(), "distinct"),
    ]
    for write in writes:
        before = shuffle_files(spark)
        write()
        assert not left_over(spark, before)


def test_shuffles_of_a_refresh_end_with_it(spark, filings, make_airports, tmp_path):
    landing, bronze, airports, path = (str(tmp_path / n) for n in ("landing", "bronze", "airports", "silver"))
    tables.write_table(make_airports(("N01",), ("N02",)), airports)
    raw.write_landing(filings, landing)
    jobs.extend_bronze(spark, landing, bronze)
    jobs.load_silver(spark, bronze, airports, path)
    raw.write_landing(filings.filter("Tail_Number = 'AGAIN'").withColumn("DepDelay", F.lit(7.0)), landing, mode="append")
    jobs.extend_bronze(spark, landing, bronze)
    before = shuffle_files(spark)
    written = jobs.refresh_silver(spark, bronze, airports, path)
    assert not left_over(spark, before)
    found = tables.read_table(spark, path).filter("DepDelay = 7").select("year", "month").distinct()
    assert rows_of(found) == sorted(written, key=repr) and len(written) == 4
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_lines_are_shuffled_for_their_order_only(spark, tmp_path):
    """The customer is that of the order, also where keys repeat or lack."""
    given = {
        "lineitem": (
            "l_orderkey bigint, l_linenumber int, l_shipdate date, l_quantity double, l_returnflag string",
            [(k, n, dt.date(1996, 1, 1), 1.0, "N") for n, k in enumerate([1, 1, 2, 3, 9, None], start=2)],
        ),
        "orders": (
            "o_orderkey bigint, o_custkey bigint, o_orderdate date",
            [(k, c, dt.date(1995, 1, 1)) for k, c in [(1, 5), (2, 5), (2, 6), (3, None), (None, 5)]],
        ),
        "customer": ("c_custkey bigint, c_nationkey int", [(5, 1), (5, 2), (6, 3), (None, 4)]),
    }
    for name, (schema, rows) in given.items():
        spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / f"{name}.parquet"))
    bound = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = flights(spark, str(tmp_path), "l_linenumber", "Dest")
        twice = ["n01", "n02"]
        expected = [twice, twice, [*twice, "n03"], [None], [None], [None]]
        assert rows_of(found) == sorted(((n, d) for n, places in enumerate(expected, start=2) for d in places), key=repr)
        below = plan_of(found).split("Exchange hashpartitioning(o_custkey")[1].split("Exchange")[0]
        assert "orders.parquet" in below and "Join" not in below
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", bound)


@pytest.mark.parametrize("interleave", [None, False, True])
def test_tables_are_written_some_partitions_at_a_time(spark, filings, tmp_path, saves, interleave):
    path, seen = str(tmp_path / "t"), []
    rows = bronze_flights(filings)

    def write(rows, batch_bytes, **options):
        options |= {"copied": lambda: seen.append(len(saves)), "finish": silver.with_features, "batch_bytes": batch_bytes}
        if interleave is None:
            tables.write_partitioned(rows, path, **options)
        else:
            tables.write_clustered(rows.withColumns(silver.code_columns()), path, interleave=interleave, **options)

    def held():
        return rows_of(tables.read_table(spark, path).select("year", "month", *silver.code_columns(), "Tail_Number", "flight_quarter"))

    write(rows, 1 << 30)
    whole = held()
    assert len(saves) == 1 and len(whole) == 44
    write(rows, 1)
    assert held() == whole
    assert seen == [0, 1], "what the rows were made from is let go before any are written"
    ways, months = zip(*saves[1:])
    assert ways == ("table", *["nothing"] * 8)
    assert [len(m) for m in months] == [1] * 9 and len(set.union(*months)) == 9

    del saves[:]
    write(rows.filter("month IN (2, 3) OR month IS NULL").withColumn("Tail_Number", F.lit("NEW")), 1, replace="partitions")
    assert [way for way, _ in saves] == ["partitions"] * 3
    some = [r for r in held() if r[5] == "NEW"]
    assert {r[1] for r in some} == {None, 2, 3} and len(held()) == 44
    assert len(some) == len([r for r in whole if r[1] in (None, 2, 3)])


def test_a_batch_has_whole_partitions_up_to_its_size(spark):
    rows = spark.createDataFrame([(y, m) for y, m, n in [(None, None, 3), (1, 1, 2), (1, 2, 2), (2, 1, 9), (2, 2, 1)] for _ in range(n)], "year int, month int")
    found = tables._batches(rows, tables.PARTITIONS, 17, 5)
    assert [n for _, n in found] == [5, 2, 9, 1]
    assert [df.count() for df, _ in found] == [5, 2, 9, 1]
    assert [n for _, n in tables._batches(rows, tables.PARTITIONS, 17, 17)] == [17]


def test_silver_shuffles_refiled_flights_only(spark, filings, make_airports, tmp_path):
    tables.write_table(bronze_flights(filings), str(tmp_path / "b"))
    bronze, airports = tables.read_table(spark, str(tmp_path / "b")), make_airports(("N01",), ("N02",))
    kept, finish = silver.silver_in_steps(bronze, airports, apart=True)
    plain, finish_plain = silver.silver_in_steps(bronze, airports)
    assert rows_of(finish(kept)) == rows_of(finish_plain(plain))
    assert finish(kept).columns == finish_plain(plain).columns
    assert kept.filter("Tail_Number = 'AGAIN'").count() == 4
    found = plan_of(kept)
    assert found.count("Exchange hashpartitioning") == 1 and found.count("Window [") == 1
    refiled = found.split("Union")[1]
    assert refiled.index("Window [") < refiled.index("Exchange hashpartitioning") < refiled.rindex("FileScan")
    once = bronze.filter("Tail_Number IS NULL")
    assert "Window" not in plan_of(silver.silver_in_steps(once, airports, apart=True)[0])
    assert rows_of(dedup.latest_filing(bronze, apart=True)) == rows_of(dedup.latest_filing(bronze))
    narrow, _ = silver.silver_in_steps(bronze, airports, apart=True, codes=False)
    assert rows_of(finish(narrow)) == rows_of(finish(kept))


def test_silver_that_is_loaded_in_batches_is_the_same(spark, filings, make_airports, tmp_path, monkeypatch):
    bronze, airports = str(tmp_path / "b"), str(tmp_path / "a")
    tables.write_table(make_airports(("N01",), ("N02",)), airports)
    tables.write_partitioned(bronze_flights(filings), bronze)
    counts = jobs.load_silver(spark, bronze, airports, str(tmp_path / "one"))
    plain = tables._batches
    monkeypatch.setattr(tables, "_batches", lambda rows, partitions, size, _: plain(rows, partitions, size, 1))
    assert jobs.load_silver(spark, bronze, airports, str(tmp_path / "many")) == counts
    assert dict(counts)["bronze"] == 44 and dict(counts)["deduplicated"] == 40
    one, many = (rows_of(tables.read_table(spark, str(tmp_path / p))) for p in ("one", "many"))
    assert one == many and len(one) == 40
    assert not [f for f in os.listdir(tmp_path / "many") if f.startswith("_temporary")]
