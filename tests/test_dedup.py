from __future__ import annotations

import datetime as dt

import pytest
from helpers import plan_of, rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac.model import FLIGHT_KEY
from tarmac.operators import dedup
from tarmac.session import setting


def at(day, hour=0):
    return dt.datetime(2021, 4, day, hour)


def test_latest_filing_wins(make_flights):
    df = make_flights(
        {"DepDelay": 1.0, "load_timestamp": at(1)},
        {"DepDelay": 3.0, "load_timestamp": at(3)},
        {"DepDelay": 2.0, "load_timestamp": at(2)},
        {"Flight_Number_Reporting_Airline": 7, "DepDelay": 9.0, "load_timestamp": None},
    )
    got = {(r.Flight_Number_Reporting_Airline, r.DepDelay) for r in dedup.latest_filing(df).collect()}
    assert got == {(100, 3.0), (7, 9.0)}


def test_equal_load_times_are_settled_by_content(make_flights):
    rows = [{"DepDelay": d, "Tail_Number": t} for d, t in [(5.0, "N2"), (4.0, "N1"), (3.0, None)]]
    winners = set()
    for order in (rows, rows[::-1], rows[1:] + rows[:1]):
        winners.add(dedup.latest_filing(make_flights(*order)).first().DepDelay)
    assert len(winners) == 1
    chosen = dedup.latest_filing(make_flights(*rows), tie_break=["DepDelay"]).first()
    assert chosen.DepDelay == 3.0


def test_missing_keys_form_one_group(make_flights):
    df = make_flights({"Origin": None}, {"Origin": None}, {"Origin": "X"})
    assert dedup.latest_filing(df).count() == 2


def test_report_and_superseded(make_flights):
    df = make_flights(
        {"load_timestamp": at(1)}, {"load_timestamp": at(2)}, {"load_timestamp": at(2)}, {"Dest": "X"}
    )
    assert tuple(dedup.dedup_report(df).first()) == (4, 2, 2)
    assert [r.row_num for r in dedup.superseded_filings(df).orderBy("row_num").collect()] == [2, 3]
    assert tuple(dedup.dedup_report(df.limit(0)).first()) == (0, 0, 0)


def test_first_version_keeps_the_same_rows_without_helpers(make_flights):
    df = make_flights({"load_timestamp": at(1)}, {"load_timestamp": at(2)}).withColumns(
        {"status": F.lit("clean"), "total_null_flag_count": F.lit(0)}
    )
    first = dedup.first_version_dedup(df)
    assert {"status", "total_null_flag_count", "row_num"}.isdisjoint(first.columns)
    latest = dedup.latest_filing(df.drop("status", "total_null_flag_count"))
    assert rows_of(first) == rows_of(latest)


filings = st.lists(
    st.tuples(st.integers(1, 3), st.integers(1, 3), st.integers(0, 2)), min_size=1, max_size=25
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(filings)
def test_one_row_per_flight_and_idempotent(make_flights, rows):
    df = make_flights(
        *(
            {"Flight_Number_Reporting_Airline": n, "load_timestamp": at(d), "DepDelay": float(x)}
            for n, d, x in rows
        )
    )
    kept = dedup.latest_filing(df)
    assert kept.count() == kept.select(*FLIGHT_KEY).distinct().count() == len({n for n, _, _ in rows})
    assert rows_of(dedup.latest_filing(kept)) == rows_of(kept)


@pytest.fixture(scope="module")
def skewed(spark):
    """One flight holds a third of all filings, among them many exact copies; one
    has no key at all; the rest are filed once or twice."""
    n = 9000
    i = F.col("id")
    hot, empty = i % 3 == 0, i % 10 == 1
    return spark.range(n).select(
        F.when(empty, F.lit(None)).otherwise(F.lit("2021-03-14")).cast("date").alias("FlightDate"),
        F.when(~empty, F.lit("AA")).alias("Reporting_Airline"),
        F.when(hot, F.lit(1)).when(~empty, (i / 2).cast("int")).alias("Flight_Number_Reporting_Airline"),
        F.when(~empty, F.lit("N01")).alias("Origin"),
        F.when(~empty, F.lit("N02")).alias("Dest"),
        # Half of the hot filings share one load time, a quarter are exact copies.
        F.when(hot & (i % 2 == 0), F.timestamp_seconds(F.lit(1_600_000_000)))
        .otherwise(F.timestamp_seconds(1_600_000_000 + i % 500))
        .alias("load_timestamp"),
        F.when(i % 4 == 0, F.lit(0)).otherwise(i % 1000).cast("double").alias("DepDelay"),
    )


@pytest.mark.parametrize(("slices", "crowd"), [(1, 1), (3, 1), (40, 1), (3, 100), (None, dedup.CROWD)])
def test_numbering_equals_the_plain_window(skewed, slices, crowd):
    order = dedup.filing_order(skewed)
    plain = dedup._number(skewed, FLIGHT_KEY, order).withColumn("row_num", F.col("row_num").cast("bigint"))
    assert rows_of(dedup.numbered_filings(skewed, slices=slices, crowd=crowd)) == rows_of(plain)
    superseded = dedup.superseded_filings(skewed, slices=slices, crowd=crowd)
    assert rows_of(superseded) == rows_of(plain.filter("row_num > 1"))


def test_a_flight_with_half_of_the_rows_is_cut_over_tasks(spark, monkeypatch):
    hot = spark.range(20_000).select(
        F.lit(None).cast("date").alias("FlightDate"),
        F.lit("AA").alias("Reporting_Airline"),
        F.when(F.col("id") % 2 == 0, 1).otherwise(F.col("id")).cast("int").alias("Flight_Number_Reporting_Airline"),
        F.lit("N01").alias("Origin"),
        F.lit("N02").alias("Dest"),
        F.timestamp_seconds(F.col("id")).alias("load_timestamp"),
    )
    stored, keep = {}, dedup._kept_apart
    monkeypatch.setattr(dedup, "_kept_apart", lambda df, name: stored.setdefault(name, keep(df, name)))
    numbered = dedup.numbered_filings(hot, slices=10, crowd=1)
    assert numbered.agg(F.max("row_num"), F.count("*")).first() == (10_001, 20_000)
    assert stored["slices"].count() == 10_001, "flights filed once are not cut"
    sizes = [r["count"] for r in stored["slices"].groupBy("_slice").count().collect()]
    assert len(sizes) == 10 and max(sizes) < 2 * 10_001 / 10
    assert dedup._slice_offsets(stored["slices"], FLIGHT_KEY).count() <= 2 * 10


def test_copies_are_expanded_in_chunks(skewed, monkeypatch):
    expected = rows_of(dedup.numbered_filings(skewed, crowd=1))
    monkeypatch.setattr(dedup, "_COPY_CHUNK", 7)
    assert rows_of(dedup.numbered_filings(skewed, crowd=1)) == expected


def test_superseded_filings_shuffle_full_rows_once(skewed):
    plan = plan_of(dedup.superseded_filings(skewed))
    assert plan.count("Exchange hashpartitioning") == 1 and "BroadcastExchange" in plan


@pytest.mark.parametrize("most", [16, 29])
def test_many_refiled_flights_leave_single_ones_where_they_lie(spark, monkeypatch, most):
    """However many flights are refiled, full rows are shuffled once, and the others mostly not; full bits lose no row."""
    monkeypatch.setattr(dedup, "MOST_BITS", most, raising=False)
    monkeypatch.setattr(dedup, "fits_broadcast", lambda flights: False, raising=False)  # as with millions of them
    i = F.col("id")
    flight = F.when(i < 20_000, F.floor(i / 2)).otherwise(i).cast("int")
    df = spark.range(60_000).select(
        F.lit("2021-03-14").cast("date").alias("FlightDate"),
        F.when(flight % 7 > 0, F.lit("AA")).alias("Reporting_Airline"),
        flight.alias("Flight_Number_Reporting_Airline"),
        F.lit("N01").alias("Origin"),
        F.lit("N02").alias("Dest"),
        F.timestamp_seconds(i).alias("load_timestamp"),
    )
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", "-1"):
        superseded = dedup.superseded_filings(df)
        assert plan_of(superseded).count("Exchange hashpartitioning") == 1
    found = superseded.selectExpr("Flight_Number_Reporting_Airline AS n", "unix_timestamp(load_timestamp) AS t", "row_num")
    assert sorted(map(tuple, found.collect())) == [(n, 2 * n, 2) for n in range(10_000)]
    refiled, single = dedup._refiled_numbered(df)
    assert (refiled.count() + single.count(), refiled.filter("row_num > 1").count()) == (60_000, 10_000)
    assert 20_000 <= refiled.count() < (24_000 if most > 16 else 30_000)


def test_hot_flight_is_cut_down_before_the_shuffle(skewed):
    plan = plan_of(dedup.latest_filing(skewed))
    assert plan.count("WindowGroupLimit") == 2
    assert "Partial" in plan.split("Exchange")[-1]
