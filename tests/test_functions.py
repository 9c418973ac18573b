from __future__ import annotations

import math

import pytest
from helpers import rows_of
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tarmac import functions as fn

few = settings(
    max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)


def values(spark, ddl, items, *columns):
    df = spark.createDataFrame([(i, *(v if isinstance(v, tuple) else (v,))) for i, v in enumerate(items)], f"i int, {ddl}")
    out = df.select("i", *columns).collect()
    return [tuple(row)[1:] if len(columns) > 1 else row[1] for row in sorted(out)]


HHMM = [None, 5, 100, 959, 1430, 2359, 2400]


def test_hhmm_label(spark):
    assert values(spark, "t int", HHMM, fn.hhmm_label(F.col("t"))) == [
        None, "00:05", "01:00", "09:59", "14:30", "23:59", "00:00",
    ]


def test_hhmm_label_strict_keeps_2400(spark):
    assert values(spark, "t int", HHMM, fn.hhmm_label_strict(F.col("t"))) == [
        None, "00:05", "01:00", "09:59", "14:30", "23:59", "24:00",
    ]


def test_hhmm_minutes(spark):
    column = fn.hhmm_minutes(F.col("t"))
    assert values(spark, "t int", HHMM, column) == [None, 5, 60, 599, 870, 1439, 0]
    typed = spark.createDataFrame([(1,)], "t int").select(column.alias("m"))
    assert typed.dtypes == [("m", "bigint")]


@few
@given(st.lists(st.integers(0, 23).flatmap(lambda h: st.integers(0, 59).map(lambda m: h * 100 + m)), min_size=1, max_size=30))
def test_minutes_stay_within_a_day(spark, times):
    got = values(spark, "t int", times, fn.hhmm_minutes(F.col("t")))
    assert got == [t // 100 * 60 + t % 100 for t in times]
    assert all(0 <= m <= 1439 for m in got)


def test_is_one_is_never_null(spark):
    assert values(spark, "x double", [None, 0.0, 1.0], fn.is_one(F.col("x"))) == [False, False, True]


MINUTES = [-1.0, 0.0, 14.0, 14.5, 15.0, 44.0, 44.5, 45.0, 120.0, 120.5, None]


def test_delay_category_edges(spark):
    category = fn.delay_category(F.lit(0.0), F.col("m"))
    assert values(spark, "m double", MINUTES, category) == [
        "Early", "On Time", "On Time", None, "Minor Delay", "Minor Delay", None,
        "Major Delay", "Major Delay", "Severe Delay", None,
    ]


def test_cancelled_has_its_own_category_whatever_the_delay(spark):
    category = fn.delay_category(F.lit(1.0), F.col("m"))
    assert set(values(spark, "m double", MINUTES, category)) == {"Cancelled"}


def test_cancellation_reason(spark):
    got = values(spark, "c string", ["A", "B", "C", "D", "Z", None], fn.cancellation_reason(F.col("c")))
    assert got == ["Carrier", "Weather", "National_Security", "Security_Concern", None, None]


def test_cancellation_reason_takes_another_map(spark):
    column = fn.cancellation_reason(F.col("c"), {"C": "Air system"})
    assert values(spark, "c string", ["A", "C"], column) == [None, "Air system"]


NUMBERS = ["1234567", "AA123", "WN2345", None, "1", "", "123456789"]
EXTRACTS = ["147", "A2", "W3", None, "1", None, "147"]


def test_flight_number_extract(spark):
    assert values(spark, "s string", NUMBERS, fn.flight_number_extract(F.col("s"))) == EXTRACTS


def test_flight_number_extract_through_python_agrees(spark):
    assert values(spark, "s string", NUMBERS, fn.flight_number_extract_udf(F.col("s"))) == EXTRACTS


@pytest.mark.parametrize("python", [True, False])
def test_flight_number_extract_in_sql(spark, python):
    fn.register_sql_functions(spark, python=python)
    assert values(spark, "s string", NUMBERS, F.expr("extract_flight_chars(s)")) == EXTRACTS


def km(spark, *points):
    return values(
        spark, "a double, b double, c double, d double", points,
        fn.haversine_km(F.col("a"), F.col("b"), F.col("c"), F.col("d")),
    )


def test_haversine_special_points(spark):
    same, poles, antipodes, missing, known = km(
        spark,
        (10.0, 20.0, 10.0, 20.0),
        (90.0, 0.0, -90.0, 0.0),
        (12.3, 45.6, -12.3, -134.4),
        (None, 1.0, 2.0, 3.0),
        (40.6413, -73.7781, 33.9416, -118.4085),
    )
    half = math.pi * 6371.0
    assert same == 0.0
    assert poles == pytest.approx(half)
    assert antipodes == pytest.approx(half)
    assert missing is None
    assert known == pytest.approx(3974.3, abs=1.0)


@few
@given(st.lists(st.tuples(st.floats(-90, 90), st.floats(-180, 180), st.floats(-90, 90), st.floats(-180, 180)), min_size=1, max_size=30))
def test_haversine_is_a_bounded_symmetric_distance(spark, points):
    there = km(spark, *points)
    back = km(spark, *((c, d, a, b) for a, b, c, d in points))
    assert there == pytest.approx(back, abs=1e-3)
    assert all(0.0 <= x <= math.pi * 6371.0 + 1e-6 for x in there)


def test_add_haversine_distance_names_its_columns(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 180.0)], "p double, q double, r double, s double")
    row = fn.add_haversine_distance(df, "p", "q", "r", "s", "km").first()
    assert row.km == pytest.approx(math.pi * 6371.0)


def test_percent_rounds_and_survives_zero(spark):
    df = spark.createDataFrame([(1, 3), (1, 0), (None, 2)], "a int, b int")
    assert rows_of(df.select(fn.percent(F.col("a"), F.col("b")))) == [(33.33,), (None,), (None,)]
