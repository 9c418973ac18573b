from __future__ import annotations

import pytest
from helpers import rows_of

from tarmac.model import FLIGHT_COLUMNS, NULL_FLAGS, RANGE_FLAGS
from tarmac.operators import quality
from tarmac.plans import bronze


def test_departure_delay_bounds(make_flights):
    delays = [None, -121.0, -120.0, 0.0, 1440.0, 1441.0]
    df = quality.with_range_flags(make_flights(*({"DepDelay": d} for d in delays)))
    got = {(r.DepDelay, r.departure_delay_range_flag) for r in df.collect()}
    assert got == {(None, 1), (-121.0, 1), (-120.0, 0), (0.0, 0), (1440.0, 0), (1441.0, 1)}


def test_distance_bounds(make_flights):
    df = quality.with_range_flags(make_flights(*({"Distance": d} for d in [None, 0.0, 1.0, 10000.0, 10001.0])))
    got = {(r.Distance, r.check_distance_range) for r in df.collect()}
    assert got == {(None, 1), (0.0, 1), (1.0, 0), (10000.0, 0), (10001.0, 1)}


def test_missing_values_can_be_valid(make_flights):
    df = quality.with_range_flags(make_flights({"DepDelay": None, "Distance": None}), null_is_valid=True)
    row = df.first()
    assert (row.departure_delay_range_flag, row.check_distance_range) == (0, 0)


@pytest.mark.parametrize("origin,dest,flag", [("A", "A", 1), ("A", "B", 0), (None, "A", 0), (None, None, 0)])
def test_same_origin_and_destination(make_flights, origin, dest, flag):
    df = quality.with_range_flags(make_flights({"Origin": origin, "Dest": dest}))
    assert df.first().same_origin_destination == flag


def test_null_flags_and_status(make_flights):
    rows = [{}, {"Origin": None, "Dest": None}, {"Cancelled": None}]
    df = quality.with_row_status(quality.with_null_flags(make_flights(*rows)))
    got = sorted((r.total_null_flag_count, r.status, r.cancelled_null) for r in df.collect())
    assert got == [(0, "clean", 0), (0, "clean", 1), (2, "bad", 0)]
    assert quality.clean_count(df).first().clean_rows == 2


def test_null_profile(make_flights):
    df = make_flights({"Distance": None}, {}, {}, {"ArrDelay": None, "Distance": None})
    profile = {r.column_name: tuple(r)[1:] for r in quality.null_profile(df).collect()}
    assert profile["Distance"] == (2, 0.5, 50.0)
    assert profile["ArrDelay"] == (1, 0.25, 25.0)
    assert profile["Origin"] == (0, 0.0, 0.0)
    assert len(profile) == 6


def test_null_profile_of_no_rows(make_flights):
    empty = make_flights({}).limit(0)
    assert {(r.null_count, r.null_pct) for r in quality.null_profile(empty).collect()} == {(0, None)}


def test_flag_reports(make_flights):
    df = bronze.bronze_flights(make_flights({"DepDelay": 2000.0}, {}, {"Origin": "N02"}))
    assert rows_of(quality.flag_distribution(df)) == [
        ("check_distance_range", 0, 3),
        ("departure_delay_range_flag", 0, 2),
        ("departure_delay_range_flag", 1, 1),
        ("same_origin_destination", 0, 2),
        ("same_origin_destination", 1, 1),
    ]
    assert tuple(quality.validation_summary(df).first()) == (1, 1, 0)
    rates = {r.flag: (r.flagged_rows, r.as_expected) for r in quality.expected_rates(df).collect()}
    assert rates["check_distance_range"] == (0, True)
    assert rates["departure_delay_range_flag"] == (1, False)


def test_bronze_shape(make_flights):
    df = bronze.bronze_flights(make_flights({}))
    assert df.columns == [
        *FLIGHT_COLUMNS, *NULL_FLAGS, *RANGE_FLAGS, "corrupt_record", "load_timestamp", "year", "month",
    ]
    assert len(df.drop("load_timestamp").columns) == 51
    short = bronze.bronze_short(make_flights({}))
    assert len(short.columns) == 18
