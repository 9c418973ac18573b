from __future__ import annotations

import pytest
from helpers import plan_of, rows_of
from pyspark.sql import functions as F

from tarmac.operators import airports as dim
from tarmac.operators.lookup import fits_broadcast, lookup_join
from tarmac.plans.silver import code_columns, enriched, silver_flights


@pytest.fixture(scope="module")
def flights(make_flights):
    return make_flights(
        {"Origin": "n01", "Dest": "n02"},
        {"Origin": "N02", "Dest": "n99", "Flight_Number_Reporting_Airline": 2},
        {"Origin": None, "Dest": "n01", "Flight_Number_Reporting_Airline": 3},
        {"Origin": "n03", "Dest": "n01", "Flight_Number_Reporting_Airline": 4},
    ).withColumns(code_columns())


@pytest.fixture(scope="module")
def airports(make_airports):
    return make_airports(("N01",), ("N02", "US", 40.0, -80.0), ("N03", "CA"), ("N04", "US", None, None))


def test_home_airports(airports):
    assert rows_of(dim.home_airports(airports).select("iata")) == [("N01",), ("N02",), ("N04",)]


def test_both_roles_keep_every_flight(flights, airports):
    home = dim.home_airports(airports)
    joined = dim.with_both_airports(flights, home)
    assert rows_of(joined.select("origin_airport_name", "dest_airport_name")) == [
        ("N01", "N02"), ("N02", None), (None, "N01"), (None, "N01"),
    ]
    assert not {"origin_iata", "dest_iata"} & set(joined.columns)
    assert plan_of(joined).count("BroadcastHashJoin") == 2


def test_duplicate_codes_do_not_multiply_flights(flights, make_airports):
    twice = make_airports(("N01", "US", 1.0, 1.0, "B"), ("N01", "US", 2.0, 2.0, "A"))
    joined = dim.with_airport(flights, twice, "origin")
    assert joined.count() == 4
    assert rows_of(joined.filter("origin_code = 'N01'").select("origin_airport_name")) == [("A",)]


def test_join_is_dropped_when_no_airport_column_is_read(flights, airports):
    joined = dim.with_both_airports(flights, airports)
    assert "Join" not in plan_of(joined.groupBy("origin_code").count())


def test_origin_outside_the_dimension_is_left_out(flights, airports):
    home = dim.home_airports(airports)
    assert rows_of(dim.departing_from(flights, home).select("origin_code")) == [("N01",), ("N02",)]
    inner = dim.joined_on_origin(flights, home)
    assert rows_of(inner.select("origin_code", "name")) == [("N01", "N01"), ("N02", "N02")]


def test_unmatched_codes(flights, airports):
    home = dim.home_airports(airports)
    got = rows_of(dim.unmatched_codes(flights, home))
    assert got == [("N03", "origin", 1), ("N99", "dest", 1), (None, "origin", 1)]


def test_distance_is_null_without_both_points(flights, airports):
    far = enriched(flights, dim.home_airports(airports)).select("origin_code", "haversine_distance_km")
    known = {r.origin_code: r.haversine_distance_km for r in far.collect()}
    assert known["N01"] > 1000
    assert known["N02"] is None and known["N03"] is None and known[None] is None


def test_silver_has_83_columns_in_one_row_per_flight(make_flights, airports):
    from tarmac.plans.bronze import bronze_flights

    bronze = bronze_flights(make_flights({}, {}, {"Dest": "N01"}))
    silver = silver_flights(bronze, airports)
    assert len(silver.columns) == 83
    assert silver.count() == 2


def test_size_check(spark):
    lookup = spark.range(100).withColumn("text", F.repeat(F.lit("x"), 10))
    assert fits_broadcast(lookup, max_rows=100, max_bytes=2000)
    assert not fits_broadcast(lookup, max_rows=99)
    assert not fits_broadcast(lookup, max_bytes=1000)
    assert fits_broadcast(lookup.limit(0))


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_shuffled_join_equals_broadcast_join(spark, how):
    # A third of the rows share one key, some have none, some match nothing.
    rows = spark.range(900).select(
        "id",
        F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 10 == 1, None).otherwise(F.col("id") % 70).alias("k"),
    )
    lookup = spark.range(50).select(F.col("id").alias("key"), (F.col("id") * 2).alias("v"))
    small = lookup_join(rows, lookup, {"k": "key"}, how, broadcast=True)
    large = lookup_join(rows, lookup, {"k": "key"}, how, broadcast=False)
    assert "BroadcastHashJoin" in plan_of(small)
    assert small.columns == large.columns
    assert rows_of(large) == rows_of(small)
