"""What the plans must look like, whatever Spark decides besides."""

from __future__ import annotations

import pytest
from helpers import SF, plan_of

from tarmac.sources.tables import PARTITIONS
from tarmac.workload.flights import flights
from tarmac.workload.queries import queries, silver_table


def plan(spark, name):
    return plan_of(queries()[name](spark, SF))


def test_lookups_no_column_needs_are_left_out(spark):
    assert "Join" not in plan_of(flights(spark, SF, "FlightDate", "CRSDepTime"))
    assert plan_of(flights(spark, SF, "ArrDelay")).count("Join ") == 1
    assert plan_of(flights(spark, SF, "Origin", "Dest")).count("Join ") == 3


def test_scan_reads_only_the_columns_asked_for(spark):
    schema = plan(spark, "feat_hhmm").split("ReadSchema: ")[1].split("\n")[0]
    assert set(schema.removeprefix("struct<").rstrip(">").split(",")) == {
        "l_orderkey:bigint", "l_partkey:bigint", "l_suppkey:bigint", "l_linenumber:int",
    }


@pytest.mark.parametrize("name", ["feat_flight_num_extract", "sql_flight_num_extract", "silver_flights"])
def test_no_python_in_the_native_extract(spark, name):
    assert "Python" not in plan(spark, name)


def test_the_python_extract_runs_in_arrow_batches(spark):
    assert "ArrowEvalPython" in plan(spark, "udf_flight_num_extract")


def test_airline_table_scans_and_shuffles_once(spark):
    text = plan(spark, "gold_airline_kpi")
    assert text.count("lineitem.parquet") == 1
    # Deduplication, aggregation, rank.
    assert text.split("Generate explode")[0].count("Exchange hashpartitioning") == 3


def test_airports_are_broadcast(spark):
    assert plan(spark, "join_both_airports").count("BroadcastHashJoin [origin_code") == 1
    assert plan(spark, "join_both_airports").count("BroadcastHashJoin [destination_code") == 1
    assert "LeftSemi" in plan(spark, "gold_airport_departure_kpi")


@pytest.mark.parametrize("name", ["dq_null_profile", "dq_flag_distribution", "dq_validation_summary", "dq_expected_rates"])
def test_reports_take_one_pass(spark, name):
    text = plan(spark, name)
    assert text.count("lineitem.parquet") == 1
    assert "Generate" not in text.split("Exchange SinglePartition")[1].replace("Generate explode(CASE WHEN (l_linenumber", "")


@pytest.mark.parametrize("name", ["gold_airline_kpi", "gold_route_kpi", "gold_delay_cause", "dedup_report", "dq_null_profile"])
def test_aggregates_combine_before_the_shuffle(spark, name):
    assert "partial_" in plan(spark, name)


def test_no_cartesian_products(spark):
    for name in ("silver_flights", "unmatched_airports", "network_summary", "ingest_missing_months"):
        text = plan(spark, name)
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_silver_is_gathered_before_it_gets_wide(spark, monkeypatch):
    gathered, frame = [], type(spark.range(1))
    hint = frame.hint
    monkeypatch.setattr(frame, "hint", lambda df, name, *by: gathered.append((by, df.columns)) or hint(df, name, *by))
    wide = silver_table(spark, SF, PARTITIONS)
    ((by, columns),) = gathered
    assert by == PARTITIONS and "origin_airport_name" not in columns and "origin_airport_name" in wide.columns
