"""Silver: one row per flight, with features and airports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions import (
    add_haversine_distance,
    cancellation_reason,
    delay_category,
    flight_number_extract,
    hhmm_label,
    hhmm_label_strict,
    hhmm_minutes,
    is_one,
)
from tarmac.operators.airports import with_both_airports
from tarmac.operators.counts import StepCounts
from tarmac.operators.dedup import LOAD_TIME, latest_filing, split_refiled
from tarmac.operators.lookup import fits_broadcast
from tarmac.sources.raw import SOURCE_FILE


def clock_columns() -> dict[str, Column]:
    departure, arrival = F.col("CRSDepTime"), F.col("CRSArrTime")
    return {
        "crs_dep_time_std": hhmm_label(departure),
        "crs_arr_time_std": hhmm_label(arrival),
        "crs_dep_minutes": hhmm_minutes(departure),
        "crs_arr_minutes": hhmm_minutes(arrival),
    }


def strict_clock_columns() -> dict[str, Column]:
    """The earlier labels, in which 2400 stays ``24:00``."""
    return {
        "crs_dep_time_std": hhmm_label_strict(F.col("CRSDepTime")),
        "crs_arr_time_std": hhmm_label_strict(F.col("CRSArrTime")),
    }


def status_columns() -> dict[str, Column]:
    return {
        "is_cancelled": is_one(F.col("Cancelled")),
        "is_diverted": is_one(F.col("Diverted")),
        "is_departure_delayed": is_one(F.col("DepDel15")),
        "is_arrival_delayed": F.coalesce(F.col("ArrivalDelayGroups") > 0, F.lit(False)),
    }


def category_columns() -> dict[str, Column]:
    return {
        "arrival_delay_category": delay_category(F.col("Cancelled"), F.col("ArrDelayMinutes"))
    }


def date_columns() -> dict[str, Column]:
    day = F.to_date("FlightDate")
    return {
        "flight_year": F.year(day),
        "flight_month": F.month(day),
        "flight_quarter": F.quarter(day),
        "day_of_week": F.dayofweek(day),
    }


def code_columns() -> dict[str, Column]:
    return {
        "airline_code": F.upper("IATA_CODE_Reporting_Airline"),
        "origin_code": F.upper("Origin"),
        "destination_code": F.upper("Dest"),
    }


def reason_columns() -> dict[str, Column]:
    return {"cancellation_reason": cancellation_reason(F.col("CancellationCode"))}


def route_columns() -> dict[str, Column]:
    """Codes joined by a dash; a missing code is left out."""
    return {"route": F.concat_ws("-", "origin_code", "destination_code")}


def on_time_columns() -> dict[str, Column]:
    arrived = ~F.col("is_cancelled") & ~F.col("is_arrival_delayed")
    return {"on_time_flight": F.when(arrived, 1).otherwise(0)}


def departure_on_time_columns() -> dict[str, Column]:
    left = ~F.col("is_cancelled") & ~F.col("is_departure_delayed")
    return {"departure_on_time_flight": F.when(left, 1).otherwise(0)}


def with_load_time(df: DataFrame) -> DataFrame:
    """The time of this load, for rows that carry none, such as rows that come from
    no file. The jobs store the delivery time of each file instead."""
    if LOAD_TIME in df.columns:
        return df
    return df.withColumn(LOAD_TIME, F.current_timestamp())


def with_features(bronze: DataFrame) -> DataFrame:
    """All row features, in one projection."""
    return bronze.withColumns(
        {
            **clock_columns(),
            **status_columns(),
            **category_columns(),
            **date_columns(),
            **code_columns(),
            **reason_columns(),
        }
    )


def enriched(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Both airports, the flight-number extract and the great-circle distance."""
    joined = with_both_airports(flights, airports).withColumn(
        "flight_num_extract", flight_number_extract(F.col("Flight_Number_Reporting_Airline"))
    )
    return add_haversine_distance(joined)


def silver_flights(
    bronze: DataFrame,
    airports: DataFrame,
    tie_break: Sequence[str] | None = None,
    counts: StepCounts | None = None,
    gather: Sequence[str] = (),
    apart: bool = False,
) -> DataFrame:
    """The Silver table. Deduplication comes first: it shuffles, and the features
    need not travel with the rows. The file a row came from ends with Bronze.
    ``counts`` observes the rows of each step while the table is written. ``gather`` names the columns that the
    table will be partitioned by: rows are brought together before the features and airports make them wide. ``apart`` reads the keys of all
    rows first, and then shuffles and sorts those of refiled flights only: for large tables most of whose flights were filed once."""
    counts = counts or StepCounts()
    kept = _kept(bronze, tie_break, counts, apart)
    if gather:
        kept = kept.hint("rebalance", *gather).sortWithinPartitions(*gather)
    joined = enriched(with_features(kept), airports)
    return counts.at("joined_to_airports", joined, origin_matched=F.col("origin_airport_name"))


def _kept(bronze: DataFrame, tie_break: Sequence[str] | None, counts: StepCounts, apart: bool) -> DataFrame:
    rows = with_load_time(bronze.drop(SOURCE_FILE))
    if not apart:
        latest = latest_filing(counts.at("bronze", rows), tie_break=tie_break)
    elif parts := split_refiled(rows):
        refiled, single = (counts.at("bronze", part) for part in parts)
        latest = latest_filing(refiled, tie_break=tie_break).unionByName(single)
    else:
        latest = counts.at("bronze", rows)
    return counts.at("deduplicated", latest)


def silver_in_steps(
    bronze: DataFrame,
    airports: DataFrame,
    tie_break: Sequence[str] | None = None,
    counts: StepCounts | None = None,
    drop: Sequence[str] = (),
    apart: bool = False,
    codes: bool = True,
) -> tuple[DataFrame, Callable[[DataFrame], DataFrame] | None]:
    """The Silver table in two steps, for a write that lays rows out in between: the deduplicated rows with their
    codes (where ``codes`` asks for them), and what adds the features and airports to rows in place. Airports too many to be broadcast would
    shuffle the rows again: they are added in the first step, and there is no second. ``drop`` names columns that end
    with the deduplication, ``apart`` is that of ``silver_flights``."""
    if not fits_broadcast(airports):
        return silver_flights(bronze, airports, tie_break, counts, apart=apart).drop(*drop), None
    counts = counts or StepCounts()
    kept = _kept(bronze, tie_break, counts, apart).drop(*drop)

    def finish(rows: DataFrame) -> DataFrame:
        joined = enriched(with_features(rows.drop(*code_columns())), airports)
        return counts.at("joined_to_airports", joined, origin_matched=F.col("origin_airport_name"))

    return (kept.withColumns(code_columns()) if codes else kept), finish
