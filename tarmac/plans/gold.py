"""Gold: aggregates over Silver. One pass over the flights each, never sorted."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.rates import percent
from tarmac.model import AIRLINE_MONTH, CAUSE_MONTH, DEPARTURE_MONTH, ROUTE_YEAR
from tarmac.operators.airports import departing_from
from tarmac.operators.ranking import with_dense_rank
from tarmac.plans.silver import on_time_columns, route_columns

# All that the Gold tables read of Silver: what to keep when Silver is cached for them.
SILVER_COLUMNS = [
    *AIRLINE_MONTH, "origin_code", "destination_code",
    "is_cancelled", "is_diverted", "is_departure_delayed", "is_arrival_delayed",
    "ArrDelayMinutes", "DepDelayMinutes", "AirTime", "Distance",
    "CarrierDelay", "WeatherDelay", "SecurityDelay", "LateAircraftDelay",
    "origin_airport_name", "origin_airport_city", "origin_airport_state",
    "origin_lon", "origin_lat",
]


def _all() -> Column:
    return F.count("*")


def operated() -> Column:
    return ~F.col("is_cancelled")


def _ones(condition: Column) -> Column:
    """Rows on which the condition holds; 0 if none."""
    return F.count_if(condition)


def _flown(value: str) -> Column:
    """A column on flights that were not cancelled, else NULL."""
    return F.when(operated(), F.col(value))


def _mean(value: Column | str) -> Column:
    return F.round(F.avg(value), 2)


# --- counts over time ---------------------------------------------------------


def flights_by(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    return silver.groupBy(*keys).agg(_all().alias("total_flights"))


def cancelled_by(silver: DataFrame, keys: Sequence[str]) -> DataFrame:
    return silver.groupBy(*keys).agg(
        _all().alias("total_flights"),
        _ones(F.col("is_cancelled")).alias("cancelled_flights"),
    )


# --- airline-month: parts -----------------------------------------------------


def base_counts() -> list[Column]:
    return [
        _all().alias("total_number_of_flights"),
        _ones(F.col("is_arrival_delayed")).alias("delayed_flights"),
        _ones(F.col("is_cancelled")).alias("total_flights_cancelled"),
        _ones(F.col("is_diverted")).alias("diverted_flights"),
    ]


def percentile(value: str, share: float, accuracy: int | None = None) -> Column:
    """The smallest value of a SQL expression that at least ``share`` of the values
    do not exceed.

    Exact by default: Spark counts every distinct value, and delays are whole
    minutes, so a group's state stays small however many flights it has. With an
    ``accuracy`` a sketch of that size is used instead, for values of any kind.
    """
    if accuracy is not None:
        return F.percentile_approx(F.expr(value), share, accuracy)
    return F.expr(f"percentile_disc({share}) WITHIN GROUP (ORDER BY {value})")


def delay_measures(accuracy: int | None = None) -> list[Column]:
    """Measures of flights that were not cancelled; all NULL where none was."""
    minutes = _flown("ArrDelayMinutes")
    return [
        F.nullif(_ones(operated()), F.lit(0)).alias("non_cancelled_flights"),
        F.avg(minutes).alias("avg_arrival_delay_minutes"),
        percentile("CASE WHEN NOT is_cancelled THEN ArrDelayMinutes END", 0.5, accuracy).alias("median_arrival_delay_minutes"),
    ]


def on_time_measures() -> list[Column]:
    on_time = _ones(operated() & ~F.col("is_arrival_delayed"))
    return [
        on_time.alias("on_time_flights"),
        percent(on_time, _all()).alias("on_time_flight_percentage"),
    ]


def cancelled_measures() -> list[Column]:
    cancelled = _ones(F.col("is_cancelled"))
    return [
        cancelled.alias("cancelled_flights"),
        percent(cancelled, _all()).alias("cancelled_flight_percentage"),
    ]


def cause_means() -> list[Column]:
    return [
        _mean("CarrierDelay").alias("avg_carrier_delay"),
        _mean("WeatherDelay").alias("avg_weather_delay"),
        _mean("SecurityDelay").alias("avg_security_delay"),
        _mean("LateAircraftDelay").alias("avg_late_aircraft_delay"),
    ]


def distance_measures() -> list[Column]:
    return [
        _mean("Distance").alias("avg_distance_travelled"),
        F.round(F.sum("Distance"), 0).alias("total_distance_travelled"),
    ]


def airline_month(silver: DataFrame, measures: list[Column]) -> DataFrame:
    return silver.groupBy(*AIRLINE_MONTH).agg(*measures)


def airline_delay_stats(silver: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Airline-months with flights that were not cancelled."""
    return airline_month(silver.filter(operated()), delay_measures(accuracy))


# --- airline-month: table -----------------------------------------------------


def gold_airline_kpi(silver: DataFrame, accuracy: int | None = None) -> DataFrame:
    """Every airline-month measure from one scan and one shuffle, and the rank of
    the airline by flights within the month."""
    measures = [
        *base_counts(),
        *delay_measures(accuracy),
        *on_time_measures(),
        *cancelled_measures(),
        *cause_means(),
        *distance_measures(),
    ]
    return _ranked(airline_month(silver, measures))


def _ranked(airline_months: DataFrame) -> DataFrame:
    within = ["flight_year", "flight_month"]
    return with_dense_rank(airline_months, within, "total_number_of_flights", "monthly_rank")


def airline_monthly_rank(silver: DataFrame) -> DataFrame:
    return _ranked(airline_month(silver, base_counts()[:1]))


def gold_airline_kpi_joined(silver: DataFrame, accuracy: int | None = None) -> DataFrame:
    """The same table as six aggregates joined on their keys; a cross-check.

    Reads Silver six times: hand it a stored table. An airline-month without a
    code matches nothing here and keeps only its base counts.
    """
    parts = [
        airline_delay_stats(silver, accuracy),
        airline_month(silver, on_time_measures()),
        airline_month(silver, cancelled_measures()),
        airline_month(silver, cause_means()),
        airline_month(silver, distance_measures()),
    ]
    base = airline_month(silver, base_counts())
    return _ranked(reduce(lambda left, part: left.join(part, AIRLINE_MONTH, "left"), parts, base))


# --- routes -------------------------------------------------------------------


def gold_route_kpi(silver: DataFrame) -> DataFrame:
    routed = silver.withColumns({**route_columns(), **on_time_columns()})
    return routed.groupBy(*ROUTE_YEAR).agg(
        _all().alias("number_of_flights"),
        _mean(_flown("ArrDelayMinutes")).alias("avg_arrival_delay"),
        _mean("Distance").alias("avg_distance_travelled"),
        _ones(F.col("is_arrival_delayed")).alias("total_delayed_flights"),
        F.sum("on_time_flight").alias("total_on_time_flights"),
        F.countDistinct("airline_code").alias("number_of_airlines_on_route"),
        percent(F.sum("on_time_flight"), _all()).alias("on_time_percentage_airline_percentage"),
    )


# --- departures ---------------------------------------------------------------


def gold_airport_departure_kpi(
    silver: DataFrame, airports: DataFrame, strict: bool = False
) -> DataFrame:
    """Departures per month from the airports of the dimension.

    The on-time share counts flights that are not departure-delayed, cancelled
    ones included; ``strict`` adds the share without cancelled flights.
    """
    on_time = ~F.col("is_departure_delayed")
    measures = [
        _all().alias("total_departure"),
        _ones(F.col("is_cancelled")).alias("total_cancelled_departure"),
        _mean(_flown("DepDelayMinutes")).alias("avg_departure_delay_minutes"),
        _mean("Distance").alias("avg_route_distance"),
        _all().alias("number_of_flights_operating"),
        _mean(_flown("AirTime")).alias("avg_airtime"),
        percent(_ones(on_time), _all()).alias("departure_on_time_percentage"),
    ]
    if strict:
        share = percent(_ones(on_time & operated()), _all())
        measures.append(share.alias("strict_departure_on_time_percentage"))
    return departing_from(silver, airports).groupBy(*DEPARTURE_MONTH).agg(*measures)


# --- delay causes -------------------------------------------------------------

# (name in the total column, name in the share column, source column)
_CAUSE_TOTALS = [
    ("weather", "weather_delay", "WeatherDelay"),
    ("carrier", "carrier_delay", "CarrierDelay"),
    ("security", "security_delay", "SecurityDelay"),
    ("late_aircraft", "late_aircraft_delay", "LateAircraftDelay"),
]


def gold_delay_cause(silver: DataFrame) -> DataFrame:
    """Minutes of arrival delay and the share of four causes, per airline-month."""
    delayed = silver.filter(operated() & (F.col("ArrDelayMinutes") > 0))
    minutes = {"total_minutes_delayed": "ArrDelayMinutes"}
    minutes |= {f"total_{name}_delayed_minutes": source for name, _, source in _CAUSE_TOTALS}
    totals = delayed.groupBy(*CAUSE_MONTH).agg(
        *(F.round(F.sum(source), 2).alias(name) for name, source in minutes.items())
    )
    return totals.withColumns(
        {
            f"{share}_percentage": percent(
                F.col(f"total_{name}_delayed_minutes"), F.col("total_minutes_delayed")
            )
            for name, share, _ in _CAUSE_TOTALS
        }
    )
