"""The headline KPIs per airline-month, and the summary of a whole data set."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarmac.functions.rates import percent, percent_of
from tarmac.model import CAUSE_MONTH
from tarmac.plans.gold import operated, percentile

CAUSES = {
    "Carrier": "CarrierDelay",
    "Weather": "WeatherDelay",
    "NAS": "NASDelay",
    "Security": "SecurityDelay",
    "Late Aircraft": "LateAircraftDelay",
}


def _punctual() -> Column:
    """Completed flights less than 15 minutes late, as the raw indicator has it."""
    return F.count_if(operated() & (F.col("ArrDel15") == 0))


def _per_airline_month(silver: DataFrame, *measures: Column) -> DataFrame:
    return silver.groupBy(*CAUSE_MONTH).agg(*measures)


def on_time_rate(silver: DataFrame) -> DataFrame:
    flown = F.count_if(operated())
    return _per_airline_month(
        silver,
        flown.alias("completed_flights"),
        _punctual().alias("on_time_arrivals"),
        percent(_punctual(), flown).alias("on_time_rate_pct"),
    )


def average_arrival_delay(silver: DataFrame) -> DataFrame:
    """Mean signed arrival delay of flights that were not cancelled."""
    mean = F.avg(F.when(operated(), F.col("ArrDelay")))
    return _per_airline_month(silver, F.round(mean, 2).alias("avg_arrival_delay"))


def cancellation_rate(silver: DataFrame) -> DataFrame:
    cancelled = F.count_if(F.col("is_cancelled"))
    return _per_airline_month(
        silver,
        F.count("*").alias("total_flights"),
        cancelled.alias("cancelled_flights"),
        percent(cancelled, F.count("*")).alias("cancellation_rate_pct"),
    )


def _minutes(column: str) -> Column:
    return F.coalesce(F.sum(column), F.lit(0.0))


def delay_cause_mix(silver: DataFrame) -> DataFrame:
    """Share of each of the five causes in the minutes that have a cause."""
    total = sum((_minutes(c) for c in CAUSES.values()), F.lit(0.0))
    shares = (
        percent(_minutes(column), total).alias(f"{name.lower().replace(' ', '_')}_pct")
        for name, column in CAUSES.items()
    )
    return _per_airline_month(silver, total.alias("caused_delay_minutes"), *shares)


def p95_arrival_delay(silver: DataFrame, accuracy: int | None = None) -> DataFrame:
    """95th percentile of the signed arrival delay."""
    return _per_airline_month(
        silver, percentile("ArrDelay", 0.95, accuracy).alias("p95_arrival_delay")
    )


def network_summary(silver: DataFrame) -> DataFrame:
    """Six rows over the whole data set: rates, the top cause, the most punctual
    airline and the airport with the longest mean departure delay.

    The flights are reduced to sums per airline and origin in one pass; totals,
    airlines and airports are grouping sets over those sums.
    """
    sums = silver.groupBy("airline_code", "origin_code").agg(
        F.count("*").alias("flights"),
        F.count_if(F.col("is_cancelled")).alias("cancelled"),
        _punctual().alias("punctual"),
        F.sum(F.when(operated(), F.col("ArrDelay"))).alias("arrival_delay"),
        F.count(F.when(operated(), F.col("ArrDelay"))).alias("arrivals"),
        F.sum(F.when(operated(), F.col("DepDelayMinutes"))).alias("departure_delay"),
        F.count(F.when(operated(), F.col("DepDelayMinutes"))).alias("departures"),
        *(F.sum(c).alias(c) for c in CAUSES.values()),
    )
    measures = [c for c in sums.columns if c not in {"airline_code", "origin_code"}]
    airline, origin = F.col("airline_code"), F.col("origin_code")
    grouped = sums.groupingSets([[], [airline], [origin]], airline, origin).agg(
        F.grouping_id(airline, origin).alias("level"),
        *(F.sum(c).alias(c) for c in measures),
    )
    # Levels by grouping_id: 3 the whole, 1 an airline, 2 an airport.
    on_time = percent_of(F.col("punctual"), F.col("flights") - F.col("cancelled"))
    departure = F.try_divide(F.col("departure_delay"), F.col("departures"))
    scored = grouped.withColumn(
        "score", F.when(F.col("level") == 1, on_time).when(F.col("level") == 2, departure)
    ).withColumn("code", F.coalesce("airline_code", "origin_code"))
    best_first = Window.partitionBy("level").orderBy(
        F.col("score").desc_nulls_last(), F.col("code").asc_nulls_last()
    )
    tops = scored.withColumn("place", F.row_number().over(best_first)).filter("place = 1")

    # Largest first, and of equal causes the first by name.
    causes = F.array(
        *(
            F.struct(-F.coalesce(F.col(c), F.lit(0.0)), F.lit(name).alias("name"))
            for name, c in CAUSES.items()
        )
    )
    caused = sum((F.coalesce(F.col(c), F.lit(0.0)) for c in CAUSES.values()), F.lit(0.0))
    top_cause = F.array_min(causes)

    def line(metric: str, label: Column, value: Column) -> Column:
        return F.struct(
            F.lit(metric).alias("metric"),
            label.cast("string").alias("label"),
            F.round(value, 2).alias("value"),
        )

    whole = F.array(
        line("on_time_rate_pct", F.lit(None), on_time),
        line(
            "avg_arrival_delay_minutes",
            F.lit(None),
            F.try_divide(F.col("arrival_delay"), F.col("arrivals")),
        ),
        line("cancellation_rate_pct", F.lit(None), percent_of(F.col("cancelled"), F.col("flights"))),
        line("top_delay_cause_pct", top_cause["name"], percent_of(-top_cause["col1"], caused)),
    )
    best = F.array(line("best_on_time_airline_pct", F.col("code"), F.col("score")))
    worst = F.array(line("worst_departure_delay_airport", F.col("code"), F.col("score")))
    lines = F.when(F.col("level") == 3, whole).when(F.col("level") == 1, best).otherwise(worst)
    return tops.select(F.inline(lines))
