"""Reporting views, as SQL over the stored Silver and Gold tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# View name -> (tables it reads, query). Braces take the table names.
VIEWS = {
    # Airlines of a year, ranked by the share of flights that arrived on time.
    "vw_airline_scorecard": """
        WITH yearly AS (
          SELECT flight_year, airline_code,
                 count(*) AS total_flights,
                 count_if(NOT is_cancelled AND NOT is_arrival_delayed) AS on_time_flights,
                 count_if(is_cancelled) AS cancelled_flights,
                 avg(CASE WHEN NOT is_cancelled THEN ArrDelayMinutes END) AS mean_delay
          FROM {silver}
          GROUP BY flight_year, airline_code)
        SELECT flight_year, airline_code, total_flights,
               round(on_time_flights / total_flights * 100, 2) AS on_time_percentage,
               round(cancelled_flights / total_flights * 100, 2) AS cancelled_percentage,
               round(mean_delay, 2) AS avg_arrival_delay,
               dense_rank() OVER (PARTITION BY flight_year
                                  ORDER BY on_time_flights / total_flights DESC) AS annual_rank
        FROM yearly
    """,
    # Meteorological seasons: winter is December to February.
    "vw_delay_trend_monthly": """
        SELECT flight_year, flight_month, flight_quarter,
               CASE WHEN flight_month IN (12, 1, 2) THEN 'Winter'
                    WHEN flight_month <= 5 THEN 'Spring'
                    WHEN flight_month <= 8 THEN 'Summer'
                    WHEN flight_month <= 11 THEN 'Autumn' END AS season,
               count(*) AS total_flights,
               round(avg(CASE WHEN NOT is_cancelled THEN ArrDelayMinutes END), 2)
                 AS avg_arrival_delay,
               round(count_if(NOT is_cancelled AND NOT is_arrival_delayed) / count(*) * 100, 2)
                 AS on_time_percentage
        FROM {silver}
        GROUP BY flight_year, flight_month, flight_quarter
    """,
    "vw_airport_performance_map": """
        SELECT flight_year, flight_month, origin_code, origin_airport_name,
               origin_airport_city, origin_airport_state, origin_lat, origin_lon,
               total_departure, total_cancelled_departure, avg_departure_delay_minutes,
               departure_on_time_percentage
        FROM {departures}
    """,
}


def create_reporting_views(
    spark: SparkSession,
    silver: str = "silver_flights",
    departures: str = "gold_airport_departure_kpi",
    database: str | None = None,
) -> list[str]:
    """Create or replace the views over the named tables; returns their names.

    With a database the views are stored in the catalog; without one they last
    as long as the session, and the names may be those of temporary views.
    """
    names = []
    for name, query in VIEWS.items():
        kind, target = ("VIEW", f"`{database}`.`{name}`") if database else ("TEMPORARY VIEW", name)
        body = query.format(silver=silver, departures=departures)
        spark.sql(f"CREATE OR REPLACE {kind} {target} AS {body}")
        names.append(target)
    return names


def reporting_view(
    spark: SparkSession, name: str, silver: DataFrame | None, departures: DataFrame | None = None
) -> DataFrame:
    """One view over DataFrames instead of stored tables."""
    frames = {k: v for k, v in {"silver": silver, "departures": departures}.items() if v is not None}
    return spark.sql(VIEWS[name], **frames)
