"""The airport dimension and its two roles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.model import HOME_COUNTRY
from tarmac.operators.lookup import fits_broadcast, lookup_join

ROLE_KEYS = {"origin": "origin_code", "dest": "destination_code"}


def home_airports(airports: DataFrame, country: str = HOME_COUNTRY) -> DataFrame:
    return airports.filter(F.col("country") == country)


def airport_role(airports: DataFrame, role: str) -> DataFrame:
    """The dimension under the names of one role (``origin`` or ``dest``).

    One row per code: of several, the smallest by content. Grouping (rather than
    a window) also tells Catalyst that the code is unique, so a query that reads
    no airport column drops the join.
    """
    attributes = {
        "name": f"{role}_airport_name",
        "city": f"{role}_airport_city",
        "state": f"{role}_airport_state",
        "lat": f"{role}_lat",
        "lon": f"{role}_lon",
        "tz": f"{role}_timezone",
    }
    pick = F.min(F.struct(*attributes)).alias("pick")
    return (
        airports.groupBy("iata")
        .agg(pick)
        .select(
            F.col("iata").alias(f"{role}_iata"),
            *(F.col(f"pick.{c}").alias(alias) for c, alias in attributes.items()),
        )
    )


def with_airport(
    flights: DataFrame, airports: DataFrame, role: str, broadcast: bool | None = None
) -> DataFrame:
    """Flights with the airport columns of one role; NULL where no airport matches."""
    view = airport_role(airports, role)
    joined = lookup_join(flights, view, {ROLE_KEYS[role]: f"{role}_iata"}, "left", broadcast)
    return joined.drop(f"{role}_iata")


def with_both_airports(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Both roles, with one size check for the dimension they share."""
    small = fits_broadcast(airports)
    flights = with_airport(flights, airports, "origin", small)
    return with_airport(flights, airports, "dest", small)


def departing_from(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Flights whose origin is in the dimension. Never multiplies rows."""
    keys = airports.select(F.col("iata").alias("_iata"))
    return lookup_join(flights, keys, {"origin_code": "_iata"}, "left_semi")


def joined_on_origin(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Flights inner-joined to the dimension, with the dimension's own columns."""
    return lookup_join(flights, airports, {"origin_code": "iata"}, "inner")


def unmatched_codes(flights: DataFrame, airports: DataFrame) -> DataFrame:
    """Airport codes that flights use and the dimension lacks, with flights per role."""
    roles = F.inline(
        F.array(
            *(
                F.struct(F.col(column).alias("airport_code"), F.lit(role).alias("role"))
                for role, column in ROLE_KEYS.items()
            )
        )
    )
    # Count per code pair first: the unpivot and the join then see only pairs.
    pairs = flights.groupBy(*ROLE_KEYS.values()).agg(F.count("*").alias("n"))
    codes = (
        pairs.select("n", roles)
        .groupBy("airport_code", "role")
        .agg(F.sum("n").alias("flights"))
    )
    keys = airports.select(F.col("iata").alias("_iata"))
    return lookup_join(codes, keys, {"airport_code": "_iata"}, "left_anti")
