from __future__ import annotations

import datetime as dt
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tarmac.model import FLIGHT_COLUMNS, FLIGHT_TYPES  # noqa: E402
from tarmac.session import local_session  # noqa: E402

DEFAULTS = {
    "FlightDate": dt.date(2021, 3, 14),
    "Reporting_Airline": "AA",
    "IATA_CODE_Reporting_Airline": "aa",
    "Flight_Number_Reporting_Airline": 100,
    "Origin": "N01",
    "Dest": "N02",
    "CRSDepTime": 900,
    "CRSArrTime": 1100,
    "DepDelay": 0.0,
    "DepDelayMinutes": 0.0,
    "DepDel15": 0.0,
    "ArrDelay": 0.0,
    "ArrDelayMinutes": 0.0,
    "ArrDel15": 0.0,
    "ArrivalDelayGroups": 0,
    "Cancelled": 0.0,
    "Diverted": 0.0,
    "AirTime": 100.0,
    "Distance": 500.0,
    "load_timestamp": dt.datetime(2021, 4, 1),
}

AIRPORT_DDL = (
    "city string, code string, country string, elevation bigint, iata string, icao string, "
    "lat double, lon double, name string, state string, tz string"
)


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, shuffle_partitions=4, memory="6g")
    session.conf.set("spark.sql.maxMetadataStringLength", "10000")
    return session


@pytest.fixture(scope="session")
def make_flights(spark):
    """Flights from partial rows; columns not given take ordinary values."""
    schema = ", ".join(f"{c} {FLIGHT_TYPES[c]}" for c in FLIGHT_COLUMNS) + ", load_timestamp TIMESTAMP"

    def build(*rows):
        names = [*FLIGHT_COLUMNS, "load_timestamp"]
        full = [tuple({**DEFAULTS, **row}.get(c) for c in names) for row in rows]
        return spark.createDataFrame(full, schema)

    return build


def airport(iata, country="US", lat=30.0, lon=-90.0, name=None):
    return (f"City {iata}", iata, country, 10, iata, f"K{iata}", lat, lon, name or iata, "ST", "TZ")


@pytest.fixture(scope="session")
def make_airports(spark):
    def build(*rows):
        return spark.createDataFrame([airport(*row) for row in rows], AIRPORT_DDL)

    return build
