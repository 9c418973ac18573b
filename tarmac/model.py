"""Schemas, column lists and labels of the flight model.

Everything in this module is a fixed value: names and bounds that stored tables
and their consumers agree on.
"""

from __future__ import annotations

# --- fixed values: raw monthly flight file, by position -----------------------

_CALENDAR = "Year INT, Quarter INT, Month INT, DayofMonth INT, DayOfWeek INT, FlightDate DATE"
_CARRIER = (
    "Reporting_Airline STRING, DOT_ID_Reporting_Airline INT, "
    "IATA_CODE_Reporting_Airline STRING, Tail_Number STRING, "
    "Flight_Number_Reporting_Airline INT"
)
_PLACE = (
    "{p}AirportID INT, {p}AirportSeqID INT, {p}CityMarketID INT, {p} STRING, "
    "{p}CityName STRING, {p}State STRING, {p}StateFips INT, {p}StateName STRING, {p}Wac INT"
)
_DEPARTURE = (
    "CRSDepTime INT, DepTime INT, DepDelay DOUBLE, DepDelayMinutes DOUBLE, "
    "DepDel15 DOUBLE, DepartureDelayGroups INT, DepTimeBlk STRING"
)
_TAXI = "TaxiOut DOUBLE, WheelsOff INT, WheelsOn INT, TaxiIn DOUBLE"
_ARRIVAL = (
    "CRSArrTime INT, ArrTime INT, ArrDelay DOUBLE, ArrDelayMinutes DOUBLE, "
    "ArrDel15 DOUBLE, ArrivalDelayGroups INT, ArrTimeBlk STRING"
)
_STATUS = "Cancelled DOUBLE, CancellationCode STRING, Diverted DOUBLE"
_ELAPSED = (
    "CRSElapsedTime DOUBLE, ActualElapsedTime DOUBLE, AirTime DOUBLE, "
    "Flights DOUBLE, Distance DOUBLE, DistanceGroup INT"
)
_CAUSES = (
    "CarrierDelay DOUBLE, WeatherDelay DOUBLE, NASDelay DOUBLE, "
    "SecurityDelay DOUBLE, LateAircraftDelay DOUBLE"
)
_GATE_RETURN = "FirstDepTime INT, TotalAddGTime DOUBLE, LongestAddGTime DOUBLE"
_DIVERSION = (
    "DivAirportLandings DOUBLE, DivReachedDest DOUBLE, DivActualElapsedTime DOUBLE, "
    "DivArrDelay DOUBLE, DivDistance DOUBLE"
)
_DIVERSION_LEG = (
    "Div{n}Airport STRING, Div{n}AirportID INT, Div{n}AirportSeqID INT, "
    "Div{n}WheelsOn INT, Div{n}TotalGTime DOUBLE, Div{n}LongestGTime DOUBLE, "
    "Div{n}WheelsOff INT, Div{n}TailNum STRING"
)

TRAILING_FIELD = "_c109"
CORRUPT_FIELD = "_corrupt_record"

# Every raw line ends with a comma, so the parser needs one more (always empty)
# field than there is data; without it each line would count as corrupt.
RAW_FLIGHT_SCHEMA = ", ".join(
    [
        _CALENDAR,
        _CARRIER,
        _PLACE.format(p="Origin"),
        _PLACE.format(p="Dest"),
        _DEPARTURE,
        _TAXI,
        _ARRIVAL,
        _STATUS,
        _ELAPSED,
        _CAUSES,
        _GATE_RETURN,
        _DIVERSION,
        *(_DIVERSION_LEG.format(n=n) for n in range(1, 6)),
        f"{TRAILING_FIELD} STRING",
        f"{CORRUPT_FIELD} STRING",
    ]
)
RAW_FLIGHT_FIELDS = [tuple(field.split(" ")) for field in RAW_FLIGHT_SCHEMA.split(", ")]

AIRPORT_SCHEMA = (
    "city STRING, code STRING, country STRING, elevation BIGINT, iata STRING, "
    "icao STRING, lat DOUBLE, lon DOUBLE, name STRING, state STRING, tz STRING"
)

# --- fixed values: columns kept from the raw file, in table order -------------

FLIGHT_COLUMNS = [
    "FlightDate", "Reporting_Airline", "IATA_CODE_Reporting_Airline", "Tail_Number",
    "Flight_Number_Reporting_Airline",
    "Origin", "OriginCityName", "OriginState",
    "Dest", "DestCityName", "DestState",
    "CRSDepTime", "DepTime", "DepDelay", "DepDelayMinutes", "DepDel15", "DepartureDelayGroups",
    "CRSArrTime", "ArrTime", "ArrDelay", "ArrDelayMinutes", "ArrDel15", "ArrivalDelayGroups",
    "Cancelled", "CancellationCode", "Diverted",
    "CRSElapsedTime", "ActualElapsedTime", "AirTime", "Flights", "Distance", "DistanceGroup",
    "CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay",
]

FLIGHT_TYPES = {name: kind for name, kind in RAW_FLIGHT_FIELDS if name in set(FLIGHT_COLUMNS)}

# One scheduled flight.
FLIGHT_KEY = [
    "FlightDate", "Reporting_Airline", "Flight_Number_Reporting_Airline", "Origin", "Dest",
]

# --- fixed values: data-quality flags -----------------------------------------

NULL_FLAGS = {
    "flight_date_null": "FlightDate",
    "reporting_airline_null": "Reporting_Airline",
    "origin_null": "Origin",
    "destination_null": "Dest",
    "distance_null": "Distance",
    "arrival_delay_null": "ArrDelay",
    "departure_delay_null": "DepDelay",
    "cancelled_null": "Cancelled",
}
# The row total leaves the cancellation flag out.
STATUS_FLAGS = [name for name in NULL_FLAGS if name != "cancelled_null"]

RANGE_FLAGS = ["departure_delay_range_flag", "same_origin_destination", "check_distance_range"]
DEPARTURE_DELAY_MINUTES = (-120, 1440)
DISTANCE_MILES = (1, 10000)

NULL_PROFILE_COLUMNS = [
    "Origin", "Cancelled", "Distance", "ArrDelay", "DepDelay", "Reporting_Airline",
]

# Flagged share of all rows, in percent, below which a load is as expected.
EXPECTED_FLAG_PCT = {
    "flight_date_null": 0.001,
    "reporting_airline_null": 0.001,
    "origin_null": 0.001,
    "destination_null": 0.001,
    "departure_delay_range_flag": 0.1,
    "check_distance_range": 0.01,
    "same_origin_destination": 0.001,
}

# --- fixed values: labels -----------------------------------------------------

# (label, lowest minute, highest minute), both inclusive.
DELAY_BANDS = [
    ("On Time", 0, 14),
    ("Minor Delay", 15, 44),
    ("Major Delay", 45, 120),
]

CANCELLATION_REASONS = {
    "A": "Carrier",
    "B": "Weather",
    "C": "National_Security",
    "D": "Security_Concern",
}

HOME_COUNTRY = "US"
EARTH_RADIUS_KM = 6371.0

# --- fixed values: grouping keys ----------------------------------------------

AIRLINE_MONTH = ["flight_year", "flight_month", "airline_code", "Reporting_Airline"]
ROUTE_YEAR = ["flight_year", "route", "origin_code", "destination_code"]
DEPARTURE_MONTH = [
    "flight_year", "flight_month", "origin_code",
    "origin_airport_name", "origin_airport_city", "origin_airport_state",
    "origin_lon", "origin_lat",
]
CAUSE_MONTH = ["flight_year", "flight_month", "airline_code"]

# --- fixed values: columns of the Gold tables, in table order -------------------

GOLD_COLUMNS = {
    "gold_airline_kpi": [
        "flight_year", "flight_month", "airline_code", "Reporting_Airline",
        "total_number_of_flights", "delayed_flights", "total_flights_cancelled", "diverted_flights",
        "non_cancelled_flights", "avg_arrival_delay_minutes", "median_arrival_delay_minutes",
        "on_time_flights", "on_time_flight_percentage",
        "cancelled_flights", "cancelled_flight_percentage",
        "avg_carrier_delay", "avg_weather_delay", "avg_security_delay", "avg_late_aircraft_delay",
        "avg_distance_travelled", "total_distance_travelled", "monthly_rank",
    ],
    "gold_route_kpi": [
        "flight_year", "route", "origin_code", "destination_code",
        "number_of_flights", "avg_arrival_delay", "avg_distance_travelled", "total_delayed_flights",
        "total_on_time_flights", "number_of_airlines_on_route", "on_time_percentage_airline_percentage",
    ],
    "gold_airport_departure_kpi": [
        "flight_year", "flight_month", "origin_code", "origin_airport_name", "origin_airport_city",
        "origin_airport_state", "origin_lon", "origin_lat",
        "total_departure", "total_cancelled_departure", "avg_departure_delay_minutes",
        "avg_route_distance", "number_of_flights_operating", "avg_airtime", "departure_on_time_percentage",
    ],
    "delay_cause_table": [
        "flight_year", "flight_month", "airline_code",
        "total_minutes_delayed", "total_weather_delayed_minutes", "total_carrier_delayed_minutes",
        "total_security_delayed_minutes", "total_late_aircraft_delayed_minutes",
        "weather_delay_percentage", "carrier_delay_percentage", "security_delay_percentage",
        "late_aircraft_delay_percentage",
    ],
}
