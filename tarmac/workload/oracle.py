"""The same queries in DuckDB SQL over the same tables, with expressions and lists of its own."""

from __future__ import annotations

# Fixed values, stated again so that the oracle does not lean on the code it checks.
FLIGHT_COLUMNS = (
    "FlightDate Reporting_Airline IATA_CODE_Reporting_Airline Tail_Number Flight_Number_Reporting_Airline "
    "Origin OriginCityName OriginState Dest DestCityName DestState CRSDepTime DepTime DepDelay "
    "DepDelayMinutes DepDel15 DepartureDelayGroups CRSArrTime ArrTime ArrDelay ArrDelayMinutes ArrDel15 "
    "ArrivalDelayGroups Cancelled CancellationCode Diverted CRSElapsedTime ActualElapsedTime AirTime "
    "Flights Distance DistanceGroup CarrierDelay WeatherDelay NASDelay SecurityDelay LateAircraftDelay"
).split()
FLIGHT_KEY = "FlightDate Reporting_Airline Flight_Number_Reporting_Airline Origin Dest".split()
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
STATUS_FLAGS = [name for name in NULL_FLAGS if name != "cancelled_null"]
NULL_PROFILE_COLUMNS = "Origin Cancelled Distance ArrDelay DepDelay Reporting_Airline".split()
EXPECTED_FLAG_PCT = {
    "flight_date_null": 0.001,
    "reporting_airline_null": 0.001,
    "origin_null": 0.001,
    "destination_null": 0.001,
    "departure_delay_range_flag": 0.1,
    "check_distance_range": 0.01,
    "same_origin_destination": 0.001,
}


def _r(value: str, places: int = 2) -> str:
    """Round half up on the printed decimal, as Spark rounds a double."""
    return f"cast(round(cast(cast(({value}) AS varchar) AS decimal(38, 18)), {places}) AS double)"


def _pct(part: str, whole: str, places: int = 2) -> str:
    return _r(f"({part}) / nullif({whole}, 0) * 100", places)


def _big(value: str) -> str:
    return f"cast({value} AS bigint)"


def _cols(names, prefix: str = "") -> str:
    return ", ".join(f"{prefix}{n}" for n in names)


# --- shared subqueries ---------------------------------------------------------

_BASE = """base AS (
  SELECT *, l_returnflag = 'R' AND l_quantity > 45 AS cx,
         date_diff('day', cast(o_orderdate AS date), cast(l_shipdate AS date)) AS days
  FROM lineitem
  LEFT JOIN orders ON l_orderkey = o_orderkey
  LEFT JOIN supplier ON l_suppkey = s_suppkey
  LEFT JOIN customer ON o_custkey = c_custkey)"""

_DELAYS = """delays AS (
  SELECT *, CASE WHEN cx THEN NULL ELSE cast(days AS double) END AS dep,
         CASE WHEN cx THEN NULL ELSE cast(days % 181 AS double) END AS arr,
         CASE WHEN cx THEN NULL WHEN l_linenumber = 7 THEN cast(days % 181 AS double)
              ELSE greatest(cast(days % 181 AS double), 0e0) END AS arr_minutes
  FROM base)"""

_EXPRESSIONS = {
    "FlightDate": "cast(l_shipdate AS date)",
    "Reporting_Airline": "'Al' || lpad(cast(l_suppkey % 20 AS varchar), 2, '0')",
    "IATA_CODE_Reporting_Airline": "'al' || lpad(cast(l_suppkey % 20 AS varchar), 2, '0')",
    "Tail_Number": "'N' || cast(l_orderkey % 5000 AS varchar)",
    "Flight_Number_Reporting_Airline": "cast(l_partkey AS integer)",
    "Origin": "'n' || lpad(cast(s_nationkey AS varchar), 2, '0')",
    "OriginCityName": "cast(NULL AS varchar)",
    "OriginState": "cast(NULL AS varchar)",
    "Dest": "'n' || lpad(cast(c_nationkey AS varchar), 2, '0')",
    "DestCityName": "cast(NULL AS varchar)",
    "DestState": "cast(NULL AS varchar)",
    "CRSDepTime": """CASE WHEN l_suppkey % 97 = 0 THEN NULL
      WHEN l_orderkey % 24 = 0 AND l_partkey % 60 = 0 THEN 2400
      ELSE cast((l_orderkey % 24) * 100 + l_partkey % 60 AS integer) END""",
    "DepTime": "cast(NULL AS integer)",
    "DepDelay": "dep",
    "DepDelayMinutes": "CASE WHEN cx THEN NULL ELSE greatest(dep, 0e0) END",
    "DepDel15": "CASE WHEN dep IS NULL THEN NULL WHEN dep >= 15 THEN 1e0 ELSE 0e0 END",
    "DepartureDelayGroups": "cast(NULL AS integer)",
    "CRSArrTime": """CASE WHEN l_suppkey % 97 = 0 THEN NULL
      WHEN l_orderkey % 24 = 12 AND l_partkey % 60 = 0 THEN 2400
      ELSE cast(((l_orderkey + 3) % 24) * 100 + (l_partkey * 7) % 60 AS integer) END""",
    "ArrTime": "cast(NULL AS integer)",
    "ArrDelay": "arr",
    "ArrDelayMinutes": "arr_minutes",
    "ArrDel15": "CASE WHEN arr IS NULL THEN NULL WHEN arr >= 15 THEN 1e0 ELSE 0e0 END",
    "ArrivalDelayGroups": """CASE WHEN arr IS NULL THEN NULL
      ELSE cast(least(greatest(floor(arr / 15), -2), 12) AS integer) END""",
    "Cancelled": "CASE WHEN cx THEN 1e0 ELSE 0e0 END",
    "CancellationCode": """CASE WHEN cx THEN CASE l_linenumber % 5 WHEN 0 THEN 'A' WHEN 1 THEN 'B'
      WHEN 2 THEN 'C' WHEN 3 THEN 'D' ELSE 'Z' END END""",
    "Diverted": "CASE WHEN l_linestatus = 'F' AND l_quantity = 1 THEN 1e0 ELSE 0e0 END",
    "CRSElapsedTime": "cast(NULL AS double)",
    "ActualElapsedTime": "cast(NULL AS double)",
    "AirTime": "CASE WHEN cx THEN NULL ELSE l_quantity * 6 END",
    "Flights": "cast(NULL AS double)",
    "Distance": "CASE WHEN l_suppkey % 89 = 0 THEN NULL ELSE floor(l_extendedprice / 10) END",
    "DistanceGroup": "cast(NULL AS integer)",
    "CarrierDelay": "CASE WHEN arr_minutes >= 15 THEN floor(arr_minutes / 2) END",
    "WeatherDelay": "CASE WHEN arr_minutes >= 15 THEN floor(arr_minutes / 4) END",
    "NASDelay": "CASE WHEN arr_minutes >= 15 THEN floor(arr_minutes / 8) END",
    "SecurityDelay": "CASE WHEN arr_minutes >= 15 THEN floor(arr_minutes / 16) END",
    "LateAircraftDelay": """CASE WHEN arr_minutes >= 15 THEN arr_minutes - floor(arr_minutes / 2)
      - floor(arr_minutes / 4) - floor(arr_minutes / 8) - floor(arr_minutes / 16) END""",
}

_FILED = """filed AS (
  SELECT {columns},
    cast(cast(o_orderdate AS date) AS timestamp) AS load_timestamp,
    {filing} AS filing_id, l_orderkey, l_linenumber
  FROM delays)""".format(
    columns=",\n    ".join(f"{_EXPRESSIONS[c]} AS {c}" for c in FLIGHT_COLUMNS),
    filing="""concat_ws('|', l_orderkey, l_linenumber, l_suppkey, cast(floor(l_quantity * 100 + 0.5e0) AS bigint),
      cast(floor(l_extendedprice * 100 + 0.5e0) AS bigint), l_returnflag, l_linestatus)""",
)

_FLIGHTS = """flights AS (
  SELECT * FROM filed
  UNION ALL
  SELECT * REPLACE (load_timestamp + INTERVAL 1 DAY AS load_timestamp) FROM filed
  WHERE l_linenumber = 1)"""

_AIRPORTS = """airports AS (
  SELECT 'City_' || n_nationkey AS city, 'N' || lpad(cast(n_nationkey AS varchar), 2, '0') AS code,
         CASE WHEN n_nationkey < 20 THEN 'US' ELSE 'CA' END AS country,
         cast(n_nationkey * 10 AS bigint) AS elevation,
         'N' || lpad(cast(n_nationkey AS varchar), 2, '0') AS iata,
         'KN' || lpad(cast(n_nationkey AS varchar), 2, '0') AS icao,
         25e0 + n_nationkey AS lat, -120e0 + 2e0 * n_nationkey AS lon,
         n_name AS name, r_name AS state, r_name AS tz
  FROM nation JOIN region ON n_regionkey = r_regionkey),
us AS (SELECT * FROM airports WHERE country = 'US')"""

_FLAGS = {
    **{name: f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for name, c in NULL_FLAGS.items()},
    "departure_delay_range_flag": "CASE WHEN DepDelay >= -120 AND DepDelay <= 1440 THEN 0 ELSE 1 END",
    "same_origin_destination": "CASE WHEN Origin = Dest THEN 1 ELSE 0 END",
    "check_distance_range": "CASE WHEN Distance >= 1 AND Distance <= 10000 THEN 0 ELSE 1 END",
}


def _as(expressions: dict[str, str]) -> str:
    return ",\n    ".join(f"{sql} AS {name}" for name, sql in expressions.items())


_BRONZE = f"""bronze AS (
  SELECT {_cols(FLIGHT_COLUMNS)}, {_as(_FLAGS)}, cast(NULL AS varchar) AS corrupt_record,
         load_timestamp, filing_id, l_orderkey, l_linenumber,
         cast(year(FlightDate) AS integer) AS year, cast(month(FlightDate) AS integer) AS month
  FROM flights)"""

_ORDER = "load_timestamp DESC NULLS LAST, filing_id ASC NULLS LAST"
_NUMBERED = f"""numbered AS (
  SELECT *, row_number() OVER (PARTITION BY {_cols(FLIGHT_KEY)} ORDER BY {_ORDER}) AS row_num
  FROM bronze),
kept AS (SELECT * EXCLUDE (row_num, l_orderkey, l_linenumber) FROM numbered WHERE row_num = 1)"""


def _label(column: str, midnight: bool) -> str:
    digits = (
        f"lpad(cast(cast(floor({column} / 100.0) AS integer) AS varchar), 2, '0') || ':' || "
        f"lpad(cast({column} % 100 AS varchar), 2, '0')"
    )
    case = f"WHEN {column} = 2400 THEN '00:00' " if midnight else ""
    return f"CASE WHEN {column} IS NULL THEN NULL {case}ELSE {digits} END"


def _minutes(column: str) -> str:
    return (
        f"CASE WHEN {column} IS NULL THEN NULL WHEN {column} = 2400 THEN 0 "
        f"ELSE cast(floor({column} / 100.0) * 60 + {column} % 100 AS bigint) END"
    )


_FLAG_COLUMNS = {
    "is_cancelled": "coalesce(Cancelled = 1, false)",
    "is_diverted": "coalesce(Diverted = 1, false)",
    "is_departure_delayed": "coalesce(DepDel15 = 1, false)",
    "is_arrival_delayed": "coalesce(ArrivalDelayGroups > 0, false)",
}
_CATEGORY = """CASE WHEN Cancelled = 1 THEN 'Cancelled' WHEN ArrDelayMinutes < 0 THEN 'Early'
    WHEN ArrDelayMinutes >= 0 AND ArrDelayMinutes <= 14 THEN 'On Time'
    WHEN ArrDelayMinutes >= 15 AND ArrDelayMinutes <= 44 THEN 'Minor Delay'
    WHEN ArrDelayMinutes >= 45 AND ArrDelayMinutes <= 120 THEN 'Major Delay'
    WHEN ArrDelayMinutes > 120 THEN 'Severe Delay' END"""
_DATES = {
    "flight_year": "cast(year(FlightDate) AS integer)",
    "flight_month": "cast(month(FlightDate) AS integer)",
    "flight_quarter": "cast(quarter(FlightDate) AS integer)",
    "day_of_week": "cast(dayofweek(FlightDate) + 1 AS integer)",
}
_CODES = {
    "airline_code": "upper(IATA_CODE_Reporting_Airline)",
    "origin_code": "upper(Origin)",
    "destination_code": "upper(Dest)",
}
_REASON = """CASE CancellationCode WHEN 'A' THEN 'Carrier' WHEN 'B' THEN 'Weather'
    WHEN 'C' THEN 'National_Security' WHEN 'D' THEN 'Security_Concern' END"""

_FEATURES = {
    "crs_dep_time_std": _label("CRSDepTime", True),
    "crs_arr_time_std": _label("CRSArrTime", True),
    "crs_dep_minutes": _minutes("CRSDepTime"),
    "crs_arr_minutes": _minutes("CRSArrTime"),
    **_FLAG_COLUMNS,
    "arrival_delay_category": _CATEGORY,
    **_DATES,
    **_CODES,
    "cancellation_reason": _REASON,
}

_FEATURED = f"featured AS (SELECT *, {_as(_FEATURES)} FROM kept)"


def _role(role: str) -> str:
    columns = {
        "name": f"{role}_airport_name",
        "city": f"{role}_airport_city",
        "state": f"{role}_airport_state",
        "lat": f"{role}_lat",
        "lon": f"{role}_lon",
        "tz": f"{role}_timezone",
    }
    return ", ".join(f"{role[0]}.{c} AS {alias}" for c, alias in columns.items())


_KM = """6371.0 * 2 * atan2(sqrt(h), sqrt(1.0 - h))"""
_H = """pow(sin(radians(dest_lat - origin_lat) / 2), 2)
    + cos(radians(origin_lat)) * cos(radians(dest_lat)) * pow(sin(radians(dest_lon - origin_lon) / 2), 2)"""
_EXTRACT = """nullif(substr(cast(Flight_Number_Reporting_Airline AS varchar), 1, 1)
    || substr(cast(Flight_Number_Reporting_Airline AS varchar), 4, 1)
    || substr(cast(Flight_Number_Reporting_Airline AS varchar), 7, 1), '')"""


def _with_airports(name: str, source: str) -> str:
    return f"""{name}_placed AS (
  SELECT f.*, {_role('origin')}, {_role('dest')}
  FROM {source} f LEFT JOIN us o ON f.origin_code = o.iata LEFT JOIN us d ON f.destination_code = d.iata),
{name}_arcs AS (SELECT *, {_H} AS h FROM {name}_placed),
{name} AS (SELECT * EXCLUDE (h), {_KM} AS haversine_distance_km FROM {name}_arcs)"""


_SILVER = _with_airports("silver", "featured")
_CODED = f"coded AS (SELECT *, {_as(_CODES)} FROM flights)"
_PLACED = _with_airports("placed", "coded")

_RAW = [_BASE, _DELAYS, _FILED, _FLIGHTS]


def _flights(select: str) -> str:
    return "WITH " + ",\n".join(_RAW) + "\n" + select


def _bronze(select: str) -> str:
    return "WITH " + ",\n".join([*_RAW, _BRONZE]) + "\n" + select


def _numbered(select: str) -> str:
    return "WITH " + ",\n".join([*_RAW, _BRONZE, _NUMBERED]) + "\n" + select


def _featured(select: str, *more: str) -> str:
    parts = [*_RAW, _BRONZE, _NUMBERED, _FEATURED, *more]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _silver(select: str, *more: str) -> str:
    parts = [*_RAW, _AIRPORTS, _BRONZE, _NUMBERED, _FEATURED, _SILVER, *more]
    return "WITH " + ",\n".join(parts) + "\n" + select


def _merged(select: str) -> str:
    """Flights of which those with a line 1 in 1997 were filed again, later."""
    merged = f"""merged AS (
  SELECT {_cols(FLIGHT_KEY)}, cast(year(FlightDate) AS integer) AS year, cast(month(FlightDate) AS integer) AS month,
         bool_or(l_linenumber = 1 AND year(FlightDate) = 1997) AS again, any_value(us.name) AS name
  FROM flights LEFT JOIN us ON upper(Origin) = us.iata GROUP BY {_cols(FLIGHT_KEY)})"""
    return "WITH " + ",\n".join([*_RAW, _AIRPORTS, merged]) + "\n" + select


def _placed(select: str, *more: str) -> str:
    parts = [*_RAW, _AIRPORTS, _CODED, _PLACED, *more]
    return "WITH " + ",\n".join(parts) + "\n" + select


_DAY = "strftime(FlightDate, '%Y-%m-%d') AS FlightDate"
_LOADED = "strftime(load_timestamp, '%Y-%m-%d %H:%M:%S') AS load_timestamp"
_PRINTED = f"* REPLACE ({_DAY}, {_LOADED})"
_PRINTED_FLIGHT = ", ".join(_DAY if c == "FlightDate" else c for c in FLIGHT_COLUMNS)
_KEYS = "l_orderkey, l_linenumber"


def _feature(sources: str, features: dict[str, str]) -> str:
    return _flights(f"SELECT {_KEYS}, {sources}, {_as(features)} FROM flights")


# --- Gold ----------------------------------------------------------------------

_GROUP = "flight_year, flight_month, airline_code, Reporting_Airline"
_ON_TIME = "count(*) FILTER (NOT is_cancelled AND NOT is_arrival_delayed)"
_CANCELLED = "count(*) FILTER (is_cancelled)"
_TOTAL = "count(*) AS total_number_of_flights"
_BASE_COUNTS = f"""{_TOTAL}, count(*) FILTER (is_arrival_delayed) AS delayed_flights,
    {_CANCELLED} AS total_flights_cancelled, count(*) FILTER (is_diverted) AS diverted_flights"""
_DELAY_STATS = """nullif(count(*) FILTER (NOT is_cancelled), 0) AS non_cancelled_flights,
    avg(ArrDelayMinutes) FILTER (NOT is_cancelled) AS avg_arrival_delay_minutes,
    quantile_disc(ArrDelayMinutes, 0.5) FILTER (NOT is_cancelled) AS median_arrival_delay_minutes"""
_ON_TIME_COUNTS = f"""{_ON_TIME} AS on_time_flights,
    {_pct(_ON_TIME, 'count(*)')} AS on_time_flight_percentage"""
_CANCELLED_COUNTS = f"""{_CANCELLED} AS cancelled_flights,
    {_pct(_CANCELLED, 'count(*)')} AS cancelled_flight_percentage"""
_CAUSE_MEANS = f"""{_r('avg(CarrierDelay)')} AS avg_carrier_delay,
    {_r('avg(WeatherDelay)')} AS avg_weather_delay,
    {_r('avg(SecurityDelay)')} AS avg_security_delay,
    {_r('avg(LateAircraftDelay)')} AS avg_late_aircraft_delay"""
_DISTANCES = f"""{_r('avg(Distance)')} AS avg_distance_travelled,
    {_r('sum(Distance)', 0)} AS total_distance_travelled"""


def _airline(measures: str, source: str = "featured") -> str:
    return f"SELECT {_GROUP}, {measures} FROM {source} GROUP BY {_GROUP}"


_RANK = """cast(dense_rank() OVER (PARTITION BY flight_year, flight_month
    ORDER BY total_number_of_flights DESC) AS integer) AS monthly_rank"""

_ALL_MEASURES = ", ".join(
    [_BASE_COUNTS, _DELAY_STATS, _ON_TIME_COUNTS, _CANCELLED_COUNTS, _CAUSE_MEANS, _DISTANCES]
)
_AIRLINE_KPI = _featured(f"SELECT *, {_RANK} FROM ({_airline(_ALL_MEASURES)})")

_ROUTED = """routed AS (
  SELECT *, concat_ws('-', origin_code, destination_code) AS route FROM featured)"""
_ROUTE = f"""SELECT flight_year, route, origin_code, destination_code,
    count(*) AS number_of_flights,
    {_r('avg(ArrDelayMinutes) FILTER (NOT is_cancelled)')} AS avg_arrival_delay,
    {_r('avg(Distance)')} AS avg_distance_travelled,
    count(*) FILTER (is_arrival_delayed) AS total_delayed_flights,
    {_ON_TIME} AS total_on_time_flights,
    count(DISTINCT airline_code) AS number_of_airlines_on_route,
    {_pct(_ON_TIME, 'count(*)')} AS on_time_percentage_airline_percentage
  FROM routed GROUP BY flight_year, route, origin_code, destination_code"""

_DEPARTURE_GROUP = """flight_year, flight_month, origin_code, origin_airport_name,
    origin_airport_city, origin_airport_state, origin_lon, origin_lat"""
_DEPARTURES = f"""SELECT {_DEPARTURE_GROUP}, count(*) AS total_departure,
    {_CANCELLED} AS total_cancelled_departure,
    {_r('avg(DepDelayMinutes) FILTER (NOT is_cancelled)')} AS avg_departure_delay_minutes,
    {_r('avg(Distance)')} AS avg_route_distance,
    count(*) AS number_of_flights_operating,
    {_r('avg(AirTime) FILTER (NOT is_cancelled)')} AS avg_airtime,
    {_pct('count(*) FILTER (NOT is_departure_delayed)', 'count(*)')} AS departure_on_time_percentage
  FROM silver WHERE origin_code IN (SELECT iata FROM us) GROUP BY {_DEPARTURE_GROUP}"""

_CAUSE_GROUP = "flight_year, flight_month, airline_code"
_CAUSE = f"""causes AS (
  SELECT {_CAUSE_GROUP}, {_r('sum(ArrDelayMinutes)')} AS total_minutes_delayed,
    {_r('sum(WeatherDelay)')} AS total_weather_delayed_minutes,
    {_r('sum(CarrierDelay)')} AS total_carrier_delayed_minutes,
    {_r('sum(SecurityDelay)')} AS total_security_delayed_minutes,
    {_r('sum(LateAircraftDelay)')} AS total_late_aircraft_delayed_minutes
  FROM featured WHERE NOT is_cancelled AND ArrDelayMinutes > 0 GROUP BY {_CAUSE_GROUP})"""
_CAUSE_TABLE = "SELECT *, " + ", ".join(
    f"{_pct(f'total_{c}_delayed_minutes', 'total_minutes_delayed')} AS {c}_delay_percentage"
    for c in ("weather", "carrier", "security", "late_aircraft")
) + " FROM causes"

# --- KPIs ----------------------------------------------------------------------

_FLOWN = "count(*) FILTER (NOT is_cancelled)"
_PUNCTUAL = "count(*) FILTER (NOT is_cancelled AND ArrDel15 = 0)"
_FIVE = ["CarrierDelay", "WeatherDelay", "NASDelay", "SecurityDelay", "LateAircraftDelay"]
_FIVE_TOTAL = " + ".join(f"coalesce(sum({c}), 0)" for c in _FIVE)


def _kpi(measures: str) -> str:
    return _featured(f"SELECT {_CAUSE_GROUP}, {measures} FROM featured GROUP BY {_CAUSE_GROUP}")


_SUMMARY = f"""totals AS (
  SELECT {_PUNCTUAL} AS punctual, {_FLOWN} AS flown, {_CANCELLED} AS cancelled, count(*) AS n,
    avg(ArrDelay) FILTER (NOT is_cancelled) AS arrival, {", ".join(f"sum({c}) AS {c}" for c in _FIVE)}
  FROM featured),
shares AS (
  SELECT unnest(['Carrier', 'Weather', 'NAS', 'Security', 'Late Aircraft']) AS cause,
         unnest([{_cols(_FIVE)}]) AS minutes FROM totals),
best AS (
  SELECT airline_code AS label, {_PUNCTUAL} / nullif({_FLOWN}, 0) * 100 AS v
  FROM featured GROUP BY airline_code ORDER BY v DESC NULLS LAST, label LIMIT 1),
worst AS (
  SELECT origin_code AS label, avg(DepDelayMinutes) FILTER (NOT is_cancelled) AS v
  FROM featured GROUP BY origin_code ORDER BY v DESC NULLS LAST, label LIMIT 1),
top_cause AS (
  SELECT cause AS label, minutes / (SELECT sum(minutes) FROM shares) * 100 AS v
  FROM shares ORDER BY minutes DESC, cause LIMIT 1)"""
_SUMMARY_LINES = f"""
SELECT 'on_time_rate_pct' AS metric, cast(NULL AS varchar) AS label, {_pct('punctual', 'flown')} AS value FROM totals
UNION ALL SELECT 'avg_arrival_delay_minutes', NULL, {_r('arrival')} FROM totals
UNION ALL SELECT 'cancellation_rate_pct', NULL, {_pct('cancelled', 'n')} FROM totals
UNION ALL SELECT 'top_delay_cause_pct', label, {_r('v')} FROM top_cause
UNION ALL SELECT 'best_on_time_airline_pct', label, {_r('v')} FROM best
UNION ALL SELECT 'worst_departure_delay_airport', label, {_r('v')} FROM worst"""

_SCORECARD = f"""yearly AS (
  SELECT flight_year, airline_code, count(*) AS total_flights, {_ON_TIME} AS on_time,
    {_CANCELLED} AS cancelled, avg(ArrDelayMinutes) FILTER (NOT is_cancelled) AS delay
  FROM featured GROUP BY flight_year, airline_code)"""
_SEASON = """CASE WHEN flight_month IN (12, 1, 2) THEN 'Winter' WHEN flight_month IN (3, 4, 5) THEN 'Spring'
    WHEN flight_month IN (6, 7, 8) THEN 'Summer' ELSE 'Autumn' END"""

# --- data quality ---------------------------------------------------------------

_STATUS_TOTAL = " + ".join(_FLAGS[f] for f in STATUS_FLAGS)
_NULL_PROFILE = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS null_count, "
    f"count(*) FILTER ({c} IS NULL) / count(*) AS null_fraction, "
    f"{_pct(f'count(*) FILTER ({c} IS NULL)', 'count(*)', 4)} AS null_pct FROM flights"
    for c in NULL_PROFILE_COLUMNS
)
_DISTRIBUTION = " UNION ALL ".join(
    f"SELECT '{f}' AS flag, {f} AS value, count(*) AS count FROM bronze GROUP BY {f}"
    for f in ("departure_delay_range_flag", "same_origin_destination", "check_distance_range")
)
_RATES = " UNION ALL ".join(
    f"SELECT '{f}' AS flag, {_big(f'sum({f})')} AS flagged_rows, "
    f"{_pct(f'sum({f})', 'count(*)', 4)} AS flagged_pct, cast({limit} AS double) AS expected_below_pct, "
    f"sum({f}) / count(*) * 100 < {limit}e0 AS as_expected FROM bronze"
    for f, limit in EXPECTED_FLAG_PCT.items()
)

_MONTH = "cast(year(FlightDate) AS integer) AS year, cast(month(FlightDate) AS integer) AS month"
_BRONZE_COLUMNS = _PRINTED_FLIGHT + ", " + _cols(_FLAGS)

_COUNTS = ["total_number_of_flights", "delayed_flights", "total_flights_cancelled", "diverted_flights"]
_AIRLINE_NUMBERS = [
    *_COUNTS, "non_cancelled_flights", "avg_arrival_delay_minutes", "median_arrival_delay_minutes",
    "on_time_flights", "on_time_flight_percentage", "cancelled_flights", "cancelled_flight_percentage",
    "avg_carrier_delay", "avg_weather_delay", "avg_security_delay", "avg_late_aircraft_delay",
    "avg_distance_travelled", "total_distance_travelled", "monthly_rank",
]
_ROUTE_NUMBERS = [
    "number_of_flights", "avg_arrival_delay", "avg_distance_travelled", "total_delayed_flights",
    "total_on_time_flights", "number_of_airlines_on_route", "on_time_percentage_airline_percentage",
]
_DEPARTURE_NUMBERS = [
    "origin_lon", "origin_lat", "total_departure", "total_cancelled_departure",
    "avg_departure_delay_minutes", "avg_route_distance", "number_of_flights_operating",
    "avg_airtime", "departure_on_time_percentage",
]
_CAUSE_NUMBERS = [
    "total_minutes_delayed",
    *(f"total_{c}_delayed_minutes" for c in ("weather", "carrier", "security", "late_aircraft")),
    *(f"{c}_delay_percentage" for c in ("weather", "carrier", "security", "late_aircraft")),
]
# Gold tables as (name, key, numbers, query).
_GOLD = [
    ("gold_airline_kpi", _GROUP, _AIRLINE_NUMBERS, f"SELECT *, {_RANK} FROM ({_airline(_ALL_MEASURES)})"),
    ("gold_route_kpi", "flight_year, route, origin_code, destination_code", _ROUTE_NUMBERS, _ROUTE),
    (
        "gold_airport_departure_kpi",
        """flight_year, flight_month, origin_code, origin_airport_name, origin_airport_city,
        origin_airport_state""",
        _DEPARTURE_NUMBERS,
        _DEPARTURES,
    ),
    ("delay_cause_table", _CAUSE_GROUP, _CAUSE_NUMBERS, _CAUSE_TABLE),
]


def _unpivoted(name: str, keys: str, numbers: list[str], select: str) -> str:
    values = ", ".join(f"cast({n} AS double) AS {n}" for n in numbers)
    return f"""SELECT '{name}' AS table_name, row_key, measure, value
    FROM (SELECT concat_ws('|', {keys}) AS row_key, {values} FROM ({select})) wide
    UNPIVOT INCLUDE NULLS (value FOR measure IN ({_cols(numbers)}))"""


_ORACLES = {
    # sources and sinks
    "scan_csv_bronze": _flights(
        f"SELECT {_PRINTED_FLIGHT}, cast(NULL AS varchar) AS _corrupt_record FROM flights"
    ),
    "corrupt_records": _flights(
        f"""SELECT {_MONTH}, count(*) AS total_rows,
          count(*) FILTER (l_linenumber = 7) AS corrupt_rows,
          count(*) FILTER (l_linenumber = 7 OR DepDelay IS NULL) AS departure_delay_null_rows
        FROM flights GROUP BY ALL"""
    ),
    "scan_json_airports": f"WITH {_AIRPORTS} SELECT * FROM airports",
    "scan_json_airports_inferred": f"WITH {_AIRPORTS} SELECT * FROM airports",
    "sink_airports_roundtrip": f"WITH {_AIRPORTS} SELECT * FROM us",
    "airports_us": f"WITH {_AIRPORTS} SELECT * FROM us",
    "landing_layout_roundtrip": _flights(
        f"SELECT {_MONTH}, count(*) AS flights FROM flights GROUP BY ALL"
    ),
    "bronze_partitioned_roundtrip": _bronze(
        f"SELECT {_BRONZE_COLUMNS}, corrupt_record, {_LOADED}, year, month FROM bronze"
    ),
    "silver_month_pruning": _featured(
        """SELECT year, month, airline_code, count(*) AS flights, sum(Distance) AS distance
        FROM featured WHERE FlightDate >= DATE '1996-11-01' AND FlightDate < DATE '1997-02-01'
        GROUP BY ALL"""
    ),
    "silver_clustered_scan": _featured(
        """SELECT year, month, airline_code, origin_code, count(*) AS flights, sum(Distance) AS distance
        FROM featured WHERE airline_code = 'AL05' AND origin_code < 'N15' GROUP BY ALL"""
    ),
    "ingest_missing_months": """
        SELECT cast(year(m) AS integer) AS year, cast(month(m) AS integer) AS month
        FROM (SELECT unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '2002-12-01', INTERVAL 1 MONTH)) AS m)
        WHERE NOT EXISTS (SELECT 1 FROM lineitem
          WHERE year(l_shipdate) = year(m) AND month(l_shipdate) = month(m))""",
    "incremental_batch_rerun": _flights(
        f"SELECT {_MONTH}, count(*) AS flights, sum(DepDelay) AS departure_delay FROM flights GROUP BY ALL"
    ),
    "incremental_late_file": _flights(
        f"""SELECT {_MONTH}, count(*) AS flights, count(*) FILTER (l_orderkey % 50 = 0) AS bad_dates,
        count(*) FILTER (l_orderkey % 50 = 0) AS corrupt_rows FROM flights GROUP BY ALL"""
    ),
    "refiled_latest_wins": _flights(
        f"""SELECT {_MONTH}, count(*) AS flights, count(*) FILTER (again) AS refiled
        FROM (SELECT {_cols(FLIGHT_KEY)}, bool_or(l_linenumber = 1) AS again FROM flights
              GROUP BY {_cols(FLIGHT_KEY)})
        GROUP BY ALL"""
    ),
    "incremental_ledger_rerun": _flights(
        f"""SELECT {_MONTH}, count(*) AS flights, cast(1 AS bigint) AS loads,
        strftime(min(FlightDate), '%Y-%m-%d') AS first_day, strftime(max(FlightDate), '%Y-%m-%d') AS last_day
        FROM flights GROUP BY ALL"""
    ),
    "incremental_silver_merge": _merged(
        """SELECT year, month, count(*) AS flights, count(*) FILTER (again) AS refiled,
        count(name) AS with_origin FROM merged GROUP BY ALL"""
    ),
    "incremental_silver_months": _merged(
        """SELECT year, month, count(*) FILTER (again) AS refiled FROM merged
        GROUP BY ALL HAVING count(*) FILTER (again) > 0"""
    ),
    "csv_header_rejects": _flights(
        f"""SELECT {_MONTH},
        CASE WHEN year(FlightDate) = 1997 AND month(FlightDate) = 6 THEN cast(0 AS bigint) ELSE count(*) END AS flights,
        CASE WHEN year(FlightDate) = 1997 AND month(FlightDate) = 6
             THEN 'field 16 is OriginState, not OriginCityName' END AS reason
        FROM flights GROUP BY year(FlightDate), month(FlightDate)"""
    ),
    "bronze_schema_drift": _flights(
        f"""SELECT {_MONTH}, count(*) AS flights,
        sum(CASE WHEN l_linenumber <= 2 THEN Distance WHEN l_linenumber <= 4 THEN Distance + 0.5e0 END) AS miles,
        count(*) FILTER (l_linenumber IN (3, 4)) AS gates FROM flights GROUP BY ALL"""
    ),
    "gold_route_from_months": _featured(_ROUTE, _ROUTED),
    "route_airlines_from_bitmaps": _featured(
        """SELECT flight_year, route, origin_code, destination_code,
        count(DISTINCT airline_code) AS number_of_airlines_on_route FROM routed GROUP BY ALL""",
        _ROUTED,
    ),
    "kpi_p95_annual_from_counts": _featured(
        """SELECT flight_year, airline_code, count(ArrDelay) AS arrivals,
        quantile_disc(ArrDelay, 0.95) AS arrival_delay FROM featured WHERE ArrDelay IS NOT NULL GROUP BY ALL"""
    ),
    "kpi_p95_from_sketches": _featured(
        """SELECT flight_year, airline_code, count(ArrDelay) AS arrivals, true AS within_bound
        FROM featured WHERE ArrDelay IS NOT NULL GROUP BY ALL"""
    ),
    "silver_interleaved_scan": _featured(
        """SELECT year, month, airline_code, origin_code, count(*) AS flights, sum(Distance) AS distance
        FROM featured WHERE origin_code >= 'N20' GROUP BY ALL"""
    ),
    "export_query_readback": _featured(
        f"SELECT * FROM ({_CAUSE_TABLE}) WHERE flight_year >= 1996 AND airline_code >= 'AL05'", _CAUSE
    ),
    "gold_published_together": _silver(
        " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({select})" for name, _, _, select in _GOLD
        ),
        _ROUTED,
        _CAUSE,
    ),
    "gold_saved_tables": _silver(
        " UNION ALL ".join(
            _unpivoted(name, keys, measures, select) for name, keys, measures, select in _GOLD
        ),
        _ROUTED,
        _CAUSE,
    ),
    "gold_parquet_roundtrip": _featured(_CAUSE_TABLE, _CAUSE),
    "export_readback_diff": _featured(
        """SELECT 'delay_cause_table' AS table_name, count(*) AS source_rows, count(*) AS copy_rows,
        cast(0 AS bigint) AS only_in_source, cast(0 AS bigint) AS only_in_copy FROM causes""",
        _CAUSE,
    ),
    "catalog_external_table": _numbered(
        "SELECT year, count(*) AS row_count, sum(Distance) AS distance FROM kept GROUP BY year"
    ),
    "sql_row_count": _numbered("SELECT count(*) AS row_count FROM kept"),
    # Bronze and data quality
    "bronze_projection": _flights(f"SELECT {_PRINTED_FLIGHT} FROM flights"),
    "bronze_flights": _bronze(
        f"SELECT {_BRONZE_COLUMNS}, corrupt_record, {_LOADED}, year, month FROM bronze"
    ),
    "bronze_short": _bronze(
        f"""SELECT {_DAY}, Reporting_Airline, Origin, Dest, DepDelay, Distance, corrupt_record,
        {_cols(_FLAGS)} FROM bronze"""
    ),
    "dq_null_flags": _bronze(f"SELECT {_KEYS}, {_cols(NULL_FLAGS)} FROM bronze"),
    "dq_row_status": _flights(
        f"""SELECT {_KEYS}, {_STATUS_TOTAL} AS total_null_flag_count,
        CASE WHEN {_STATUS_TOTAL} = 0 THEN 'clean' ELSE 'bad' END AS status FROM flights"""
    ),
    "dq_clean_count": _flights(
        f"SELECT count(*) AS clean_rows FROM flights WHERE {_STATUS_TOTAL} = 0"
    ),
    "dq_delay_range": _bronze(f"SELECT {_KEYS}, DepDelay, departure_delay_range_flag FROM bronze"),
    "dq_same_origin_dest": _bronze(
        f"SELECT {_KEYS}, Origin, Dest, same_origin_destination FROM bronze"
    ),
    "dq_distance_range": _bronze(f"SELECT {_KEYS}, Distance, check_distance_range FROM bronze"),
    "dq_flag_distribution": _bronze(_DISTRIBUTION),
    "dq_validation_summary": _bronze(
        f"""SELECT {_big('sum(departure_delay_range_flag)')} AS invalid_dep_delay_count,
        {_big('sum(same_origin_destination)')} AS same_origin_dest_count,
        {_big('sum(check_distance_range)')} AS invalid_distance_count FROM bronze"""
    ),
    "dq_expected_rates": _bronze(_RATES),
    "dq_null_profile": _flights(_NULL_PROFILE),
    # features
    "feat_hhmm": _feature(
        "CRSDepTime, CRSArrTime",
        {c: _FEATURES[c] for c in ("crs_dep_time_std", "crs_arr_time_std")},
    ),
    "feat_hhmm_v1": _feature(
        "CRSDepTime, CRSArrTime",
        {
            "crs_dep_time_std": _label("CRSDepTime", False),
            "crs_arr_time_std": _label("CRSArrTime", False),
        },
    ),
    "feat_minutes": _feature(
        "CRSDepTime, CRSArrTime",
        {f"{c}_safe": _FEATURES[c] for c in ("crs_dep_minutes", "crs_arr_minutes")},
    ),
    "feat_minutes_v1": _feature(
        "CRSDepTime, CRSArrTime",
        {c: _FEATURES[c] for c in ("crs_dep_minutes", "crs_arr_minutes")},
    ),
    "feat_status_flags": _feature(
        "Cancelled, Diverted, DepDel15, ArrivalDelayGroups", _FLAG_COLUMNS
    ),
    "feat_delay_category": _feature(
        "Cancelled, ArrDelayMinutes", {"arrival_delay_category": _CATEGORY}
    ),
    "feat_cancellation_reason": _feature("CancellationCode", {"cancellation_reason": _REASON}),
    "feat_date_parts": _feature(_DAY, _DATES),
    "feat_codes": _feature("IATA_CODE_Reporting_Airline, Origin, Dest", _CODES),
    "feat_route": _flights(
        f"""SELECT {_KEYS}, {_as(_CODES)},
        concat_ws('-', upper(Origin), upper(Dest)) AS route FROM flights"""
    ),
    "feat_on_time": _flights(
        f"""SELECT {_KEYS}, CASE WHEN coalesce(Cancelled, 0) <> 1 AND coalesce(ArrivalDelayGroups, 0) <= 0
        THEN 1 ELSE 0 END AS on_time_flight FROM flights"""
    ),
    "feat_departure_on_time": _flights(
        f"""SELECT {_KEYS}, CASE WHEN coalesce(Cancelled, 0) <> 1 AND coalesce(DepDel15, 0) <> 1
        THEN 1 ELSE 0 END AS departure_on_time_flight FROM flights"""
    ),
    "feat_load_timestamp": _flights(
        """SELECT count(*) AS total_rows, cast(0 AS bigint) AS without_load_time,
        cast(1 AS bigint) AS load_times FROM flights"""
    ),
    **{
        name: _feature("Flight_Number_Reporting_Airline", {"flight_num_extract": _EXTRACT})
        for name in (
            "feat_flight_num_extract",
            "udf_flight_num_extract",
            "sql_flight_num_extract",
        )
    },
    # deduplication
    "dedup_unique": _numbered(
        f"""SELECT {_PRINTED_FLIGHT}, {_LOADED}, filing_id FROM kept"""
    ),
    "dedup_first_version": _numbered(
        f"SELECT {_PRINTED_FLIGHT}, {_LOADED}, filing_id, {_cols(NULL_FLAGS)} FROM kept"
    ),
    "dedup_duplicates": _numbered(
        f"SELECT {_PRINTED_FLIGHT}, {_LOADED}, filing_id, row_num FROM numbered WHERE row_num > 1"
    ),
    "dedup_report": _numbered(
        """SELECT count(*) AS total_rows, count(*) FILTER (row_num > 1) AS duplicate_rows,
        count(*) FILTER (row_num = 1) AS unique_rows FROM numbered"""
    ),
    "step_row_counts": _silver(
        """SELECT 'bronze' AS step, count(*) AS row_count FROM bronze
        UNION ALL SELECT 'deduplicated', count(*) FROM kept
        UNION ALL SELECT 'joined_to_airports', count(*) FROM silver
        UNION ALL SELECT 'origin_matched', count(*) FROM silver WHERE origin_airport_name IS NOT NULL"""
    ),
    # airports
    "join_origin_airport": _placed(
        f"""SELECT {_KEYS}, {_cols(_CODES)}, origin_airport_name, origin_airport_city,
        origin_airport_state, origin_lat, origin_lon, origin_timezone FROM placed"""
    ),
    "join_both_airports": _placed(
        f"""SELECT {_KEYS}, {_cols(_CODES)}, origin_airport_name, origin_airport_city,
        origin_airport_state, origin_lat, origin_lon, origin_timezone, dest_airport_name,
        dest_airport_city, dest_airport_state, dest_lat, dest_lon, dest_timezone FROM placed"""
    ),
    "join_inner_origin_airport": _placed(
        f"SELECT {_KEYS}, {_cols(_CODES)}, us.* FROM coded JOIN us ON origin_code = iata"
    ),
    "unmatched_airports": _placed(
        """SELECT airport_code, role, count(*) AS flights FROM (
          SELECT origin_code AS airport_code, 'origin' AS role FROM coded
          UNION ALL SELECT destination_code, 'dest' FROM coded)
        WHERE airport_code NOT IN (SELECT iata FROM us) GROUP BY ALL"""
    ),
    "feat_haversine": _placed(
        f"""SELECT {_KEYS}, origin_code, destination_code,
        {_r('haversine_distance_km', 3)} AS haversine_distance_km FROM placed"""
    ),
    "haversine_vs_reported": _placed(
        f"""SELECT origin_code, destination_code, Distance,
        {_r('haversine_distance_km')} AS haversine_km FROM placed
        WHERE haversine_distance_km IS NOT NULL"""
    ),
    # Silver
    "silver_flights": _silver(
        f"""SELECT * EXCLUDE (filing_id) REPLACE ({_DAY}, {_LOADED},
        {_r('haversine_distance_km', 3)} AS haversine_distance_km),
        {_EXTRACT} AS flight_num_extract FROM silver"""
    ),
    # aggregates
    "flights_by_year": _featured(
        "SELECT flight_year, count(*) AS total_flights FROM featured GROUP BY flight_year ORDER BY flight_year"
    ),
    "flights_by_year_month": _featured(
        """SELECT flight_year, flight_month, count(*) AS total_flights FROM featured
        GROUP BY flight_year, flight_month ORDER BY flight_year, flight_month"""
    ),
    "cancelled_by_year_month": _featured(
        f"""SELECT flight_year, flight_month, count(*) AS total_flights,
        {_CANCELLED} AS cancelled_flights FROM featured
        GROUP BY flight_year, flight_month ORDER BY flight_year, flight_month"""
    ),
    "airline_base": _featured(_airline(_BASE_COUNTS)),
    "airline_delay_stats": _featured(
        _airline(_DELAY_STATS, "(SELECT * FROM featured WHERE NOT is_cancelled)")
    ),
    "airline_on_time": _featured(_airline(f"{_TOTAL}, {_ON_TIME_COUNTS}")),
    "airline_cancelled_pct": _featured(_airline(f"{_TOTAL}, {_CANCELLED_COUNTS}")),
    "airline_delay_types": _featured(_airline(_CAUSE_MEANS)),
    "airline_distance": _featured(_airline(_DISTANCES)),
    "airline_monthly_rank": _featured(f"SELECT *, {_RANK} FROM ({_airline(_TOTAL)})"),
    # Gold
    "gold_airline_kpi": _AIRLINE_KPI,
    "gold_airline_kpi_joined": _AIRLINE_KPI,
    "gold_route_kpi": _featured(_ROUTE, _ROUTED),
    "gold_airport_departure_kpi": _silver(_DEPARTURES),
    "gold_delay_cause": _featured(_CAUSE_TABLE, _CAUSE),
    "route_preview_top": _featured(
        f"{_ROUTE} ORDER BY number_of_flights DESC, flight_year, route LIMIT 15", _ROUTED
    ),
    # KPIs and views
    "kpi_on_time_rate": _kpi(
        f"""{_FLOWN} AS completed_flights, {_PUNCTUAL} AS on_time_arrivals,
        {_pct(_PUNCTUAL, _FLOWN)} AS on_time_rate_pct"""
    ),
    "kpi_avg_arrival_delay": _kpi(
        f"{_r('avg(ArrDelay) FILTER (NOT is_cancelled)')} AS avg_arrival_delay"
    ),
    "kpi_cancellation_rate": _kpi(
        f"""count(*) AS total_flights, {_CANCELLED} AS cancelled_flights,
        {_pct(_CANCELLED, 'count(*)')} AS cancellation_rate_pct"""
    ),
    "kpi_delay_cause_mix": _kpi(
        f"{_FIVE_TOTAL} AS caused_delay_minutes, "
        + ", ".join(
            f"{_pct(f'coalesce(sum({c}), 0)', _FIVE_TOTAL)} AS {name}_pct"
            for c, name in zip(_FIVE, ("carrier", "weather", "nas", "security", "late_aircraft"))
        )
    ),
    "kpi_p95_arrival_delay": _kpi("quantile_disc(ArrDelay, 0.95) AS p95_arrival_delay"),
    "network_summary": _featured(_SUMMARY_LINES, _SUMMARY),
    "vw_airline_scorecard": _featured(
        f"""SELECT flight_year, airline_code, total_flights,
        {_pct('on_time', 'total_flights')} AS on_time_percentage,
        {_pct('cancelled', 'total_flights')} AS cancelled_percentage,
        {_r('delay')} AS avg_arrival_delay,
        cast(dense_rank() OVER (PARTITION BY flight_year ORDER BY on_time / total_flights DESC) AS integer)
          AS annual_rank FROM yearly""",
        _SCORECARD,
    ),
    "vw_delay_trend_monthly": _featured(
        f"""SELECT flight_year, flight_month, flight_quarter, {_SEASON} AS season,
        count(*) AS total_flights,
        {_r('avg(ArrDelayMinutes) FILTER (NOT is_cancelled)')} AS avg_arrival_delay,
        {_pct(_ON_TIME, 'count(*)')} AS on_time_percentage
        FROM featured GROUP BY flight_year, flight_month, flight_quarter"""
    ),
    "vw_airport_performance_map": _silver(
        f"""SELECT flight_year, flight_month, origin_code, origin_airport_name, origin_airport_city,
        origin_airport_state, origin_lat, origin_lon, total_departure, total_cancelled_departure,
        avg_departure_delay_minutes, departure_on_time_percentage FROM ({_DEPARTURES})"""
    ),
}
_ORACLES["silver_cached_multi_gold"] = _ORACLES["gold_saved_tables"]
_ORACLES["silver_partitioned_roundtrip"] = _ORACLES["silver_flights"]
_ORACLES["step_counts_observed"] = _ORACLES["step_row_counts"]
_ORACLES["vw_airline_scorecard_from_months"] = _ORACLES["vw_airline_scorecard"]


def oracle_sql() -> dict[str, str]:
    return dict(_ORACLES)
