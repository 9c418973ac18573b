"""Column expressions: every helper takes columns and returns a column."""

from tarmac.functions.clock import hhmm_label, hhmm_label_strict, hhmm_minutes
from tarmac.functions.geo import add_haversine_distance, haversine_km
from tarmac.functions.rates import percent, percent_of
from tarmac.functions.status import cancellation_reason, delay_category, is_one
from tarmac.functions.text import (
    flight_number_extract,
    flight_number_extract_udf,
    register_sql_functions,
)

__all__ = [
    "add_haversine_distance",
    "cancellation_reason",
    "delay_category",
    "flight_number_extract",
    "flight_number_extract_udf",
    "haversine_km",
    "hhmm_label",
    "hhmm_label_strict",
    "hhmm_minutes",
    "is_one",
    "percent",
    "percent_of",
    "register_sql_functions",
]
