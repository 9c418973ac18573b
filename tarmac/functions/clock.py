"""Clock times stored as HHMM integers, e.g. 1430 for half past two."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MIDNIGHT = 2400  # fixed value: end-of-day spelling of 00:00


def _hours(hhmm: Column) -> Column:
    return F.floor(hhmm / 100)


def _two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")


def hhmm_label_strict(hhmm: Column) -> Column:
    """``HH:MM`` digit by digit, so 2400 stays ``24:00``; NULL in, NULL out."""
    return F.concat(_two_digits(_hours(hhmm)), F.lit(":"), _two_digits(hhmm % 100))


def hhmm_label(hhmm: Column) -> Column:
    """``HH:MM`` on a 24-hour clock: 2400 becomes ``00:00``; NULL in, NULL out."""
    return F.when(hhmm == _MIDNIGHT, "00:00").otherwise(hhmm_label_strict(hhmm))


def hhmm_minutes(hhmm: Column) -> Column:
    """Minutes since midnight (bigint): 2400 becomes 0; NULL in, NULL out."""
    minutes = _hours(hhmm) * 60 + hhmm % 100
    return F.when(hhmm == _MIDNIGHT, F.lit(0).cast("bigint")).otherwise(minutes)
