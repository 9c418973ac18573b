"""Shares expressed in percent."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def percent_of(part: Column, whole: Column) -> Column:
    """``part / whole`` in percent, unrounded; NULL where ``whole`` is 0."""
    return F.try_divide(part, whole) * 100


def percent(part: Column, whole: Column, places: int = 2) -> Column:
    return F.round(percent_of(part, whole), places)
