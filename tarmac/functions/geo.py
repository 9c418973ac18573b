"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.model import EARTH_RADIUS_KM


def _half_chord(angle: Column) -> Column:
    """sin² of half an angle given in degrees."""
    s = F.sin(F.radians(angle) / 2)
    return s * s


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Kilometres between two points given in degrees; NULL if any coordinate is.

    Rounding can lift the haversine of antipodal points above 1, where the arc
    sine has no value, so it is held at 1. (``least`` would turn NULL into 1.)
    """
    h = _half_chord(lat2 - lat1) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * _half_chord(lon2 - lon1)
    )
    h = F.when(h > 1.0, 1.0).otherwise(h)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(h))


# The name of this helper, of its parameters and of its result.
def add_haversine_distance(
    df: DataFrame,
    lat1_col: str = "origin_lat",
    lon1_col: str = "origin_lon",
    lat2_col: str = "dest_lat",
    lon2_col: str = "dest_lon",
    result_col: str = "haversine_distance_km",
) -> DataFrame:
    """``df`` with the distance between two coordinate pairs as ``result_col``."""
    points = [F.col(c) for c in (lat1_col, lon1_col, lat2_col, lon2_col)]
    return df.withColumn(result_col, haversine_km(*points))
