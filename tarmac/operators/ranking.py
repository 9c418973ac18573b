"""Ranks over aggregated tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_dense_rank(
    df: DataFrame, within: Sequence[str], by: str, name: str
) -> DataFrame:
    """Rank by a measure, highest first, ties sharing a rank without gaps."""
    window = Window.partitionBy(*within).orderBy(F.col(by).desc())
    return df.withColumn(name, F.dense_rank().over(window))
