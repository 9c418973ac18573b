"""Data-quality flags and reports. Rows are flagged, never removed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tarmac.functions.rates import percent_of
from tarmac.model import (
    DEPARTURE_DELAY_MINUTES,
    DISTANCE_MILES,
    EXPECTED_FLAG_PCT,
    NULL_FLAGS,
    NULL_PROFILE_COLUMNS,
    RANGE_FLAGS,
    STATUS_FLAGS,
)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, 1).otherwise(0)


def outside(value: Column, bounds: tuple[float, float], null_is_valid: bool = False) -> Column:
    """1 unless the value lies in the closed interval.

    A missing value counts as outside unless ``null_is_valid``.
    """
    valid = F.coalesce(value.between(*bounds), F.lit(null_is_valid))
    return flag(~valid)


def with_null_flags(df: DataFrame, flags: Mapping[str, str] = NULL_FLAGS) -> DataFrame:
    """One 0/1 column per entry ``flag name -> column``."""
    return df.withColumns({name: flag(F.col(c).isNull()) for name, c in flags.items()})


def range_flag_columns(null_is_valid: bool = False) -> dict[str, Column]:
    departure, same_place, distance = RANGE_FLAGS
    return {
        departure: outside(F.col("DepDelay"), DEPARTURE_DELAY_MINUTES, null_is_valid),
        same_place: flag(F.col("Origin") == F.col("Dest")),
        distance: outside(F.col("Distance"), DISTANCE_MILES, null_is_valid),
    }


def with_range_flags(df: DataFrame, null_is_valid: bool = False) -> DataFrame:
    return df.withColumns(range_flag_columns(null_is_valid))


def with_row_status(df: DataFrame, flags: Iterable[str] = STATUS_FLAGS) -> DataFrame:
    """``total_null_flag_count`` over the flags, and ``status``: clean or bad."""
    total = reduce(add, (F.col(name) for name in flags))
    return df.withColumns({"total_null_flag_count": total, "status": _status(total)})


def _status(total: Column) -> Column:
    return F.when(total == 0, "clean").otherwise("bad")


def clean_count(df: DataFrame) -> DataFrame:
    """One row: how many rows have status clean."""
    return df.filter(F.col("status") == "clean").agg(F.count("*").alias("clean_rows"))


def _unpivot(totals: DataFrame, rows: Iterable[Iterable[Column]], names: list[str]) -> DataFrame:
    """Turn one row of totals into several, after aggregation so that it costs nothing."""
    structs = [F.struct(*(c.alias(n) for c, n in zip(row, names))) for row in rows]
    return totals.select(F.inline(F.array(*structs)))


def null_profile(df: DataFrame, columns: Iterable[str] = NULL_PROFILE_COLUMNS) -> DataFrame:
    """Null count and share per column, from one pass over the rows."""
    columns = list(columns)
    totals = df.agg(
        F.count("*").alias("n"), *(F.count_if(F.col(c).isNull()).alias(c) for c in columns)
    )
    rows = (
        (
            F.lit(c),
            F.col(c),
            F.try_divide(F.col(c), F.col("n")),
            F.round(percent_of(F.col(c), F.col("n")), 4),
        )
        for c in columns
    )
    return _unpivot(totals, rows, ["column_name", "null_count", "null_fraction", "null_pct"])


def _flag_totals(df: DataFrame, flags: Iterable[str]) -> DataFrame:
    return df.agg(
        F.count("*").alias("n"),
        *(F.coalesce(F.sum(name), F.lit(0)).cast("bigint").alias(name) for name in flags),
    )


def flag_distribution(df: DataFrame, flags: Iterable[str] = RANGE_FLAGS) -> DataFrame:
    """Rows per flag and value that occurs, from one pass over the rows."""
    flags = list(flags)
    rows = []
    for name in flags:
        rows.append((F.lit(name), F.lit(0), F.col("n") - F.col(name)))
        rows.append((F.lit(name), F.lit(1), F.col(name)))
    counts = _unpivot(_flag_totals(df, flags), rows, ["flag", "value", "count"])
    return counts.filter(F.col("count") > 0)


def validation_summary(df: DataFrame) -> DataFrame:
    """One row: flagged rows per range flag."""
    departure, same_place, distance = RANGE_FLAGS
    return df.agg(
        F.sum(departure).alias("invalid_dep_delay_count"),
        F.sum(same_place).alias("same_origin_dest_count"),
        F.sum(distance).alias("invalid_distance_count"),
    )


def expected_rates(
    df: DataFrame, limits: Mapping[str, float] = EXPECTED_FLAG_PCT
) -> DataFrame:
    """Flagged share per flag beside the share below which a load is as expected."""
    rows = []
    for name, limit in limits.items():
        rate = percent_of(F.col(name), F.col("n"))
        rows.append(
            (
                F.lit(name),
                F.col(name),
                F.round(rate, 4),
                F.lit(float(limit)),
                F.coalesce(rate < limit, F.lit(True)),
            )
        )
    names = ["flag", "flagged_rows", "flagged_pct", "expected_below_pct", "as_expected"]
    return _unpivot(_flag_totals(df, limits), rows, names)
