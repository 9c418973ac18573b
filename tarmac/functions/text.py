"""Character extract of a flight number: its 1st, 4th and 7th characters."""

from __future__ import annotations

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

_POSITIONS = (1, 4, 7)  # fixed values, counted from 1
SQL_NAME = "extract_flight_chars"  # fixed value: name users call in SQL


def flight_number_extract(number: Column) -> Column:
    """Characters at the fixed positions, joined; positions past the end are skipped.

    NULL for NULL and for an empty string. ``'1234567'`` gives ``'147'`` and
    ``'AA123'`` gives ``'A2'``.
    """
    text = number.cast("string")
    picked = F.concat(*(F.substring(text, position, 1) for position in _POSITIONS))
    return F.nullif(picked, F.lit(""))


def _extract(value):
    if value is None:
        return None
    return str(value)[:7:3] or None


def flight_number_extract_udf(number: Column) -> Column:
    """The same extract through Python, in Arrow batches; for parity checks."""
    return F.udf(_extract, StringType(), useArrow=True)(number)


def register_sql_functions(spark: SparkSession, python: bool = False) -> None:
    """Make the extract callable in SQL as ``extract_flight_chars(number)``.

    By default this is a SQL function that Catalyst inlines. ``python=True``
    registers the Python function under the same name instead.
    """
    # A SQL function cannot replace a Python one, nor the other way round.
    spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {SQL_NAME}")
    if python:
        spark.udf.register(SQL_NAME, F.udf(_extract, StringType(), useArrow=True))
        return
    picked = ", ".join(f"substring(number, {position}, 1)" for position in _POSITIONS)
    spark.sql(
        f"CREATE TEMPORARY FUNCTION {SQL_NAME}(number STRING) RETURNS STRING "
        f"RETURN nullif(concat({picked}), '')"
    )
