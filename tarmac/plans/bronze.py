"""Bronze: every raw row, with quality flags beside it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarmac.model import CORRUPT_FIELD, FLIGHT_COLUMNS, NULL_FLAGS, RANGE_FLAGS
from tarmac.operators.dedup import LOAD_TIME
from tarmac.operators.quality import flag, range_flag_columns, with_null_flags
from tarmac.sources.raw import FOLDER, SOURCE_FILE

CORRUPT = "corrupt_record"

# The short form: identity, null flags, the corrupt line, and what the range flags read.
SHORT_COLUMNS = ["FlightDate", "Reporting_Airline", "Origin", "Dest"]
SHORT_EXTRA = ["DepDelay", "Distance"]


def _corrupt(raw: DataFrame):
    if CORRUPT_FIELD in raw.columns:
        return F.col(CORRUPT_FIELD).alias(CORRUPT)
    return F.lit(None).cast("string").alias(CORRUPT)


def bronze_flights(
    raw: DataFrame, null_is_valid: bool = False, carry: Sequence[str] = (LOAD_TIME, SOURCE_FILE)
) -> DataFrame:
    """The Bronze table: flight columns, null flags, range flags, the corrupt line,
    and ``year`` and ``month`` to partition by. One projection over the scan.

    ``carry`` names columns that ingest added; those present are kept. Rows that
    know their landing folder are partitioned by it, so that a line whose date
    does not parse lies with the others of its month; the rest go by their date.
    """
    year, month = F.year("FlightDate"), F.month("FlightDate")
    if set(FOLDER) <= set(raw.columns):
        year, month = F.coalesce(FOLDER[0], year), F.coalesce(FOLDER[1], month)
    ranges = range_flag_columns(null_is_valid)
    return raw.select(
        *FLIGHT_COLUMNS,
        *(flag(F.col(c).isNull()).alias(name) for name, c in NULL_FLAGS.items()),
        *(ranges[name].alias(name) for name in RANGE_FLAGS),
        _corrupt(raw),
        *(c for c in carry if c in raw.columns),
        year.alias("year"),
        month.alias("month"),
    )


def bronze_short(raw: DataFrame, null_is_valid: bool = False) -> DataFrame:
    """The short Bronze form: 15 columns and the three range flags."""
    flagged = with_null_flags(raw).select(
        *SHORT_COLUMNS, *NULL_FLAGS, _corrupt(raw), *SHORT_EXTRA
    )
    return flagged.withColumns(range_flag_columns(null_is_valid))
