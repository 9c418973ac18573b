"""Joins against a lookup table whose size is checked before it is broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def fits_broadcast(
    lookup: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Whether the lookup is small enough to copy to every executor.

    Counts rows and the bytes of their text form in one distributed aggregate;
    one row of two numbers reaches the driver.
    """
    text = F.concat_ws("", *(F.col(f"`{c}`").cast("string") for c in lookup.columns))
    rows, size = lookup.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    return rows <= max_rows and (size or 0) <= max_bytes


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    on: dict[str, str],
    how: str = "left",
    broadcast: bool | None = None,
) -> DataFrame:
    """Join ``rows`` to ``lookup`` on pairs ``column of rows -> column of lookup``.

    ``how`` is left, inner, left_semi or left_anti. A lookup of checked size is
    broadcast: the rows are not shuffled at all. A larger one is joined by a
    shuffle, in which Spark splits the tasks of a key that has a large share of the
    rows (adaptive skew join). Both forms give the same rows. ``broadcast`` skips
    the check when the caller has made it.
    """
    if broadcast is None:
        broadcast = fits_broadcast(lookup)
    pairs = [rows[left] == lookup[right] for left, right in on.items()]
    if broadcast:
        return rows.join(F.broadcast(lookup), pairs, how)
    return rows.join(lookup, pairs, how)
