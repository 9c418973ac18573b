"""Flight status: flags, delay category, cancellation reason."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tarmac.model import CANCELLATION_REASONS, DELAY_BANDS


def is_one(indicator: Column) -> Column:
    """A 0/1 indicator as a boolean that is never NULL."""
    return F.coalesce(indicator == 1, F.lit(False))


def delay_category(cancelled: Column, minutes: Column) -> Column:
    """Category of an arrival delay.

    Bands are closed intervals of whole minutes, so a value between two bands
    (14.5) has no category; nor has a missing delay of a flight that flew.
    """
    label = F.when(cancelled == 1, "Cancelled").when(minutes < 0, "Early")
    for name, low, high in DELAY_BANDS:
        label = label.when(minutes.between(low, high), name)
    return label.when(minutes > DELAY_BANDS[-1][2], "Severe Delay")


def cancellation_reason(
    code: Column, reasons: Mapping[str, str] = CANCELLATION_REASONS
) -> Column:
    """Label of a cancellation code; NULL for an unknown one."""
    pairs = [F.lit(text) for pair in reasons.items() for text in pair]
    return F.try_element_at(F.create_map(*pairs), code)
