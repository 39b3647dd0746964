"""Windows over keys with few rows, or over results that are already grouped."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, Window
from pyspark.sql import functions as F


def previous(value: str, key: str) -> Column:
    """The next lower value of the same key. Distinct rows go in, so that the rows per key are
    bounded by the distinct values."""
    return F.lag(value).over(Window.partitionBy(key).orderBy(value))


def any_in_key(flag: str, key: str) -> Column:
    """Whether some row of the same key has the flag set."""
    return F.max(flag).over(Window.partitionBy(key))


def running_total(order: Sequence[str], value: str) -> Column:
    """Sum up to and including the current row. Runs in one task: use it on a row per
    period, never on detail rows."""
    upto = Window.orderBy(*order).rangeBetween(Window.unboundedPreceding, Window.currentRow)
    return F.sum(value).over(upto)


def grand_total(value: str) -> Column:
    """Sum over all rows. Runs in one task, over a result of a row per group."""
    return F.sum(value).over(Window.partitionBy())
