"""Conditional aggregates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rows_counted() -> Column:
    return F.count(F.lit(1))


def count_where(condition: Column) -> Column:
    return F.count_if(condition)


def any_where(condition: Column) -> Column:
    """Whether the condition holds for some row; false, not NULL, where it is NULL throughout."""
    return F.count_if(condition) > 0


def sum_where(condition: Column, value: Column) -> Column:
    return F.sum(F.when(condition, value).otherwise(F.lit(0)))


def pivot_sums(
    rows: DataFrame, keys: Sequence[str], pivot: str, value: str, columns: Mapping[object, str]
) -> DataFrame:
    """One column per listed pivot value, holding its sum, or 0 where the value does not occur."""
    sums = [sum_where(F.col(pivot) == v, F.col(value)).alias(c) for v, c in columns.items()]
    return rows.groupBy(*keys).agg(*sums)
