"""Joins to dimensions, key lists and literal lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def literal_relation(spark: SparkSession, values: Sequence, name: str) -> DataFrame:
    """A list of constants as a one-column relation."""
    array = F.array(*[F.lit(v) for v in values])
    return spark.range(1).select(F.explode(array).alias(name))


def keep_listed(value: Column, listed: Sequence) -> Column:
    """The value where the list holds it, else NULL: a set test, no join."""
    return F.when(value.isin(*listed), value)


def members_only(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """Rows whose key occurs among ``keys``.

    Both sides meet in plain shuffles, so that adaptive execution can split a frequent key; a
    distinct between shuffle and join would prevent it. Give keys that are distinct already where
    they are many.
    """
    return rows.join(keys.select(on), on, "left_semi")


def with_dimension(
    totals: DataFrame,
    dimension: DataFrame,
    on: str,
    attributes: Sequence[str],
    additive: Sequence[str] = (),
    how: str = "left",
) -> DataFrame:
    """Join grouped rows to dimension attributes that are themselves grouping keys.

    Grouping after a join of the detail rows gives the same result as grouping them first and
    joining the much smaller totals, except that a dimension row held n times counts n times in
    every sum. The copies are therefore counted, and the ``additive`` columns multiplied by them.
    Equal dimension rows are merged before the shuffle of the join.
    """
    copies = "__copies"
    merged = dimension.groupBy(on, *attributes).agg(F.count(F.lit(1)).alias(copies))
    factor = F.coalesce(F.col(copies), F.lit(1).cast("bigint"))
    joined = totals.join(merged, on, how)

    def multiplied(name: str) -> Column:
        if not isinstance(totals.schema[name].dataType, T.DecimalType):
            return F.col(name) * factor
        # Types whose product keeps all nine decimals; a sum beyond them fails.
        return F.col(name).cast("decimal(28,9)") * factor.cast("decimal(9,0)")

    return joined.withColumns({c: multiplied(c) for c in additive}).drop(copies)
