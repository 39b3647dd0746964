"""Rows that break rules, merged snapshots and category dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def quality_report(rows: DataFrame, rules: dict[str, Column], key: list[Column]) -> DataFrame:
    """(rule, n_bad, n_rows): for each rule the rows for which it is true, counted in one pass, and
    under ``duplicate_key`` the rows beyond the first of their key, by a grouped count."""
    counts = rows.agg(
        F.count("*").alias("n_rows"),
        *(F.count_if(bad).alias(f"bad_{i}") for i, bad in enumerate(rules.values())),
    )
    named = [
        F.struct(F.lit(name).alias("rule"), F.col(f"bad_{i}").alias("n_bad"))
        for i, name in enumerate(rules)
    ]
    broken = counts.select(F.explode(F.array(*named)).alias("r"), "n_rows")
    held = rows.groupBy(*(k.alias(f"key_{i}") for i, k in enumerate(key))).count()
    n_rows = F.coalesce(F.sum("count"), F.lit(0))
    repeated = held.agg((n_rows - F.count("*")).alias("n_bad"), n_rows.alias("n_rows"))
    return broken.select("r.rule", "r.n_bad", "n_rows").union(
        repeated.select(F.lit("duplicate_key"), "n_bad", "n_rows")
    )


def upsert(
    current: DataFrame, changes: DataFrame, key: list[str], ignore: Sequence[str] = ()
) -> DataFrame:
    """``current`` with the rows of ``changes`` (same columns, unique keys on each side) merged in
    by ``key``, and columns ``change``: ``inserted``, ``updated`` or ``kept``, and ``changed``: whether
    the key occurs among the changes.

    A changed row equal to the current one, but for columns to ``ignore``, is kept as it is. A null
    key matches nothing, so such rows stay on both sides.
    """
    rest = [c for c in current.columns if c not in key]
    compared = [c for c in rest if c not in ignore]
    old = current.select(*key, F.struct(*rest).alias("old"))
    new = changes.select(*key, F.struct(*rest).alias("new"))
    same = F.lit(True)
    for c in compared:
        same = same & F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    change = (
        F.when(F.col("old").isNull(), "inserted")
        .when(F.col("new").isNull() | same, "kept")
        .otherwise("updated")
    )
    merged = old.join(new, key, "full").withColumn("change", change)
    row = F.when(F.col("change") == "kept", F.col("old")).otherwise(F.col("new"))
    return merged.select(
        *key, row.alias("row"), "change", F.col("new").isNotNull().alias("changed")
    ).select(*key, "row.*", "change", "changed")


def category_dimension(rows: DataFrame, column: str, key: str) -> DataFrame:
    """The distinct values of ``column`` with a ``key`` that stays the same from run to run: half of
    the value's SHA-256. Null is no category."""
    values = rows.select(column).filter(F.col(column).isNotNull()).distinct()
    return values.select(F.substring(F.sha2(column, 256), 1, 32).alias(key), column)
