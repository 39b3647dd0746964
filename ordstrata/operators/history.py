"""Append-only history tables: rows with a key, provenance columns, newest load."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordstrata.functions.text import trim_ws


def keyed_rows(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose key is neither NULL, blank nor the repeated header text."""
    text = trim_ws(F.col(key))
    return rows.filter(F.col(key).isNotNull() & ~text.isin("", key))


def random_id() -> Column:
    return F.expr("uuid()")


def content_id(*columns: str) -> Column:
    """SHA-256 of the columns: the same row gets the same id again. NULL differs from empty."""
    return F.sha2(_row_text(columns), 256)


def _row_text(columns: Sequence[str]) -> Column:
    parts = [F.coalesce(F.concat(F.lit("="), F.col(c)), F.lit("-")) for c in columns]
    return F.concat_ws("\u001f", *parts)


def row_hash(*columns: str) -> Column:
    return F.xxhash64(_row_text(columns))


def same_rows(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> bool:
    """Whether both hold the same rows of text columns, each as often, in any order: as many of
    them, and the same sum of their 64-bit hashes. One aggregate a side, without a shuffle of rows.
    """
    hashed = row_hash(*columns).cast("decimal(38,0)")
    marks = [rows.agg(F.count("*"), F.sum(hashed)).first() for rows in (left, right)]
    return marks[0] == marks[1]


def with_provenance(
    rows: DataFrame, load_ts: dt.datetime, origin: str, row_id: Column | None = None
) -> DataFrame:
    """Add load time, origin and row id. ``load_ts`` must carry its time zone."""
    if load_ts.tzinfo is None:
        raise ValueError("load_ts needs a time zone")
    return rows.withColumns(
        {
            "DT_CARGA": F.lit(load_ts),
            "ORIGEM": F.lit(origin),
            "UUID_LINHA": random_id() if row_id is None else row_id,
        }
    )


def latest_load(history: DataFrame, load_column: str = "DT_CARGA") -> DataFrame:
    """Rows of the newest load.

    The newest load is a scalar sub-query, so that it becomes a partition filter on a history
    partitioned by load; a join to it would read the whole history.
    """
    newest = history.agg(F.max(load_column)).scalar()
    return history.filter(F.col(load_column) == newest)
