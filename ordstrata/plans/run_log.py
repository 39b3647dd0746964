"""The audit log: one row per table written."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordstrata.schemas import RUN_LOG, names
from ordstrata.sinks.tables import Lake

# The outcomes in the log.
SUCCESS = "SUCESSO"
FAILURE = "ERRO"

LOG_TABLE = "log_rodadas"
STEPS_AT_ONCE = 4
EMPTY, UNCHANGED = "no rows", "same rows as the newest load"


@dataclass(frozen=True)
class LogEntry:
    table: str
    rows: int | None
    origin: str
    status: str = SUCCESS
    note: str | None = None


def log_rows(
    spark: SparkSession, log: DataFrame, entries: Sequence[LogEntry], at: dt.datetime
) -> DataFrame:
    """Log rows for the entries, numbered on from the highest number in the log.

    One writer numbers all entries of a step; two writers at once could give a number twice.
    """
    given = [(n, e.table, e.rows, e.origin, e.status, e.note) for n, e in enumerate(entries, 1)]
    fields = "N bigint, TABELA string, QTD_INCLUIDO bigint, ORIGEM string, STATUS string"
    rows = spark.createDataFrame(given, f"{fields}, OBSERVACAO string").coalesce(1)
    highest = log.agg(F.coalesce(F.max("ID_RODADA"), F.lit(0).cast("bigint"))).scalar()
    return rows.withColumns(
        {"ID_RODADA": highest + F.col("N"), "DATA_RODADA": F.lit(at)}
    ).select(*names(RUN_LOG))


def create_log(lake: Lake) -> None:
    lake.create("raw", LOG_TABLE, RUN_LOG, "One row per table written")


def append_log(lake: Lake, entries: Sequence[LogEntry], at: dt.datetime) -> None:
    log = lake.table("raw", LOG_TABLE)
    lake.append("raw", LOG_TABLE, log_rows(lake.spark, log, entries, at))


def read_log(lake: Lake) -> DataFrame:
    """The log, newest rows first."""
    return lake.table("raw", LOG_TABLE).orderBy(F.desc("DATA_RODADA"), F.desc("ID_RODADA"))


def run_steps(
    lake: Lake,
    at: dt.datetime,
    steps: dict[str, tuple[str, Callable[[], int | None | list[LogEntry]]]],
    only_failures: bool = False,
) -> list[LogEntry]:
    """Run independent steps that each write a table, a few at a time, and log them together. A
    step gives the number of rows it wrote, or None if it left the table as it was, or its own
    log entries.

    Every step is tried. Failed ones are logged too, then the first failure is raised; trouble with
    the log itself does not hide it.
    """
    errors = []

    def tried(step: tuple[str, tuple[str, Callable]]) -> list[LogEntry]:
        table, (origin, write) = step
        try:
            rows = write()
        except Exception as error:
            errors.append(error)
            return [LogEntry(table, None, origin, FAILURE, str(error))]
        if isinstance(rows, list):
            return rows
        if rows is None:
            return [LogEntry(table, 0, origin, note=UNCHANGED)]
        return [LogEntry(table, rows, origin, note=None if rows else EMPTY)]

    with ThreadPoolExecutor(STEPS_AT_ONCE) as pool:
        entries = [entry for found in pool.map(tried, steps.items()) for entry in found]
    if only_failures:
        entries = [e for e in entries if e.status == FAILURE]
    try:
        if entries:
            append_log(lake, entries, at)
    finally:
        if errors:
            raise errors[0]
    return entries
