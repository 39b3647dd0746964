"""Deliveries: files into the history, each of them once.

A ledger holds every file that was loaded, with its length, its modification time and what its rows
add up to. A file that it knows is left alone, whenever it is seen again. The ledger is written twice:
before a load begins, with its time, and when it has ended. A run that was cut short in between is
repeated under the same load time, which replaces what it had written.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordstrata.operators.history import keyed_rows, row_hash
from ordstrata.plans.raw import raw_customers, raw_orders
from ordstrata.plans.run_log import EMPTY, UNCHANGED, LogEntry
from ordstrata.schemas import DELIVERIES, RAW_CUSTOMERS, RAW_ORDERS, STAGE_CUSTOMERS, STAGE_ORDERS, names
from ordstrata.sinks.tables import LOAD_COLUMN, REJECTED, Lake
from ordstrata.sources.delimited import (
    FILE_COLUMN,
    REASON,
    REJECTED_LINE,
    read_by_name,
    read_rejecting,
)

LEDGER_TABLE = "entregas"
# The states of a file in the ledger.
BEGUN, DONE, SAME = "INICIO", "FIM", "IGUAL"
IDENTITY = [FILE_COLUMN, "TAMANHO", "DT_MODIFICACAO"]
KNOWN = "files loaded before"
HASH_COLUMN = "HASH_LINHA"
AT_ONCE = dt.timedelta(microseconds=1)


@dataclass(frozen=True)
class Feed:
    """A kind of file and the tables it goes to."""

    stage: str
    history: str
    schema: T.StructType
    history_schema: T.StructType
    key: str
    raw: Callable[..., DataFrame]
    comment: str


CUSTOMERS = Feed(
    "stg_cadastro", "raw_cadastro", STAGE_CUSTOMERS, RAW_CUSTOMERS, "ID", raw_customers, "Customer file as text"
)
ORDERS = Feed(
    "stg_pedido", "raw_pedido", STAGE_ORDERS, RAW_ORDERS, "COD_CLIENTE", raw_orders, "Order file as text"
)


def create_ledger(lake: Lake) -> None:
    lake.create("raw", LEDGER_TABLE, DELIVERIES, "Files loaded into the history")


def deliver(
    lake: Lake,
    feed: Feed,
    files: DataFrame,
    at: dt.datetime,
    origin: str,
    by_name: bool = False,
    skip_unchanged: bool = False,
) -> list[LogEntry]:
    """Load those of ``files`` (see ``delivered_files``) that the ledger does not know, as one load
    at the time ``at``, and return what there is to log.

    Rows with too few or too many fields go to the stage table ``…_rejeitado`` with the reason. With
    ``by_name`` columns are found by the headers, and new ones are added to the history. With
    ``skip_unchanged`` files whose rows are, together, those of the newest load add no load; the
    ledger alone tells, and knows them afterwards. A *new* file that returns to the rows of an older
    load is a load like others.
    """
    ledger = lake.table("raw", LEDGER_TABLE).filter(F.col("TABELA") == feed.history)
    ended = ledger.filter(F.col("ESTADO").isin(DONE, SAME))
    # One row for each file: the reader needs their paths here anyway.
    new = files.join(ended, IDENTITY, "left_anti").collect()
    if not new:
        return [LogEntry(feed.history, 0, origin, note=KNOWN)]
    paths = sorted(row.path for row in new)
    load_ts = _load_time(ledger, new, at, lake)
    _note(lake, feed, new, load_ts, BEGUN, {})

    rows, more = _read(lake, feed, paths, by_name)
    shown = [*names(feed.schema), *more]
    hashed = row_hash(*(c for c in names(feed.history_schema) + more if c in rows.columns))
    good, rejected = lake.replace_split(
        "stage",
        feed.stage,
        rows.withColumn(HASH_COLUMN, hashed),
        F.col(REASON).isNotNull(),
        shown,
        [REJECTED_LINE, REASON, FILE_COLUMN],
        feed.comment,
    )
    entries = [LogEntry(feed.stage + REJECTED, rejected, origin, note=None if rejected else EMPTY)]
    kept = keyed_rows(lake.part("stage", feed.stage, False), feed.key)
    sums = {
        row[FILE_COLUMN]: (row.n, row.total)
        for row in kept.groupBy(FILE_COLUMN)
        .agg(F.count("*").alias("n"), F.sum(F.col(HASH_COLUMN).cast("decimal(38,0)")).alias("total"))
        .collect()
    }
    if skip_unchanged and sums and _newest(ledger) == tuple(map(sum, zip(*sums.values()))):
        _note(lake, feed, new, load_ts, SAME, sums)
        return [*entries, LogEntry(feed.history, 0, origin, note=UNCHANGED)]
    added = lake.add_columns("raw", feed.history, [rows.schema[c] for c in more])
    history = feed.raw(lake.table("stage", feed.stage), load_ts, origin, more=more)
    # Columns that files before these ones brought.
    lacking = [f for f in lake.table("raw", feed.history).schema if f.name not in history.columns]
    nothing = {f.name: F.lit(None).cast(f.dataType) for f in lacking}
    written = lake.append_load("raw", feed.history, history.withColumns(nothing), load_ts)
    _note(lake, feed, new, load_ts, DONE, sums)
    note = f"new columns: {', '.join(added)}" if added else None
    return [*entries, LogEntry(feed.history, written, origin, note=note if written else EMPTY)]


def _read(lake: Lake, feed: Feed, paths: list[str], by_name: bool) -> tuple[DataFrame, list[str]]:
    """Rows of the files and the names of columns that the feed does not know."""
    if not by_name:
        return read_rejecting(lake.spark, paths, feed.schema), []
    rows = read_by_name(lake.spark, paths, feed.schema, [feed.key])
    known = {*names(feed.schema), *names(feed.history_schema), REJECTED_LINE, REASON, FILE_COLUMN}
    return rows, [c for c in rows.columns if c not in known]


def _load_time(ledger: DataFrame, new: list, at: dt.datetime, lake: Lake) -> dt.datetime:
    """The time under which a load of some of these files has begun before, else ``at``, or the next
    time after it that no other load has."""
    fields = "ARQUIVO string, TAMANHO long, DT_MODIFICACAO timestamp"
    identities = lake.spark.createDataFrame([tuple(row[c] for c in IDENTITY) for row in new], fields)
    begun = ledger.filter(F.col("ESTADO") == BEGUN).join(identities, IDENTITY, "left_semi")
    if before := begun.agg(F.max(LOAD_COLUMN)).first()[0]:
        return before.astimezone(dt.timezone.utc)
    taken = {
        row[0].astimezone(dt.timezone.utc)
        for row in ledger.filter(F.col(LOAD_COLUMN) >= F.lit(at)).select(LOAD_COLUMN).distinct().collect()
    }
    while at in taken:
        at += AT_ONCE
    return at


def _newest(ledger: DataFrame) -> tuple | None:
    """Number and sum of hashes of the rows of the newest load that has any."""
    loads = ledger.filter((F.col("ESTADO") == DONE) & (F.col("QTD_LINHAS") > 0))
    newest = loads.groupBy(LOAD_COLUMN).agg(
        F.sum("QTD_LINHAS").alias("n"), F.sum("SOMA_HASH").alias("total")
    )
    row = newest.orderBy(F.desc(LOAD_COLUMN)).first()
    return (row.n, row.total) if row else None


def _note(
    lake: Lake, feed: Feed, files: list, load_ts: dt.datetime, state: str, sums: dict[str, tuple]
) -> None:
    ended = state != BEGUN
    rows = [
        (feed.history, *(f[c] for c in IDENTITY), load_ts, state)
        + (sums.get(f[FILE_COLUMN], (0, None)) if ended else (None, None))
        for f in files
    ]
    lake.append("raw", LEDGER_TABLE, lake.spark.createDataFrame(rows, DELIVERIES).coalesce(1))
