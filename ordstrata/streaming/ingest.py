"""Files into the history as they arrive, by Structured Streaming.

The stream is one of files, not of their rows: its checkpoint remembers which files were seen, and
every micro-batch hands its few new files to :func:`deliver`, which reads them as an ordinary job.
A batch that was cut short is repeated with the same files and, as its time is kept in the
checkpoint, under the same load time, so it replaces what it had written.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordstrata.plans.deliveries import CUSTOMERS, ORDERS, Feed, create_ledger, deliver
from ordstrata.plans.gold import Rules
from ordstrata.plans.medallion import create_history, load_gold, load_silver
from ordstrata.plans.run_log import read_log, run_steps
from ordstrata.sinks.tables import LOAD_COLUMN, Lake
from ordstrata.sources.delimited import named_files

# The schema of the binary file source. Contents are never asked for.
BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def ingest(
    lake: Lake,
    feed: Feed,
    folder: str,
    files_per_load: int = 1,
    by_name: bool = False,
    skip_unchanged: bool = False,
) -> int:
    """Load all files that arrived in ``folder`` since the last call and return how many loads were
    added. Files are taken by age, ``files_per_load`` to a load.

    The stream ends when there are no more files (``availableNow``), so a scheduler may call this as
    often as it likes. What was seen is kept below the lake's root, for each history table.
    """
    files = (
        lake.spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("maxFilesPerTrigger", files_per_load)
        .load(folder)
    )
    # The time of the batch: the same again if the batch is repeated.
    arrived = named_files(files).withColumn(LOAD_COLUMN, F.current_timestamp())
    added = 0

    def load(batch: DataFrame, batch_id: int) -> None:
        nonlocal added
        rows = batch.collect()  # files_per_load of them
        if not rows:
            return
        at = rows[0][LOAD_COLUMN].astimezone(dt.timezone.utc)
        own = lake.spark.createDataFrame([tuple(row)[:-1] for row in rows], batch.schema[:-1])
        entries: list = []

        def step() -> list:
            entries.extend(deliver(lake, feed, own, at, folder, by_name, skip_unchanged))
            return entries

        run_steps(lake, at, {feed.history: (folder, step)})
        added += sum(bool(entry.rows) for entry in entries if entry.table == feed.history)

    query = (
        arrived.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{lake.root}/_streams/{feed.history}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return added


def run_ingest(
    lake: Lake,
    customers_folder: str,
    orders_folder: str,
    as_of: dt.date | None = None,
    rules: Rules = Rules(),
    gated: bool = False,
    lenient: bool = False,
    customer_buckets: int | None = None,
    **options,
) -> DataFrame:
    """Load what has arrived in the two folders, rebuild silver and results if that added a load,
    and return the log, newest rows first. ``options`` are those of :func:`ingest`; the others are
    those of :func:`run_medallion`."""
    create_history(lake)
    create_ledger(lake)
    feeds = ((CUSTOMERS, customers_folder), (ORDERS, orders_folder))
    if sum([ingest(lake, feed, folder, **options) for feed, folder in feeds]):
        load_ts = dt.datetime.now(dt.timezone.utc)
        load_silver(lake, load_ts, as_of, gated, lenient, customer_buckets)
        load_gold(lake, load_ts, rules, gated)
    return read_log(lake)
