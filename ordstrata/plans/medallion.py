"""The whole job: files to stage, raw, silver and gold tables, with a log row for each table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordstrata.operators.history import same_rows
from ordstrata.plans.deliveries import CUSTOMERS, ORDERS, Feed, create_ledger, deliver
from ordstrata.plans.gates import gold_gates, silver_gates
from ordstrata.plans.gold import GOLD_TABLES, Rules
from ordstrata.plans.raw import raw_customers, raw_orders
from ordstrata.plans.run_log import EMPTY, LogEntry, create_log, read_log, run_steps
from ordstrata.plans.silver import (
    REASONS,
    SOURCE_ROW,
    checked_customers,
    checked_orders,
    silver_customers,
    silver_orders,
)
from ordstrata.schemas import (
    CUSTOMER_COLUMNS,
    ORDER_COLUMNS,
    PROVENANCE_COLUMNS,
    RAW_CUSTOMERS,
    RAW_ORDERS,
    STAGE_CUSTOMERS,
    STAGE_ORDERS,
    names,
)
from ordstrata.sinks.merged import Merged, MergedTable
from ordstrata.sinks.tables import LOAD_COLUMN, REJECTED, Lake
from ordstrata.sources.delimited import delivered_files, read_delimited

BY_RUN = "_por_rodada"


def load_stage(lake: Lake, load_ts: dt.datetime, customers_path: str, orders_path: str) -> None:
    """Files to the stage tables, as text; each run replaces them. Only failures are logged."""

    def customers() -> int:
        rows = read_delimited(lake.spark, customers_path, STAGE_CUSTOMERS)
        return lake.replace("stage", "stg_cadastro", rows, "Customer file as text")

    def orders() -> int:
        rows = read_delimited(lake.spark, orders_path, STAGE_ORDERS)
        return lake.replace("stage", "stg_pedido", rows, "Order file as text")

    steps = {"stg_cadastro": (customers_path, customers), "stg_pedido": (orders_path, orders)}
    run_steps(lake, load_ts, steps, only_failures=True)


def create_history(lake: Lake) -> None:
    """The history and log tables, where they are missing."""
    lake.create("raw", "raw_cadastro", RAW_CUSTOMERS, "All customer loads", LOAD_COLUMN)
    lake.create("raw", "raw_pedido", RAW_ORDERS, "All order loads", LOAD_COLUMN)
    create_log(lake)


def load_raw(
    lake: Lake,
    load_ts: dt.datetime,
    customers_origin: str,
    orders_origin: str,
    skip_unchanged: bool = False,
) -> None:
    """Stage tables to one more load of the history tables.

    With ``skip_unchanged`` a delivery whose rows are those of the newest load adds no load, so a
    file sent again under a new time is not kept twice.
    """

    def appended(table: str, rows: DataFrame, columns: list[T.StructField]) -> int | None:
        if skip_unchanged and same_rows(rows, lake.latest("raw", table), names(columns)):
            return None
        return lake.append_load("raw", table, rows, load_ts)

    def customers() -> int | None:
        rows = raw_customers(lake.table("stage", "stg_cadastro"), load_ts, customers_origin)
        return appended("raw_cadastro", rows, CUSTOMER_COLUMNS)

    def orders() -> int | None:
        rows = raw_orders(lake.table("stage", "stg_pedido"), load_ts, orders_origin)
        return appended("raw_pedido", rows, ORDER_COLUMNS)

    steps = {"raw_cadastro": (customers_origin, customers), "raw_pedido": (orders_origin, orders)}
    run_steps(lake, load_ts, steps)


def load_deliveries(
    lake: Lake,
    load_ts: dt.datetime,
    customers_path: str,
    orders_path: str,
    by_name: bool = False,
    skip_unchanged: bool = False,
) -> None:
    """Files below the two paths that were not loaded before, through stage to one more load of each
    history table; see :func:`deliver`."""
    create_ledger(lake)

    def step(feed: Feed, path: str) -> tuple[str, Callable[[], list[LogEntry]]]:
        def load() -> list[LogEntry]:
            files = delivered_files(lake.spark, path)
            return deliver(lake, feed, files, load_ts, path, by_name, skip_unchanged)

        return path, load

    feeds = ((CUSTOMERS, customers_path), (ORDERS, orders_path))
    run_steps(lake, load_ts, {feed.history: step(feed, path) for feed, path in feeds})


def load_silver(
    lake: Lake,
    load_ts: dt.datetime,
    as_of: dt.date | None = None,
    gated: bool = False,
    lenient: bool = False,
    customer_buckets: int | None = None,
) -> None:
    """The newest load to the silver tables.

    With ``gated`` a table whose new rows break a rule of :func:`silver_gates` keeps its old version,
    and the step fails. With ``lenient`` rows with text that is no value of its column's type go to
    ``…_rejeitado``, with the names of these columns, instead of failing the run. With
    ``customer_buckets`` both tables lie in hash buckets of the customer (see ``replace_hashed``).
    """
    comments = {"cadastro": "Customers, typed and cleaned", "pedido": "Order lines, typed and cleaned"}

    def written(table: str, rows: DataFrame) -> int | list[LogEntry]:
        gate = silver_gates()[table] if gated else None
        if lenient:
            columns = [c for c in rows.columns if c not in (REASONS, SOURCE_ROW)]
            shown = [SOURCE_ROW, REASONS, LOAD_COLUMN]
            bad = F.size(REASONS) > 0
            found = lake.replace_split("silver", table, rows, bad, columns, shown, comments[table], gate)
            tables = (f"silver.{table}", f"silver.{table}{REJECTED}")
            return [LogEntry(t, n, "raw", note=None if n else EMPTY) for t, n in zip(tables, found)]
        if customer_buckets:
            return lake.replace_hashed(
                "silver", table, rows, "ID_CLIENTE", customer_buckets, comments[table], gate
            )[0]
        return lake.replace("silver", table, rows, comments[table], gate=gate)

    def customers() -> int | list[LogEntry]:
        load = lake.latest("raw", "raw_cadastro")
        rows = checked_customers(load, as_of) if lenient else silver_customers(load, as_of)
        return written("cadastro", rows)

    def orders() -> int | list[LogEntry]:
        load = lake.latest("raw", "raw_pedido")
        return written("pedido", checked_orders(load) if lenient else silver_orders(load))

    if lenient and customer_buckets:
        raise ValueError("rejected rows are kept apart in tables without buckets only")
    steps = {"silver.cadastro": ("raw", customers), "silver.pedido": ("raw", orders)}
    run_steps(lake, load_ts, steps)


def merge_customers(
    lake: Lake, load_ts: dt.datetime, as_of: dt.date | None = None, n_buckets: int = 256
) -> Merged:
    """The newest customers into ``silver.cadastro_atual``, which keeps every customer ever seen with
    the newest values. A customer is touched only if something but the load time and the age has
    changed; the log counts the inserted, and notes the updated and the unchanged."""
    rows = silver_customers(lake.latest("raw", "raw_cadastro"), as_of)
    found: list[Merged] = []

    def merge() -> list[LogEntry]:
        table = MergedTable(
            lake, "silver", "cadastro_atual", rows.schema, ["ID_CLIENTE"], n_buckets, "Customers, merged"
        )
        counts = table.merge(rows, ignore=[LOAD_COLUMN, "IDADE"])
        found.append(counts)
        note = f"updated {counts.updated}, unchanged {counts.kept}"
        return [LogEntry("silver.cadastro_atual", counts.inserted, "raw", note=note)]

    run_steps(lake, load_ts, {"silver.cadastro_atual": ("raw", merge)})
    return found[0]


def load_gold(
    lake: Lake, load_ts: dt.datetime, rules: Rules = Rules(), gated: bool = False
) -> None:
    """The silver tables to the ten result tables; with ``gated`` only those that pass
    the rules of :func:`gold_gates` show their new rows."""
    orders = lake.table("silver", "pedido")
    customers = lake.table("silver", "cadastro")
    gates = gold_gates() if gated else {}

    def writer(name: str) -> Callable[[], int]:
        table = GOLD_TABLES[name]
        return lambda: lake.replace(
            "gold",
            name,
            table.build(orders, customers, rules),
            table.comment,
            table.cluster_by,
            ("ANO", rules.year_boundaries) if table.by_year else None,
            gates.get(name),
        )

    run_steps(lake, load_ts, {f"gold.{name}": ("silver", writer(name)) for name in GOLD_TABLES})


def keep_results(lake: Lake, load_ts: dt.datetime) -> None:
    """Add the results that have no year to tables that hold every run's, partitioned by run. A
    repeated run replaces its own rows."""

    def keeper(name: str) -> Callable[[], int]:
        def keep() -> int:
            rows = lake.table("gold", name)
            schema = T.StructType([*rows.schema.fields, PROVENANCE_COLUMNS[0]])
            comment = f"{GOLD_TABLES[name].comment}, of every run"
            lake.create("gold", name + BY_RUN, schema, comment, LOAD_COLUMN)
            return lake.append_load("gold", name + BY_RUN, rows, load_ts)

        return keep

    small = [name for name, table in GOLD_TABLES.items() if not table.by_year]
    run_steps(lake, load_ts, {f"gold.{name}{BY_RUN}": ("gold", keeper(name)) for name in small})


def read_result(lake: Lake, name: str) -> DataFrame:
    """A result table in the order of its report."""
    return GOLD_TABLES[name].ordered(lake.table("gold", name))


def remove_old_versions(lake: Lake) -> None:
    """Delete what earlier runs left of the replaced tables, except their current versions."""
    replaced = {
        "stage": ["stg_cadastro", "stg_pedido"],
        "silver": ["cadastro", "pedido"],
        "gold": GOLD_TABLES,
    }
    for layer, tables in replaced.items():
        for table in tables:
            lake.remove_old_versions(layer, table)


def run_medallion(
    lake: Lake,
    customers_path: str,
    orders_path: str,
    load_ts: dt.datetime | None = None,
    as_of: dt.date | None = None,
    rules: Rules = Rules(),
    skip_unchanged: bool = False,
    by_run: bool = False,
    once: bool = False,
    by_name: bool = False,
    gated: bool = False,
    lenient: bool = False,
    customer_buckets: int | None = None,
) -> DataFrame:
    """Run all layers for one delivery of the two files and return the log, newest rows first.
    ``skip_unchanged`` is that of :func:`load_raw`; ``by_run`` adds :func:`keep_results`; ``once``
    loads by :func:`load_deliveries`, and so does ``by_name``, with columns found by their headers;
    the last three are those of :func:`load_silver`, and ``gated`` holds for results too.

    Run again with the same ``load_ts`` after a failure: the load is replaced, not added twice.
    The versions before the current one are deleted first, so that two remain: the one that was
    current, for queries still reading it, and the new one. One run at a time.
    """
    load_ts = load_ts or dt.datetime.now(dt.timezone.utc)
    remove_old_versions(lake)
    create_history(lake)
    if once or by_name:
        load_deliveries(lake, load_ts, customers_path, orders_path, by_name, skip_unchanged)
    else:
        load_stage(lake, load_ts, customers_path, orders_path)
        load_raw(lake, load_ts, customers_path, orders_path, skip_unchanged)
    load_silver(lake, load_ts, as_of, gated, lenient, customer_buckets)
    load_gold(lake, load_ts, rules, gated)
    if by_run:
        keep_results(lake, load_ts)
    return read_log(lake)
