"""The registered queries: each takes a session and a folder of test tables."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import deliveries, quality  # noqa: F401 - register their queries
from checks.mapping import (
    AS_OF,
    CUSTOMER_FILE,
    FIRST_LOAD,
    ORDER_FILE,
    RULES,
    SECOND_LOAD,
    stage_customers,
    stage_orders,
    with_unnamed,
)
from checks.operators import OPERATORS
from checks.setup import new_lake
from ordstrata.operators.history import content_id, latest_load
from ordstrata.plans import gold
from ordstrata.plans.medallion import (
    BY_RUN,
    create_history,
    keep_results,
    load_raw,
    run_medallion,
)
from ordstrata.plans.raw import raw_customers, raw_orders
from ordstrata.plans.run_log import LogEntry, append_log, read_log
from ordstrata.plans.silver import silver_customers, silver_orders
from ordstrata.schemas import (
    CUSTOMER_COLUMNS,
    ORDER_COLUMNS,
    STAGE_CUSTOMERS,
    STAGE_ORDERS,
    names,
)
from ordstrata.session import scratch_folder
from ordstrata.sources.delimited import header_drift, read_delimited, write_delimited

Query = Callable[[SparkSession, str], DataFrame]


def portable(rows: DataFrame) -> DataFrame:
    """Decimals as double, dates and times as text, as the oracles give them."""
    shown = []
    for field in rows.schema:
        kind = field.dataType.typeName()
        cast = {"decimal": "double", "date": "string", "timestamp": "string"}.get(kind)
        shown.append(F.col(field.name).cast(cast).alias(field.name) if cast else field.name)
    return rows.select(*shown)


def customer_load(spark: SparkSession, sf_dir: str, load_ts=FIRST_LOAD) -> DataFrame:
    row_id = content_id(*names(CUSTOMER_COLUMNS))
    return raw_customers(stage_customers(spark, sf_dir), load_ts, CUSTOMER_FILE, row_id)


def order_load(spark: SparkSession, sf_dir: str, load_ts=FIRST_LOAD) -> DataFrame:
    row_id = content_id(*names(ORDER_COLUMNS))
    return raw_orders(stage_orders(spark, sf_dir), load_ts, ORDER_FILE, row_id)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_customers(customer_load(spark, sf_dir), AS_OF)


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver_orders(order_load(spark, sf_dir))


def write_files(
    spark: SparkSession, sf_dir: str, folder: str, compression: str | None = None
) -> tuple[str, str]:
    """The two source files as delimited text, which a codec such as gzip packs to a third."""
    customers_path, orders_path = f"{folder}/files/customers", f"{folder}/files/orders"
    write_delimited(with_unnamed(stage_customers(spark, sf_dir)), customers_path, compression)
    write_delimited(stage_orders(spark, sf_dir), orders_path, compression)
    return customers_path, orders_path


def file_stage_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/customers"
    write_delimited(with_unnamed(stage_customers(spark, sf_dir)), path)
    return read_delimited(spark, path, STAGE_CUSTOMERS)


def file_stage_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_folder(spark)}/orders"
    write_delimited(stage_orders(spark, sf_dir), path)
    return read_delimited(spark, path, STAGE_ORDERS)


def customer_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two whole loads in a history table partitioned by load."""
    lake = new_lake(spark)
    create_history(lake)
    for load_ts in (FIRST_LOAD, SECOND_LOAD):
        rows = customer_load(spark, sf_dir, load_ts)
        lake.append_load("raw", "raw_cadastro", rows, load_ts)
    return lake.table("raw", "raw_cadastro")


def newest_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portable(latest_load(customer_history(spark, sf_dir)))


def logged_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two loads of both history tables, and the log of them."""
    lake = new_lake(spark)
    create_history(lake)
    lake.replace("stage", "stg_cadastro", with_unnamed(stage_customers(spark, sf_dir)))
    lake.replace("stage", "stg_pedido", stage_orders(spark, sf_dir))
    for load_ts in (FIRST_LOAD, SECOND_LOAD):
        load_raw(lake, load_ts, CUSTOMER_FILE, ORDER_FILE)
    return portable(read_log(lake))


def newest_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log of the rows of two result tables, newest first."""
    lake = new_lake(spark)
    create_history(lake)
    lines, people = order_lines(spark, sf_dir), customers(spark, sf_dir)
    results = {
        "cancelamento_por_departamento": gold.cancellation_rate(lines),
        "crescimento_base_clientes": gold.base_growth(people),
    }
    for at, (table, rows) in zip((FIRST_LOAD, SECOND_LOAD), results.items()):
        written = lake.replace("gold", table, rows)
        append_log(lake, [LogEntry(f"gold.{table}", written, "silver")], at)
    return portable(read_log(lake)).drop("OBSERVACAO")


def whole_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    lake = new_lake(spark)
    paths = write_files(spark, sf_dir, lake.root)
    log = run_medallion(lake, *paths, load_ts=FIRST_LOAD, as_of=AS_OF, rules=RULES)
    origin = F.substring_index("ORIGEM", "/", -1).alias("ORIGEM")
    return log.select("TABELA", "QTD_INCLUIDO", origin, "STATUS")


def job_newest_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest load with rows, as the job reads it, after a load without any."""
    lake = new_lake(spark)
    create_history(lake)
    for load_ts in (FIRST_LOAD, SECOND_LOAD, SECOND_LOAD + dt.timedelta(days=1)):
        rows = customer_load(spark, sf_dir, load_ts)
        if load_ts > SECOND_LOAD:
            rows = rows.filter(F.col("ID") == "ID")
        lake.append_load("raw", "raw_cadastro", rows, load_ts)
    return portable(lake.latest("raw", "raw_cadastro"))


def repeated_deliveries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per load after a delivery came twice and then with rows added."""
    lake = new_lake(spark)
    create_history(lake)
    people, lines = stage_customers(spark, sf_dir), stage_orders(spark, sf_dir)
    lake.replace("stage", "stg_pedido", lines)
    for days, delivered in enumerate((people, people, people.union(people.filter("ID IS NOT NULL")))):
        lake.replace("stage", "stg_cadastro", with_unnamed(delivered))
        at = FIRST_LOAD + dt.timedelta(days=days)
        load_raw(lake, at, CUSTOMER_FILE, ORDER_FILE, skip_unchanged=True)
    loads = [
        lake.table("raw", t).groupBy("DT_CARGA").count().select(F.lit(t).alias("TABELA"), "*")
        for t in ("raw_cadastro", "raw_pedido")
    ]
    return portable(loads[0].union(loads[1]))


def results_of_two_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A small result as the whole job keeps it, and as a later run does, repeated."""
    lake = new_lake(spark)
    paths = write_files(spark, sf_dir, lake.root)
    run_medallion(lake, *paths, load_ts=FIRST_LOAD, as_of=AS_OF, rules=RULES, by_run=True)
    for _ in range(2):
        keep_results(lake, SECOND_LOAD)
    return portable(lake.table("gold", "cancelamento_por_departamento" + BY_RUN))


def drifted_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header differences of a customer file with two columns swapped and one added."""
    path = f"{scratch_folder(spark)}/customers"
    stage = with_unnamed(stage_customers(spark, sf_dir))
    order = names(STAGE_CUSTOMERS)
    order[1], order[2] = order[2], order[1]
    write_delimited(stage.select(*order, F.lit("x").alias("TELEFONE")), path)
    return header_drift(spark, path, STAGE_CUSTOMERS).drop("file").distinct()


def _stored(layer: str, table: str) -> Query:
    """A table as two runs of the whole job leave it."""

    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        lake = new_lake(spark)
        paths = write_files(spark, sf_dir, lake.root, "gzip")
        for load_ts in (FIRST_LOAD, SECOND_LOAD):
            run_medallion(lake, *paths, load_ts=load_ts, as_of=AS_OF, rules=RULES)
        return portable(lake.table(layer, table))

    return read


def _gold(build: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(order_lines(spark, sf_dir), customers(spark, sf_dir))


def _of_orders(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(order_lines(spark, sf_dir))


def _of_customers(build: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(customers(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {
        "stage_customers": file_stage_customers,
        "stage_orders": file_stage_orders,
        "raw_customers": lambda spark, sf_dir: portable(customer_load(spark, sf_dir)),
        "raw_orders": lambda spark, sf_dir: portable(order_load(spark, sf_dir)),
        "latest_load": newest_customers,
        "silver_customers": lambda spark, sf_dir: portable(customers(spark, sf_dir)),
        "silver_orders": lambda spark, sf_dir: portable(order_lines(spark, sf_dir)),
        "gold_orders_by_semester": _gold(gold.orders_by_semester),
        "gold_avg_ticket_month": _gold(gold.avg_ticket_month),
        "gold_purchase_interval": _gold(gold.purchase_interval),
        "gold_monthly_tiers": _gold(lambda o, c: gold.monthly_tiers(o, c, RULES.tier_limits)),
        "gold_category_yoy": _of_orders(
            lambda o: gold.category_yoy(o, RULES.categories, RULES.years)
        ),
        "gold_cancellation_rate": _of_orders(gold.cancellation_rate),
        "gold_weekday_volume": _of_orders(gold.weekday_volume),
        "gold_optin_impact": _gold(gold.optin_impact),
        "gold_retention": _gold(lambda o, c: gold.retention(o, c, RULES.years)),
        "gold_base_growth": _of_customers(gold.base_growth),
        "run_log": logged_loads,
        "log_newest_first": newest_log_rows,
        "run_medallion": whole_job,
        "job_latest_load": job_newest_load,
        "repeated_deliveries": repeated_deliveries,
        "results_of_two_runs": results_of_two_runs,
        "drifted_headers": drifted_headers,
        "job_silver_orders": _stored("silver", "pedido"),
        "job_gold_monthly_tiers": _stored("gold", "tiers_clientes"),
        **{key: query for key, (query, _) in OPERATORS.items()},
    }
