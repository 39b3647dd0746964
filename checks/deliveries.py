"""Registered queries on deliveries, rejected rows, merges, layouts and gates, each with its SQL."""

from __future__ import annotations

import contextlib
import datetime as dt

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.mapping import AS_OF, FIRST_LOAD, RULES, stage_customers, stage_orders, with_unnamed
from checks.operators import _ORDERS, _orders, operator
from checks.oracles import oracle_sql, raw_sql, silver_sql, stage_sql
from checks.setup import new_lake
from ordstrata.operators.expectations import ExpectationsFailed, Gate
from ordstrata.plans import gold
from ordstrata.plans.deliveries import CUSTOMERS, KNOWN, ORDERS, create_ledger, deliver
from ordstrata.plans.medallion import (
    create_history,
    load_deliveries,
    load_silver,
    merge_customers,
    read_result,
)
from ordstrata.plans.raw import raw_customers, raw_orders
from ordstrata.plans.run_log import read_log, run_steps
from ordstrata.plans.silver import silver_customers, silver_orders
from ordstrata.schemas import ORDER_COLUMNS, names
from ordstrata.sinks.merged import MergedTable
from ordstrata.sinks.tables import Lake
from ordstrata.sources.delimited import delivered_files, write_delimited
from ordstrata.streaming.ingest import ingest

_DAYS = [FIRST_LOAD + dt.timedelta(days=n) for n in range(5)]
_BUCKETS = 8


def _delivery_lake(spark: SparkSession) -> Lake:
    lake = new_lake(spark)
    create_history(lake)
    create_ledger(lake)
    return lake


def _loads_of_stage(lake: Lake, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A load of customers and one of order lines, from stage tables written here."""
    lake.replace("stage", "stg_cadastro", stage_customers(lake.spark, sf_dir))
    lake.replace("stage", "stg_pedido", stage_orders(lake.spark, sf_dir))
    return (
        raw_customers(lake.table("stage", "stg_cadastro"), FIRST_LOAD, "x"),
        raw_orders(lake.table("stage", "stg_pedido"), FIRST_LOAD, "x"),
    )


def _people(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_unnamed(stage_customers(spark, sf_dir))


# Deliveries


def _ledger_sql() -> str:
    def row(day: int, table: str, n: str, note: str) -> str:
        return f"SELECT '{table}' AS TABELA, {n} AS QTD_INCLUIDO, '{_DAYS[day]:%F %T}' AS DATA_RODADA, {note} AS OBSERVACAO"

    everyone, stated = "(SELECT count(*) FROM raw_customers)", "(SELECT count(*) FROM raw_customers WHERE ESTADO IS NOT NULL)"
    lines = "(SELECT count(*) FROM raw_orders)"
    loaded = {0: everyone, 2: stated, 4: everyone}
    rows = [row(0, "raw_pedido", lines, "NULL"), row(0, "stg_pedido_rejeitado", "0", "'no rows'")]
    rows += [row(d, "raw_pedido", "0", f"'{KNOWN}'") for d in range(1, 5)]
    for day in range(5):
        if day in loaded:
            rows.append(row(day, "raw_cadastro", loaded[day], "NULL"))
            rows.append(row(day, "stg_cadastro_rejeitado", "0", "'no rows'"))
        else:
            rows.append(row(day, "raw_cadastro", "0", f"'{KNOWN}'"))
    rows.append(row(4, "newest", everyone, "NULL"))
    return raw_sql(" UNION ALL ".join(rows))


@operator(_ledger_sql())
def ledger_of_loads(spark, sf_dir):
    """The log of five days: a file, the same again, another, the first again, and a new file with the
    first one's rows; and how many rows the newest load has."""
    lake = _delivery_lake(spark)
    people = _people(spark, sf_dir)
    first, other, back, lines = (f"{lake.root}/in/{name}" for name in "abcd")
    write_delimited(people, first)
    write_delimited(people.filter("ESTADO IS NOT NULL"), other)
    write_delimited(people, back)
    write_delimited(stage_orders(spark, sf_dir), lines)
    for at, path in zip(_DAYS, (first, first, other, first, back)):
        load_deliveries(lake, at, path, lines, skip_unchanged=True)
    newest = lake.latest("raw", "raw_cadastro").agg(F.count("*").alias("QTD_INCLUIDO"))
    log = read_log(lake).select(
        "TABELA", "QTD_INCLUIDO", F.col("DATA_RODADA").cast("string").alias("DATA_RODADA"), "OBSERVACAO"
    )
    return log.union(
        newest.select(
            F.lit("newest"), "QTD_INCLUIDO", F.lit(f"{_DAYS[4]:%F %T}"), F.lit(None).cast("string")
        )
    )


class _Dying(Lake):
    """A lake whose run ends when a load is written and the ledger should say so."""

    def append(self, layer, table, rows):
        if table == "entregas" and not rows.filter("ESTADO = 'FIM'").isEmpty():
            raise InterruptedError("killed")
        super().append(layer, table, rows)


@operator(raw_sql("""SELECT nth, count(*) AS n, count(DISTINCT ID) AS n_ids FROM (
    SELECT 1 AS nth, ID FROM raw_customers UNION ALL SELECT 2, ID FROM raw_customers WHERE ESTADO IS NOT NULL
    UNION ALL SELECT 3, ID FROM raw_customers WHERE SEXO IS NOT NULL) GROUP BY nth"""))
def streamed_arrivals(spark, sf_dir):
    """Loads of files that arrive in a folder: one, the same seen again, a second, and a third whose
    run is killed between the load and the commit and repeated."""
    lake = _delivery_lake(spark)
    people, folder = _people(spark, sf_dir), f"{lake.root}/in"
    arrivals = f"{folder}/*"

    def arrive(name: str, rows: DataFrame) -> None:
        write_delimited(rows, f"{folder}/{name}")

    arrive("a", people)
    for _ in range(2):
        ingest(lake, CUSTOMERS, arrivals, 1000)
    arrive("b", people.filter("ESTADO IS NOT NULL"))
    ingest(lake, CUSTOMERS, arrivals, 1000)
    arrive("c", people.filter("SEXO IS NOT NULL"))
    with contextlib.suppress(Exception):
        ingest(_Dying(spark, lake.root, lake.namespace), CUSTOMERS, arrivals, 1000)
    for _ in range(2):
        ingest(lake, CUSTOMERS, arrivals, 1000)
    nth = F.dense_rank().over(Window.orderBy("DT_CARGA"))  # one row per load
    loads = lake.table("raw", "raw_cadastro").groupBy("DT_CARGA")
    counted = loads.agg(F.count("*").alias("n"), F.countDistinct("ID").alias("n_ids"))
    return counted.select(nth.alias("nth"), "n", "n_ids")


def _line(columns: list[str], more: str = "") -> str:
    """A row as the writer puts it."""
    fields = [f"CASE WHEN {c} IS NULL THEN '' WHEN {c} = '' THEN '\"\"' ELSE {c} END" for c in columns]
    return " || ';' || ".join(fields) + more


_FIELDS = names(ORDER_COLUMNS)
_NTH = "CAST(COD_PEDIDO AS BIGINT) % 5"


@operator(stage_sql(f"""SELECT 'rejected' AS kind, {_line(_FIELDS[:-1])} AS line, 'short' AS reason, NULL AS n
    FROM stg_orders WHERE {_NTH} = 0
  UNION ALL SELECT 'rejected', {_line(_FIELDS, " || ';x'")}, 'long', NULL FROM stg_orders WHERE {_NTH} = 1
  UNION ALL SELECT 'good', COD_PEDIDO || ';' || CODIGO_PRODUTO, NULL, NULL FROM stg_orders WHERE {_NTH} > 1
  UNION ALL SELECT 'log', 'stg_pedido_rejeitado', NULL, (SELECT count(*) FROM stg_orders WHERE {_NTH} < 2)
  UNION ALL SELECT 'log', 'raw_pedido', NULL, (SELECT count(*) FROM stg_orders WHERE {_NTH} > 1
    AND COD_CLIENTE IS NOT NULL AND trim(COD_CLIENTE) <> '')"""))
def rejected_lines(spark, sf_dir):
    """Order files with rows of a field less and of one more, as the stage tables and the log hold them."""
    lake = _delivery_lake(spark)
    lines = stage_orders(spark, sf_dir)
    folder = f"{lake.root}/in"
    write_delimited(lines.filter(f"{_NTH} > 1"), f"{folder}/good")
    write_delimited(lines.filter(f"{_NTH} = 0").select(*_FIELDS[:-1]), f"{folder}/short")
    write_delimited(lines.filter(f"{_NTH} = 1").select(*_FIELDS, F.lit("x").alias("more")), f"{folder}/long")
    path = f"{folder}/*"
    run_steps(
        lake,
        FIRST_LOAD,
        {"raw_pedido": (path, lambda: deliver(lake, ORDERS, delivered_files(spark, path), FIRST_LOAD, path))},
    )
    nothing, no_count = F.lit(None).cast("string"), F.lit(None).cast("bigint")
    rejected = lake.table("stage", "stg_pedido_rejeitado")
    good = lake.table("stage", "stg_pedido")
    return (
        rejected.select(
            F.lit("rejected").alias("kind"), F.col("LINHA").alias("line"), F.col("MOTIVO").alias("reason"), no_count.alias("n")
        )
        .union(good.select(F.lit("good"), F.concat_ws(";", "COD_PEDIDO", "CODIGO_PRODUTO"), nothing, no_count))
        .union(read_log(lake).select(F.lit("log"), "TABELA", nothing, "QTD_INCLUIDO"))
    )


@operator(raw_sql("""SELECT ID, NOME, EMAIL, CAST(NULL AS VARCHAR) AS TELEFONE, 1 AS nth FROM raw_customers
  UNION ALL SELECT ID, NOME, EMAIL, '9' || trim(ID), 2 FROM raw_customers
  UNION ALL SELECT ID, NOME, NULL, NULL, 3 FROM raw_customers"""))
def columns_by_name(spark, sf_dir):
    """History of a file as it should be, one with two columns swapped and one added, and one with a
    column less."""
    lake = _delivery_lake(spark)
    people = _people(spark, sf_dir)
    swapped = people.columns
    swapped[1], swapped[2] = swapped[2], swapped[1]
    phone = F.concat(F.lit("9"), F.trim("ID")).alias("TELEFONE")
    layouts = [people, people.select(*swapped, phone), people.drop("EMAIL")]
    for nth, (at, rows) in enumerate(zip(_DAYS, layouts), 1):
        path = f"{lake.root}/in/{nth}"
        write_delimited(rows, path)
        deliver(lake, CUSTOMERS, delivered_files(spark, path), at, path, by_name=True)
    nth = F.datediff("DT_CARGA", F.lit(FIRST_LOAD)) + 1
    return lake.table("raw", "raw_cadastro").select("ID", "NOME", "EMAIL", "TELEFONE", nth.alias("nth"))


# Casts


_KEY = "CAST(COD_PEDIDO AS BIGINT)"
_PLANTED = {
    "COD_PEDIDO": f"CASE WHEN {_KEY} % 53 = 0 THEN 'x' || COD_PEDIDO ELSE COD_PEDIDO END",
    "VALOR_UNITARIO": f"CASE WHEN {_KEY} % 59 = 0 THEN '1,5' WHEN {_KEY} % 61 = 0 THEN '1e-20'"
    f" WHEN {_KEY} % 47 = 0 THEN '125e-2' ELSE VALOR_UNITARIO END",
    "QTD_PARCELAS": f"CASE WHEN {_KEY} % 67 = 0 THEN 'dois' ELSE QTD_PARCELAS END",
    "DT_PEDIDO": f"CASE WHEN {_KEY} % 71 = 0 THEN '31/02/1997' ELSE DT_PEDIDO END",
}
_BAD = {
    "COD_PEDIDO": f"{_KEY} % 53 = 0",
    "VALOR_UNITARIO": f"({_KEY} % 59 = 0 OR {_KEY} % 61 = 0)",
    "QTD_PARCELAS": f"{_KEY} % 67 = 0",
    "DT_PEDIDO": f"{_KEY} % 71 = 0",
}
_REASONS = " || ".join(f"CASE WHEN {bad} THEN '{name},' ELSE '' END" for name, bad in _BAD.items())


@operator(raw_sql(f"""SELECT {_PLANTED["COD_PEDIDO"]} AS order_id, CODIGO_PRODUTO AS product, reasons,
    CASE WHEN reasons = '' THEN CAST(CASE WHEN {_KEY} % 47 = 0 THEN 1.25 ELSE CAST(VALOR_UNITARIO AS DECIMAL(14,2)) END AS DOUBLE) END AS price
  FROM (SELECT *, {_REASONS} AS reasons FROM raw_orders)
  WHERE upper(trim(STATUS_PAGAMENTO)) IN ('CONFIRMADO', 'CANCELADO') AND ({_BAD["VALOR_UNITARIO"]}
    OR CASE WHEN {_KEY} % 47 = 0 THEN TRUE ELSE CAST(VALOR_UNITARIO AS DECIMAL(14,2)) > 0 END)"""))
def cast_failures(spark, sf_dir):
    """Order lines with planted text that is no id, price, number or date: the good ones typed, the
    others with the columns that failed."""
    lake = _delivery_lake(spark)
    lines = raw_orders(stage_orders(spark, sf_dir), FIRST_LOAD, "x")
    planted = lines.withColumns({c: F.expr(sql) for c, sql in _PLANTED.items()})
    lake.append_load("raw", "raw_pedido", planted, FIRST_LOAD)
    people = raw_customers(stage_customers(spark, sf_dir), FIRST_LOAD, "x")
    lake.append_load("raw", "raw_cadastro", people, FIRST_LOAD)
    load_silver(lake, FIRST_LOAD, AS_OF, lenient=True)
    good = lake.table("silver", "pedido").select(
        F.col("ID_PEDIDO").cast("string").alias("order_id"),
        F.col("ID_PRODUTO").cast("string").alias("product"),
        F.lit("").alias("reasons"),
        F.col("VALOR_UNITARIO").cast("double").alias("price"),
    )
    failed = lake.table("silver", "pedido_rejeitado").select(
        "BRUTO.COD_PEDIDO",
        "BRUTO.CODIGO_PRODUTO",
        F.concat(F.array_join("MOTIVOS", ","), F.lit(",")),
        F.lit(None).cast("double"),
    )
    return good.union(failed)


# Merges


@operator(_ORDERS + """, old AS (SELECT o_custkey, count(*) AS n, max(day)::VARCHAR AS last_day FROM o
    WHERE year <= 1996 GROUP BY o_custkey),
  new AS (SELECT o_custkey, count(*) AS n, max(day)::VARCHAR AS last_day FROM o
    WHERE o_custkey % 3 = 0 GROUP BY o_custkey)
  SELECT o_custkey, coalesce(new.n, old.n) AS n, coalesce(new.last_day, old.last_day) AS last_day,
    (SELECT count(*) FROM new WHERE o_custkey NOT IN (SELECT o_custkey FROM old)) AS inserted,
    (SELECT count(*) FROM new JOIN old USING (o_custkey) WHERE new.n <> old.n OR new.last_day <> old.last_day) AS updated,
    (SELECT count(*) FROM new JOIN old USING (o_custkey) WHERE new.n = old.n AND new.last_day = old.last_day) AS kept
  FROM old FULL JOIN new USING (o_custkey)""")
def merged_table(spark, sf_dir):
    """Order counts of customers in a stored table after two merges, and what the second one did."""

    def snapshot(orders: DataFrame) -> DataFrame:
        days = orders.groupBy("o_custkey")
        return days.agg(F.count("*").alias("n"), F.max("day").cast("string").alias("last_day"))

    orders = _orders(spark, sf_dir)
    schema = T.StructType.fromDDL("o_custkey bigint, n bigint, last_day string")
    table = MergedTable(new_lake(spark), "silver", "counts", schema, ["o_custkey"], _BUCKETS)
    table.merge(snapshot(orders.filter("year <= 1996")))
    done = table.merge(snapshot(orders.filter("o_custkey % 3 = 0")))
    shown = {name: F.lit(getattr(done, name)).cast("bigint") for name in ("inserted", "updated", "kept")}
    return table.rows().withColumns(shown)


@operator(silver_sql("""SELECT 'row' AS kind, CAST(ID_CLIENTE AS VARCHAR) AS what,
    CASE WHEN ID_CLIENTE % 4 = 0 THEN 'NOWHERE' ELSE CIDADE END AS city, NULL AS n FROM customers
  UNION ALL SELECT 'log', NULL, NULL, (SELECT count(*) FROM customers WHERE ID_CLIENTE % 2 = 0)
  UNION ALL SELECT 'log', 'updated ' || (SELECT count(*) FROM customers WHERE ID_CLIENTE % 4 = 0) || ', unchanged '
      || (SELECT count(*) FROM customers WHERE ID_CLIENTE % 4 = 2), NULL,
    (SELECT count(*) FROM customers WHERE ID_CLIENTE % 2 = 1)"""))
def merged_customers(spark, sf_dir):
    """The merged customers and the log after a load of half of them, and one of all with a city
    changed for a quarter."""
    lake = _delivery_lake(spark)
    people = raw_customers(stage_customers(spark, sf_dir), FIRST_LOAD, "x")
    key = F.trim("ID").cast("bigint")
    city = F.when(key % 4 == 0, F.lit("nowhere")).otherwise(F.col("CIDADE"))
    loads = (people.filter(key % 2 == 0), people.withColumn("CIDADE", city))
    for at, load in zip(_DAYS, loads):
        lake.append_load("raw", "raw_cadastro", load, at)
        merge_customers(lake, at, AS_OF, _BUCKETS)
    rows = lake.table("silver", "cadastro_atual").select(
        F.lit("row").alias("kind"),
        F.col("ID_CLIENTE").cast("string").alias("what"),
        F.col("CIDADE").alias("city"),
        F.lit(None).cast("bigint").alias("n"),
    )
    note = F.when(F.col("DATA_RODADA") > F.lit(FIRST_LOAD), F.col("OBSERVACAO"))
    nothing = F.lit(None).cast("string")
    return rows.union(read_log(lake).select(F.lit("log"), note, nothing, "QTD_INCLUIDO"))


# Layouts and gates


@operator(oracle_sql()["gold_avg_ticket_month"])
def bucketed_avg_ticket(spark, sf_dir):
    """Order totals joined to customers, both silver tables in buckets of the customer."""
    lake = new_lake(spark)
    # The buckets are counted before they are written; both passes read one written load.
    people, lines = _loads_of_stage(lake, sf_dir)
    tables = {"pedido": silver_orders(lines), "cadastro": silver_customers(people, AS_OF)}
    for table, rows in tables.items():
        lake.replace_hashed("silver", table, rows, "ID_CLIENTE", _BUCKETS)
    return gold.avg_ticket_month(lake.table("silver", "pedido"), lake.table("silver", "cadastro"))


@operator(silver_sql("""SELECT 'rows' AS what, (SELECT count(*) FROM customers WHERE UF IS NOT NULL) AS n, 'SUCESSO' AS STATUS,
    NULL AS note
  UNION ALL SELECT 'silver.cadastro', NULL, 'ERRO', 'silver.cadastro: no UF ' ||
    (SELECT count(*) FROM customers WHERE UF IS NULL) || ' of ' || (SELECT count(*) FROM customers)"""))
def gated_version(spark, sf_dir):
    """A table after a version that breaks a rule was refused, and the log of the refusal."""
    lake = _delivery_lake(spark)
    rows = silver_customers(raw_customers(stage_customers(spark, sf_dir), FIRST_LOAD, "x"), AS_OF)
    gate = Gate({"no UF": F.col("UF").isNull(), "no id": F.col("ID_CLIENTE").isNull()}, least_rows=1)
    lake.replace("silver", "cadastro", rows.filter("UF IS NOT NULL"), gate=gate)
    with contextlib.suppress(ExpectationsFailed):
        run_steps(
            lake,
            FIRST_LOAD,
            {"silver.cadastro": ("raw", lambda: lake.replace("silver", "cadastro", rows, gate=gate))},
        )
    left = lake.table("silver", "cadastro").agg(F.count("*").alias("n"))
    log = read_log(lake).select(F.col("TABELA").alias("what"), "QTD_INCLUIDO", "STATUS", "OBSERVACAO")
    nothing = F.lit(None).cast("string")
    return left.select(F.lit("rows").alias("what"), "n", F.lit("SUCESSO").alias("STATUS"), nothing.alias("note")).union(log)


@operator(raw_sql("""SELECT 'silver.pedido' AS TABELA, 'ERRO' AS STATUS, NULL AS QTD_INCLUIDO, TRUE AS cast_named
  UNION ALL SELECT 'silver.cadastro', 'SUCESSO', (SELECT count(*) FROM raw_customers), FALSE"""))
def failed_step_logged(spark, sf_dir):
    """The log of a run in which one of two steps met a price that is no number."""
    lake = _delivery_lake(spark)
    lines = raw_orders(stage_orders(spark, sf_dir), FIRST_LOAD, "x")
    broken = lines.withColumn("VALOR_UNITARIO", F.expr(_PLANTED["VALOR_UNITARIO"]))
    lake.append_load("raw", "raw_pedido", broken, FIRST_LOAD)
    people = raw_customers(stage_customers(spark, sf_dir), FIRST_LOAD, "x")
    lake.append_load("raw", "raw_cadastro", people, FIRST_LOAD)
    with contextlib.suppress(Exception):
        load_silver(lake, FIRST_LOAD, AS_OF)
    named = F.coalesce(F.col("OBSERVACAO"), F.lit("")).rlike("CAST_INVALID_INPUT|more than nine decimals")
    return read_log(lake).select("TABELA", "STATUS", "QTD_INCLUIDO", named.alias("cast_named"))


# Sorting


def _numbered(rows: DataFrame, column: str) -> DataFrame:
    """The values of a column with the place that their row has in the order of ``rows``."""
    placed = rows.select(column, F.monotonically_increasing_id().alias("at"))
    return placed.select(F.row_number().over(Window.orderBy("at")).alias("nth"), column)


def _report(spark, sf_dir, name: str) -> DataFrame:
    lake = new_lake(spark)
    lines = silver_orders(raw_orders(stage_orders(spark, sf_dir), FIRST_LOAD, "x"))
    people = silver_customers(raw_customers(stage_customers(spark, sf_dir), FIRST_LOAD, "x"), AS_OF)
    lake.replace("gold", name, gold.GOLD_TABLES[name].build(lines, people, RULES))
    return read_result(lake, name)


def _in_order(key: str, column: str, order: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {column} {order}) AS nth, {column} FROM ({oracle_sql()[key]})"


@operator(_in_order("gold_cancellation_rate", "PCT_CANCELAMENTO", "DESC"))
def report_descending(spark, sf_dir):
    """Cancellations per department from the highest share down; equal shares stand in any order."""
    return _numbered(_report(spark, sf_dir, "cancelamento_por_departamento"), "PCT_CANCELAMENTO")


@operator(_in_order("gold_weekday_volume", "NUM_DIA", "ASC"))
def report_ascending(spark, sf_dir):
    """Weekdays from Sunday to Saturday."""
    return _numbered(_report(spark, sf_dir, "pedidos_por_dia_semana"), "NUM_DIA")


@operator(stage_sql("""SELECT row_number() OVER (ORDER BY ID_RODADA DESC) AS nth, ID_RODADA
  FROM (SELECT unnest(range(1, 9)) AS ID_RODADA)"""))
def log_in_order(spark, sf_dir):
    """The log of four loads of two tables, newest rows first."""
    lake = _delivery_lake(spark)
    # Every load takes the rows of stage tables that are written once, as in the job.
    people, lines = _loads_of_stage(lake, sf_dir)
    rows = {"raw_cadastro": people, "raw_pedido": lines}
    for at in _DAYS[:4]:
        steps = {t: ("x", lambda t=t, r=r, at=at: lake.append_load("raw", t, r, at)) for t, r in rows.items()}
        run_steps(lake, at, steps)
    return _numbered(read_log(lake), "ID_RODADA")
