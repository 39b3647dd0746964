"""Registered queries on defects, snapshots and dimensions, each with its SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from checks.mapping import stage_customers, stage_orders
from checks.operators import _ORDERS, _STATE_LIST, _orders, operator
from checks.oracles import stage_sql
from ordstrata.functions import numbers, text
from ordstrata.operators.quality import category_dimension, upsert
from ordstrata.plans.quality import customer_quality, order_quality

LAST_OLD_YEAR = 1996


def _report(table: str, rules: dict[str, str], key: str) -> str:
    counted = [
        f"SELECT '{rule}' AS rule, count(*) FILTER ({bad}) AS n_bad, count(*) AS n_rows FROM {table}"
        for rule, bad in rules.items()
    ]
    repeated = (
        f"SELECT 'duplicate_key' AS rule, coalesce(CAST(sum(n - 1) AS BIGINT), 0) AS n_bad,"
        f" coalesce(CAST(sum(n) AS BIGINT), 0) AS n_rows"
        f" FROM (SELECT count(*) AS n FROM {table} GROUP BY {key})"
    )
    return stage_sql(" UNION ALL ".join([*counted, repeated]))


def _impossible(name: str) -> str:
    return f"trim({name}) <> '' AND try_strptime(trim({name}), '%d/%m/%Y') IS NULL"


@operator(_report("stg_customers", {
    "blank_id": "ID IS NULL OR trim(ID) = ''",
    "impossible_birth_date": _impossible("DT_NASC"),
    "impossible_signup_date": _impossible("CADASTRO"),
    "no_city": "CIDADE IS NULL OR trim(CIDADE) IN ('', '.') OR regexp_full_match(trim(CIDADE), '[0-9]+')",
    "unknown_state": f"ESTADO IS NULL OR trim(ESTADO) NOT IN ({_STATE_LIST})",
    "no_sex": "SEXO IS NULL OR trim(SEXO) = ''",
}, "trim(ID)"))
def quality_customers(spark, sf_dir):
    return customer_quality(stage_customers(spark, sf_dir))


@operator(_report("stg_orders", {
    "blank_customer": "COD_CLIENTE IS NULL OR trim(COD_CLIENTE) = ''",
    "pending": "upper(trim(STATUS_PAGAMENTO)) = 'PENDENTE'",
    "negative_price": "CAST(VALOR_UNITARIO AS DECIMAL(14,2)) < 0",
    "confirmed_at_zero": "upper(trim(STATUS_PAGAMENTO)) = 'CONFIRMADO'"
    " AND CAST(VALOR_UNITARIO AS DECIMAL(14,2)) = 0",
    "zero_instalments": "trim(QTD_PARCELAS) = '0'",
    "no_instalments": "QTD_PARCELAS IS NULL OR trim(QTD_PARCELAS) = ''",
}, "COD_PEDIDO, CODIGO_PRODUTO"))
def quality_orders(spark, sf_dir):
    return order_quality(stage_orders(spark, sf_dir))


@operator(_ORDERS + f"""SELECT o_custkey, n_new AS n, last_new::VARCHAR AS last_day,
    CASE WHEN n_old IS NULL THEN 'inserted' WHEN n_old = n_new AND last_old = last_new THEN 'kept'
      ELSE 'updated' END AS change
  FROM (SELECT o_custkey, count(*) AS n_new, max(day) AS last_new FROM o GROUP BY o_custkey)
  LEFT JOIN (SELECT o_custkey, count(*) AS n_old, max(day) AS last_old FROM o
    WHERE year <= {LAST_OLD_YEAR} GROUP BY o_custkey) USING (o_custkey)""")
def upsert_snapshot(spark, sf_dir):
    """The customers' order counts as of a year, brought up to date."""

    def snapshot(orders):
        return orders.groupBy("o_custkey").agg(
            F.count("*").alias("n"), F.max("day").alias("last_day")
        )

    orders = _orders(spark, sf_dir)
    old = snapshot(orders.filter(F.col("year") <= LAST_OLD_YEAR))
    merged = upsert(old, snapshot(orders), ["o_custkey"]).drop("changed")
    return merged.withColumn("last_day", F.col("last_day").cast("string"))


@operator(stage_sql("""SELECT DEPARTAMENTO, sha256(DEPARTAMENTO)[:32] AS ID_DEPARTAMENTO
  FROM (SELECT DISTINCT upper(trim(DEPTO)) AS DEPARTAMENTO FROM stg_orders)
  WHERE DEPARTAMENTO IS NOT NULL"""))
def department_dimension(spark, sf_dir):
    lines = stage_orders(spark, sf_dir).select(text.clean_upper(F.col("DEPTO")).alias("DEPARTAMENTO"))
    return category_dimension(lines, "DEPARTAMENTO", "ID_DEPARTAMENTO")


_DIGITS = "CAST(p_partkey AS STRING) || '.' || repeat('0', CAST(p_partkey % 9 AS INT)) || '7'"


@operator(f"""SELECT p_partkey, CAST(1000000000 * CAST({_DIGITS} AS DECIMAL(20,9)) AS BIGINT)
  AS billionths FROM part""")
def price_digits(spark, sf_dir):
    """Prices with one to nine decimals, none of them cut."""
    priced = spark.read.parquet(f"{sf_dir}/part.parquet").select(
        "p_partkey", numbers.money(F.expr(_DIGITS)).cast("decimal(20,9)").alias("price")
    )
    return priced.select("p_partkey", (F.col("price") * 1_000_000_000).cast("bigint").alias("billionths"))
