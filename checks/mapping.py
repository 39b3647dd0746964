"""The two source files, derived from the test tables with planted defects.

Each expression is SQL that Spark and DuckDB evaluate alike, so that queries and oracles share it.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordstrata.plans.gold import Rules

RULES = Rules(
    years=(1996, 1997),
    categories=("PROMO", "SMALL"),
    tier_limits=(30000, 75000, 150000),
    year_boundaries=(1996, 1997, 1998, 1999, 2000, 2001),
)
CUSTOMER_FILE, ORDER_FILE = "customers", "orders"
AS_OF = dt.date(2024, 1, 1)
FIRST_LOAD = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SECOND_LOAD = dt.datetime(2024, 1, 2, 3, 4, 5, tzinfo=dt.timezone.utc)

_TWO_DIGITS = "lpad(CAST({} AS STRING), 2, '0')"


def _dmy(day: str, month: str, year: str) -> str:
    return (
        f"{_TWO_DIGITS.format(day)} || '/' || {_TWO_DIGITS.format(month)}"
        f" || '/' || CAST({year} AS STRING)"
    )


_K = "c_custkey"
CUSTOMER_FIELDS = {
    "ID": f"CASE WHEN {_K} % 97 = 96 THEN '' WHEN {_K} % 101 = 100 THEN NULL"
    f" ELSE ' ' || CAST({_K} AS STRING) || ' ' END",
    "EMAIL": f"'  USER' || CAST({_K} AS STRING) || '@Example.COM '",
    "NOME": "' customer ' || lower(c_mktsegment) || ' '",
    "DT_NASC": f"CASE WHEN {_K} % 37 = 0 THEN '29/02/1991' ELSE "
    + _dmy(f"1 + {_K} % 28", f"1 + {_K} % 12", f"1950 + {_K} % 50")
    + " END",
    "SEXO": f"CASE WHEN {_K} % 5 < 2 THEN NULL WHEN {_K} % 5 < 4 THEN ' F' ELSE 'M ' END",
    "CADASTRO": f"CASE WHEN {_K} % 41 = 0 THEN '31/04/1996' ELSE "
    + _dmy(f"1 + {_K} % 28", f"1 + {_K} % 12", f"1995 + {_K} % 5")
    + " END",
    "CIDADE": f"CASE {_K} % 10 WHEN 0 THEN '' WHEN 1 THEN '.' WHEN 2 THEN '12345'"
    " ELSE ' ' || lower(n_name) || ' ' END",
    "ESTADO": f"CASE {_K} % 8 WHEN 0 THEN 'MIN' WHEN 1 THEN 'SAO' WHEN 2 THEN ' SP '"
    " WHEN 3 THEN 'RJ' WHEN 4 THEN 'MG' WHEN 5 THEN 'sp' WHEN 6 THEN NULL ELSE 'RS' END",
    "RECEBE_EMAIL": f"CASE WHEN {_K} % 50 = 49 THEN NULL WHEN {_K} % 3 = 0 THEN '0' ELSE '1' END",
}

_K = "l_orderkey"
ORDER_FIELDS = {
    "COD_CLIENTE": f"CASE WHEN {_K} % 499 = 498 THEN '' ELSE CAST(o_custkey AS STRING) END",
    "COD_PEDIDO": "CAST(o_orderkey AS STRING)",
    "CODIGO_PRODUTO": "CAST(l_partkey AS STRING)",
    "DEPTO": "' ' || lower(p_type) || ' '",
    "QUANTIDADE": "CAST(CAST(l_quantity AS INT) AS STRING)",
    "VALOR_UNITARIO": f"CASE WHEN {_K} % 211 = 0 THEN '-1.50' WHEN {_K} % 17 = 0 THEN '0'"
    " ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) AS STRING) END",
    "QTD_PARCELAS": f"CASE WHEN {_K} % 19 = 0 THEN NULL WHEN {_K} % 23 = 0 THEN ' '"
    f" WHEN {_K} % 29 = 0 THEN '0' ELSE CAST(1 + {_K} % 12 AS STRING) END",
    "DT_PEDIDO": _dmy("day(o_orderdate)", "month(o_orderdate)", "year(o_orderdate)"),
    "MEIO_PAGTO": "CASE o_orderpriority WHEN '1-URGENT' THEN 'boleto'"
    " WHEN '2-HIGH' THEN 'Pix ' ELSE 'cartao' END",
    "STATUS_PAGAMENTO": "CASE o_orderstatus WHEN 'F' THEN 'Confirmado'"
    " WHEN 'P' THEN ' cancelado' ELSE 'PENDENTE' END",
}


def select_list(fields: dict[str, str]) -> list[str]:
    return [f"{sql} AS {name}" for name, sql in fields.items()]


# Columns of the test tables that the mapping reads; a given schema saves the job that infers one.
TABLES = {
    "nation": "n_nationkey int, n_name string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "part": "p_partkey bigint, p_type string, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string,"
    " o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_quantity double",
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def stage_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer, nation = (read_table(spark, sf_dir, t) for t in ("customer", "nation"))
    joined = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    return joined.selectExpr(*select_list(CUSTOMER_FIELDS))


def stage_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem, orders, part = (read_table(spark, sf_dir, t) for t in ("lineitem", "orders", "part"))
    # Lines and orders grow together and neither side is bounded, so the join shuffles both.
    joined = lineitem.join(
        orders.hint("merge"), lineitem.l_orderkey == orders.o_orderkey
    ).join(part, lineitem.l_partkey == part.p_partkey)
    return joined.selectExpr(*select_list(ORDER_FIELDS))


def with_unnamed(stage: DataFrame) -> DataFrame:
    """The customer file with its trailing unnamed fields, all empty."""
    return stage.withColumns({f"string_field_{n}": F.lit(None).cast("string") for n in range(9, 13)})
