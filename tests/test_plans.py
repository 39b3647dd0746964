"""What the plans must look like to hold at scale."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from checks import deliveries
from checks.queries import queries
from ordstrata.plans import gold
from ordstrata.plans.gold import GOLD_TABLES, Rules
from ordstrata.plans.raw import raw_orders
from ordstrata.plans.silver import silver_orders
from ordstrata.schemas import STAGE_ORDERS
from tests_support import hot_customer

LAZY = [key for key in queries() if key.startswith(("gold_", "silver_", "raw_"))]


def physical(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory, sf_dir):
    """Silver tables as files, as the job leaves them for the result tables."""
    from checks.queries import customers, order_lines

    folder = tmp_path_factory.mktemp("silver")
    found = []
    for name, rows in (("o", order_lines(spark, sf_dir)), ("c", customers(spark, sf_dir))):
        rows.write.parquet(f"{folder}/{name}")
        found.append(spark.read.parquet(f"{folder}/{name}"))
    return found


@pytest.mark.parametrize("key", LAZY)
def test_no_cross_join_and_no_python(spark, sf_dir, key):
    plan = physical(queries()[key](spark, sf_dir))
    assert not re.search("CartesianProduct|NestedLoop|Python|ArrowEval|ExternalRDD", plan)


@pytest.mark.parametrize("name", GOLD_TABLES)
def test_results_scan_the_order_lines_once(spark, silver, name):
    orders, customers = silver
    plan = physical(GOLD_TABLES[name].build(orders, customers, Rules()))
    assert len(re.findall(r"FileScan parquet .*?/o\]", plan)) == (name != "crescimento_base_clientes")


def test_filters_and_columns_reach_the_scan(spark, silver):
    plan = physical(gold.avg_ticket_month(*silver))
    scan = next(l for l in plan.splitlines() if "FileScan" in l and "/o]" in l)
    assert "EqualTo(STATUS_PAGAMENTO,CONFIRMADO)" in scan
    read = re.search(r"ReadSchema: struct<(.*?)>", scan).group(1)
    assert {c.split(":")[0] for c in read.split(",") if ":" in c} == {
        "ID_CLIENTE",
        "ID_PEDIDO",
        "STATUS_PAGAMENTO",
        "VALOR_TOTAL",
        "ANO",
        "MES",
    }


def test_grouping_starts_before_the_shuffle(spark, silver):
    """The first exchange above the order lines carries partial aggregates spread by order."""
    plan = physical(gold.avg_ticket_month(*silver))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^()]*)\)", plan.split("FileScan")[0])
    assert exchanges[-1].split(", ")[:-1] == [
        re.search(rf"\b{c}#\d+L?", exchanges[-1]).group()
        for c in ("ID_CLIENTE", "ANO", "MES", "ID_PEDIDO")
    ]


def test_one_frequent_customer_is_split_in_the_join(spark, tmp_path):
    """A customer with most of the orders: adaptive execution splits its partition, and the result
    stays whole."""
    orders, customers, n_orders = hot_customer(spark, tmp_path)
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize": "16k",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        rows = gold.optin_impact(orders, customers)
        found = {r.PERMISSAO_EMAIL: r for r in rows.collect()}
        plan = physical(rows)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "skew=true" in plan
    assert found[gold.OPTED_IN].QTD_PEDIDOS == n_orders
    assert found[gold.OPTED_IN].QTD_CLIENTES == customers.count() - 1


def test_orders_from_stage_to_silver_stay_compilable(spark, tmp_path):
    """HotSpot leaves methods above 8,000 bytes of code to its interpreter."""
    stage = ", ".join(f"{field.name} string" for field in STAGE_ORDERS)
    spark.createDataFrame([], stage).write.parquet(f"{tmp_path}/stage")
    at = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    lines = silver_orders(raw_orders(spark.read.parquet(f"{tmp_path}/stage"), at, "x"))
    shown = spark._jvm.PythonSQLUtils.explainString(lines._jdf.queryExecution(), "codegen")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", shown)]
    assert sizes and max(sizes) <= 8000


@pytest.mark.parametrize("key", ["log_in_order", "bucketed_avg_ticket"])
def test_order_lines_are_joined_once(spark, sf_dir, monkeypatch, key):
    lines = deliveries.stage_orders(spark, sf_dir).count()
    seen = spark.sparkContext.accumulator(0)

    def joined(session, folder, build=deliveries.stage_orders):
        def passed(batches):
            for batch in batches:
                seen.add(len(batch))
                yield batch

        rows = build(session, folder)
        return rows.mapInPandas(passed, rows.schema)

    monkeypatch.setattr(deliveries, "stage_orders", joined)
    queries()[key](spark, sf_dir).collect()
    assert seen.value == lines
