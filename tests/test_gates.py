"""Gates, merges, bucketed layouts and lenient casts."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.mapping import AS_OF, FIRST_LOAD, RULES, stage_customers, stage_orders
from checks.queries import write_files
from ordstrata import job
from ordstrata.functions.numbers import MONEY, money, try_money, try_whole
from ordstrata.operators.expectations import ExpectationsFailed, Gate
from ordstrata.plans import gold, medallion, run_log
from ordstrata.plans.gates import gold_gates, silver_gates
from ordstrata.plans.gold import GOLD_TABLES
from ordstrata.plans.raw import raw_customers, raw_orders
from ordstrata.plans.silver import (
    checked_customers,
    checked_orders,
    silver_customers,
    silver_orders,
)
from ordstrata.sinks.merged import HASH_BUCKET, Merged, MergedTable

SCHEMA = T.StructType(
    [
        T.StructField("k", T.LongType()),
        T.StructField("v", T.StringType()),
        T.StructField("at", T.IntegerType()),
    ]
)


def rows_of(rows):
    return sorted(map(tuple, rows.collect()), key=str)


# Gates


def test_a_version_that_breaks_a_rule_does_not_show(spark, lake):
    gate = Gate({"even": F.col("id") % 2 == 0}, {"even": 0.5}, least_rows=3, unique=("id",))
    assert lake.replace("gold", "t", spark.range(10), gate=gate) == 10
    for rows, message in (
        (spark.range(0, 10, 2), "even 5 of 5"),
        (spark.range(1, 4, 2), "rows 2 < 3"),
        (spark.range(10).union(spark.range(1)), "even 6 of 11; unique id 1 of 11"),
    ):
        with pytest.raises(ExpectationsFailed, match=f"gold.t: {message}"):
            lake.replace("gold", "t", rows, gate=gate)
        assert lake.table("gold", "t").count() == 10


def test_gates_hold_in_split_and_year_tables(spark, lake):
    rows = spark.range(10).withColumn("ANO", F.col("id") % 3 + 2019)
    gate = Gate({"nine": F.col("id") == 9})
    with pytest.raises(ExpectationsFailed, match="nine 1 of 10"):
        lake.replace("gold", "t", rows, bucket_by=("ANO", (2019, 2020)), gate=gate)
    # Rejected rows are not the table's.
    found = lake.replace_split("gold", "s", rows, F.col("id") == 9, ["id"], ["id", "ANO"], gate=gate)
    assert found == (9, 1) and rows_of(lake.table("gold", "s_rejeitado")) == [(9, 2019)]
    with pytest.raises(ExpectationsFailed):
        lake.replace_split("gold", "s", rows, F.col("id") == 1, ["id"], ["id"], gate=gate)
    assert lake.table("gold", "s").count() == 9


def test_every_result_has_a_gate_and_the_job_passes_them(lake, sf_dir, capsys):
    assert set(gold_gates()) == set(GOLD_TABLES) and set(silver_gates()) == {"cadastro", "pedido"}
    customers, orders = write_files(lake.spark, sf_dir, lake.root)
    flags = ["--gated", "--once", "--by-name", "--as-of", "2024-01-01"]
    places = ["--root", lake.root, "--customers", customers, "--orders", orders]
    job.main([*places, "--namespace", lake.namespace, "--load-ts", "2024-01-01T00:00:00+00:00", *flags])
    shown = capsys.readouterr().out
    assert "gold.tiers_clientes" in shown and "ERRO" not in shown and "stg_pedido_rejeitado | 0" in shown
    assert lake.table("gold", "tiers_clientes").count() == 442


def test_a_refused_silver_table_is_logged(spark, lake):
    medallion.create_history(lake)
    empty = spark.createDataFrame([], lake.table("raw", "raw_pedido").schema)
    lake.append_load("raw", "raw_pedido", empty, FIRST_LOAD)
    with pytest.raises(ExpectationsFailed, match="rows 0 < 1"):
        medallion.load_silver(lake, FIRST_LOAD, AS_OF, gated=True)
    assert {r.STATUS for r in run_log.read_log(lake).collect()} == {"ERRO"}


# Merges


def merged(lake, n_buckets=4):
    return MergedTable(lake, "silver", "m", SCHEMA, ["k"], n_buckets)


def frame(spark, *rows):
    return spark.createDataFrame(rows, SCHEMA)


def files(lake):
    found = {}
    for folder, _, names in os.walk(f"{lake.root}/silver/m"):
        for name in names:
            if name.endswith(".parquet") and HASH_BUCKET in folder:
                found.setdefault(folder.rsplit("=")[-1], set()).add(name)
    return found


def test_merges_touch_only_their_partitions(spark, lake):
    table = merged(lake, 16)
    assert table.merge(frame(spark)) == Merged(0, 0, 0)
    first = [(k, "a", 1) for k in range(100)]
    assert table.merge(frame(spark, *first)) == Merged(100, 0, 0)
    before = files(lake)
    assert table.merge(frame(spark, (1, "b", 2), (2, "a", 2), (200, None, 2)), ["at"]) == Merged(1, 1, 1)
    rows = {k: (v, at) for k, v, at in rows_of(table.rows())}
    assert len(rows) == 101 and rows[1] == ("b", 2) and rows[2] == ("a", 1) and rows[200] == (None, 2)
    after = files(lake)
    kept = [b for b in before if before[b] == after[b]]
    assert 13 <= len(kept) < 16
    # The same changes again change nothing.
    assert merged(lake, 16).merge(frame(spark, (1, "b", 3), (200, None, 3)), ["at"]) == Merged(0, 0, 2)
    assert table.merge(frame(spark, (200, "x", 2))) == Merged(0, 1, 0)
    assert table.rows().count() == 101


def test_keys_of_changes_must_be_known_and_single(spark, lake):
    table = merged(lake)
    table.merge(frame(spark, (1, "a", 1)))
    for rows in ([(None, "a", 1)], [(2, "a", 1), (2, "b", 1)]):
        with pytest.raises(ValueError, match="NULL or occurs twice"):
            table.merge(frame(spark, *rows))
    assert rows_of(table.rows()) == [(1, "a", 1)]


def test_a_merge_cut_short_is_finished_or_forgotten(spark, lake, monkeypatch):
    table = merged(lake)
    table.merge(frame(spark, *[(k, "a", 1) for k in range(20)]))

    def dies(whole):
        # As a run that was lost after it had deleted what it was about to replace.
        for bucket in range(4):
            for folder, _, names in os.walk(f"{lake.root}/silver/m/{HASH_BUCKET}={bucket}"):
                for name in names:
                    os.unlink(f"{folder}/{name}")
        raise InterruptedError

    monkeypatch.setattr(table, "_apply", dies)
    changes = frame(spark, *[(k, "b", 2) for k in range(10, 30)])
    with pytest.raises(InterruptedError):
        table.merge(changes)
    monkeypatch.undo()
    assert table.recover() and not table.recover()
    want = [(k, "a" if k < 10 else "b", 1 if k < 10 else 2) for k in range(30)]
    assert rows_of(table.rows()) == sorted(want, key=str)
    # One that was lost before its rows were whole leaves the table as it is.
    os.makedirs(f"{table.pending}/whole")
    assert not table.recover() and not os.path.exists(table.pending)
    assert table.rows().count() == 30


# Layouts


@pytest.fixture
def silver(spark, lake, sf_dir):
    orders = silver_orders(raw_orders(stage_orders(spark, sf_dir), FIRST_LOAD, "x"))
    customers = silver_customers(raw_customers(stage_customers(spark, sf_dir), FIRST_LOAD, "x"), AS_OF)
    return {"pedido": orders, "cadastro": customers}


def test_customers_join_without_a_shuffle(spark, lake, silver):
    for table, rows in silver.items():
        assert lake.replace_hashed("silver", table, rows, "ID_CLIENTE", 8)[1]
    tables = [lake.table("silver", t) for t in ("pedido", "cadastro")]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = gold.avg_ticket_month(*tables)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
        assert "Exchange" not in plan
        other = gold.avg_ticket_month(silver["pedido"], silver["cadastro"])
        assert rows_of(joined) == rows_of(other)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_a_frequent_customer_gets_no_buckets(spark, lake):
    rows = spark.range(1000).select(F.when(F.col("id") < 700, 1).otherwise(F.col("id")).alias("k"))
    assert lake.replace_hashed("silver", "t", rows, "k", 8) == (1000, False)
    assert lake.table("silver", "t").count() == 1000
    assert lake.replace_hashed("silver", "t", spark.range(1000), "id", 8) == (1000, True)
    assert lake.replace_hashed("silver", "t", spark.range(0), "id", 8) == (0, True)
    assert lake.table("silver", "t").count() == 0
    assert lake.remove_old_versions("silver", "t") == 2
    assert [t.name for t in spark.catalog.listTables(f"{lake.namespace}_silver")].count("t") == 1


def test_the_job_in_buckets(lake, sf_dir):
    paths = write_files(lake.spark, sf_dir, lake.root)
    medallion.run_medallion(lake, *paths, FIRST_LOAD, AS_OF, RULES, customer_buckets=4, gated=True)
    assert lake.table("gold", "tiers_clientes").count() == 442


# Lenient casts

PRICES = {
    "1": 1, "0.000000001": 1e-9, "12345678.5": 12345678.5, "125e-2": 1.25, "1E3": 1000, "+2.50": 2.5,
    " 7 ": 7, "123456789012.123456789": 123456789012.123456789, "1.5000000000000000": 1.5,
}
NO_PRICES = ["", "x", "1,5", "1e-20", "1e-10", "0.0000000001", "1.0000000001", "1e30", "12345678901234567890.5", "--1"]


def test_prices_strict_and_lenient(spark):
    texts = spark.createDataFrame([(t,) for t in [*PRICES, *NO_PRICES]], "t string")
    found = {r.t: r.p for r in texts.select("t", try_money(F.col("t")).alias("p")).collect()}
    assert all(abs(float(found[t]) - p) <= abs(p) * 1e-15 for t, p in PRICES.items())
    assert not any(found[t] is not None for t in NO_PRICES)
    strict = texts.filter(F.col("t").isin(*PRICES)).select("t", money(F.col("t")).alias("p"))
    assert {r.t: r.p for r in strict.collect()} == {t: found[t] for t in PRICES}
    assert strict.schema["p"].dataType.simpleString() == MONEY
    for text in NO_PRICES:
        with pytest.raises(Exception, match="CAST_INVALID|NUMERIC_VALUE_OUT|more than nine|OVERFLOW"):
            spark.createDataFrame([(text,)], "t string").select(money(F.col("t"))).collect()


def test_whole_numbers_lenient(spark):
    texts = spark.createDataFrame([("1",), (" 2 ",), ("1.5",), ("x",), ("",), (None,), ("9" * 30,)], "t string")
    assert [r[0] for r in texts.select(try_whole(F.col("t"))).collect()][:2] == [1, 2]
    assert texts.filter(try_whole(F.col("t")).isNull()).count() >= 4


def test_checked_rows_are_the_strict_ones_where_nothing_fails(spark, sf_dir):
    lines = raw_orders(stage_orders(spark, sf_dir), FIRST_LOAD, "x")
    people = raw_customers(stage_customers(spark, sf_dir), FIRST_LOAD, "x")
    for strict, checked in (
        (silver_orders(lines), checked_orders(lines)),
        (silver_customers(people, AS_OF), checked_customers(people, AS_OF)),
    ):
        assert checked.filter("size(MOTIVOS) > 0 OR BRUTO IS NOT NULL").isEmpty()
        plain = checked.drop("MOTIVOS", "BRUTO")
        assert plain.schema == strict.schema or plain.dtypes == strict.dtypes
        assert plain.exceptAll(strict).isEmpty() and strict.exceptAll(plain).isEmpty()


def test_reasons(spark, sf_dir):
    line = raw_orders(stage_orders(spark, sf_dir), FIRST_LOAD, "x").filter(
        "CAST(VALOR_UNITARIO AS DOUBLE) > 0 AND trim(STATUS_PAGAMENTO) <> 'PENDENTE'"
    ).limit(1)
    given = line.first()
    cases = {
        "good": {},
        "several": {"COD_CLIENTE": "c", "QUANTIDADE": "", "DT_PEDIDO": "1/13/2020", "QTD_PARCELAS": "x"},
        "price": {"VALOR_UNITARIO": "grátis"},
        "null": {"QUANTIDADE": None, "QTD_PARCELAS": "  ", "COD_PEDIDO": None},
        "large": {"QUANTIDADE": "9" * 18, "VALOR_UNITARIO": "9" * 18},
        "pending": {"STATUS_PAGAMENTO": "PENDENTE", "VALOR_UNITARIO": "x"},
        "free": {"VALOR_UNITARIO": "0"},
    }
    rows = [tuple({**given.asDict(), "UUID_LINHA": name, **case}.values()) for name, case in cases.items()]
    found = checked_orders(spark.createDataFrame(rows, line.schema)).collect()
    assert {tuple(r.MOTIVOS): r.BRUTO and r.BRUTO.UUID_LINHA for r in found if r.MOTIVOS} == {
        ("COD_CLIENTE", "QUANTIDADE", "QTD_PARCELAS", "DT_PEDIDO"): "several",
        ("VALOR_UNITARIO",): "price",
        ("VALOR_TOTAL",): "large",
    }
    assert len(found) == 5 and sum(r.BRUTO is None for r in found) == 2
