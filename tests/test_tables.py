"""Readers, writers and the job."""

import datetime as dt

import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.mapping import AS_OF, FIRST_LOAD, RULES, SECOND_LOAD
from checks.queries import write_files
from ordstrata.operators.history import same_rows
from ordstrata.plans import medallion, run_log
from ordstrata.plans.gold import Rules
from ordstrata.schemas import RAW_CUSTOMERS, RUN_LOG, STAGE_CUSTOMERS, STAGE_ORDERS
from ordstrata.sinks.tables import BUCKET_COLUMN, LOAD_COLUMN
from ordstrata.sources.delimited import header_drift, read_delimited, write_delimited

FIRST = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SECOND = dt.datetime(2024, 1, 2, 3, 4, 5, 678, tzinfo=dt.timezone.utc)
TEXT = "a string, b string, c string"


def values(rows):
    return sorted(map(tuple, rows.collect()), key=str)


def test_delimited_round_trip(spark, tmp_path):
    given = [("1", None, " x "), ("2", "", "y;z"), ('3"', "\tq", "ação"), (None, None, None)]
    schema = spark.createDataFrame(given, TEXT).schema
    write_delimited(spark.createDataFrame(given, TEXT), str(tmp_path / "f"))
    assert values(read_delimited(spark, str(tmp_path / "f"), schema)) == sorted(given, key=str)


def test_each_file_has_a_header_and_columns_go_by_position(spark, tmp_path):
    for name, header in (("1.csv", "a;b;c"), ("2.csv", "X;Y;Z")):
        (tmp_path / name).write_text(f"{header}\n{name};;\"\"\n")
    schema = spark.createDataFrame([], TEXT).schema
    found = values(read_delimited(spark, str(tmp_path), schema))
    assert found == [("1.csv", None, ""), ("2.csv", None, "")]


@pytest.mark.parametrize("row", ["1;2", "1;2;3;4"])
def test_ragged_rows_fail_the_job(spark, tmp_path, row):
    (tmp_path / "x.csv").write_text(f"a;b;c\n{row}\n")
    with pytest.raises(Exception, match="MALFORMED_CSV_RECORD"):
        read_delimited(spark, str(tmp_path), spark.createDataFrame([], TEXT).schema).collect()


def test_replace_keeps_the_old_version_until_the_new_one_is_whole(spark, lake):
    assert lake.replace("silver", "t", spark.range(5)) == 5
    failing = spark.range(5).withColumn("id", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(PySparkException):
        lake.replace("silver", "t", failing)
    assert lake.table("silver", "t").count() == 5
    assert lake.replace("silver", "t", lake.table("silver", "t").filter("id < 2")) == 2
    assert values(lake.table("silver", "t")) == [(0,), (1,)]


def test_old_versions_are_removed_on_request(spark, lake):
    assert lake.remove_old_versions("gold", "t") == 0
    for n in range(1, 4):
        lake.replace("gold", "t", spark.range(n))
    assert lake.remove_old_versions("gold", "t") == 2
    assert lake.remove_old_versions("gold", "t") == 0
    assert lake.table("gold", "t").count() == 3


def test_results_are_read_in_report_order(spark, lake):
    rates = spark.createDataFrame([("a", 1.0), ("b", 3.0), ("c", 2.0)], "D string, PCT_CANCELAMENTO double")
    lake.replace("gold", "cancelamento_por_departamento", rates)
    found = medallion.read_result(lake, "cancelamento_por_departamento").collect()
    assert [r.D for r in found] == ["b", "c", "a"]
    lake.replace("gold", "pedidos_por_dia_semana", spark.range(5, 0, -1).toDF("NUM_DIA"))
    found = medallion.read_result(lake, "pedidos_por_dia_semana").collect()
    assert [r.NUM_DIA for r in found] == [1, 2, 3, 4, 5]


def test_descriptions(spark, lake):
    lake.replace("stage", "t", spark.createDataFrame([], STAGE_CUSTOMERS), "it's text")
    lake.create("raw", "h", RAW_CUSTOMERS, "history", LOAD_COLUMN)
    for layer, table, note in (("stage", "t", "it's text"), ("raw", "h", "history")):
        described = spark.sql(f"DESCRIBE EXTENDED {lake.name(layer, table)}").collect()
        notes = {r.col_name: (r.comment, r.data_type) for r in reversed(described)}
        assert notes["EMAIL"][0] == "e-mail address"
        assert notes["Comment"][1] == note


def test_create_empty_and_create_if_missing(spark, lake):
    lake.create_empty("stage", "t", RUN_LOG)
    assert lake.table("stage", "t").columns == RUN_LOG.names and lake.table("stage", "t").count() == 0
    lake.create("raw", "log", RUN_LOG)
    lake.append("raw", "log", spark.createDataFrame([(1, FIRST, "t", 2, "o", "s", None)], RUN_LOG))
    lake.create("raw", "log", RUN_LOG)
    assert lake.table("raw", "log").count() == 1


def test_bucketed_and_clustered_table(spark, lake):
    years = spark.range(2000).select(
        (2017 + F.col("id") % 11).alias("ANO"), (F.col("id") * 7 % 500).alias("K"), "id"
    )
    years = years.union(spark.sql("SELECT CAST(NULL AS BIGINT), 1L, -1L"))
    layout = ("ANO", Rules.year_boundaries)
    assert lake.replace("gold", "t", years, "", ["K"], layout) == 2001
    assert values(lake.table("gold", "t")) == values(years)
    assert lake.table("gold", "t").columns == ["ANO", "K", "id"]
    stored = spark.read.parquet(lake.place("gold", "t"))
    buckets = {tuple(r) for r in stored.select("ANO", BUCKET_COLUMN).distinct().collect()}
    in_range = {(y, y - 2018) for y in range(2019, 2025)}
    assert buckets == in_range | {(2017, 0), (2018, 0), (2025, 7), (2026, 7), (2027, 7), (None, None)}
    picked = lake.bucketed("gold", "t", layout, [2019, 2026])
    assert values(picked) == values(years.filter("ANO IN (2019, 2026)"))
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert f"PartitionFilters: [{BUCKET_COLUMN}" in plan
    ordered = stored.select(F.input_file_name().alias("f"), "ANO", "K").collect()
    by_file = {}
    for row in ordered:
        by_file.setdefault(row.f, []).append((row.ANO, row.K))
    assert all([k for _, k in rows] == sorted(k for _, k in rows) for rows in by_file.values())


def test_load_is_replaced_when_repeated_and_kept_otherwise(spark, lake):
    medallion.create_history(lake)
    row = ("1", "e", "n", "d", "s", "c", "c", "e", "1", FIRST, "o", "u")

    def load(at, n):
        rows = spark.createDataFrame([row] * n, RAW_CUSTOMERS)
        return lake.append_load("raw", "raw_cadastro", rows, at)

    assert lake.latest("raw", "raw_cadastro").count() == 0
    assert [load(SECOND, 3), load(FIRST, 5), load(SECOND, 2)] == [3, 5, 2]
    history = lake.table("raw", "raw_cadastro")
    assert history.count() == 7 and history.columns == RAW_CUSTOMERS.names[:9] + ["ORIGEM", "UUID_LINHA", LOAD_COLUMN]
    newest = lake.latest("raw", "raw_cadastro")
    assert newest.count() == 2
    assert newest.first()[LOAD_COLUMN] == dt.datetime(2024, 1, 2, 3, 4, 5, 678)
    plan = newest._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryFileIndex(1 paths)" in plan and "PartitionFilters" in plan


def test_history_is_found_again_by_a_new_catalog(spark, lake):
    from ordstrata.sinks.tables import Lake

    medallion.create_history(lake)
    row = ("1", "e", "n", "d", "s", "c", "c", "e", "1", FIRST, "o", "u")
    lake.append_load("raw", "raw_cadastro", spark.createDataFrame([row], RAW_CUSTOMERS), FIRST)
    again = Lake(spark, lake.root, lake.namespace + "_again")
    medallion.create_history(again)
    assert again.latest("raw", "raw_cadastro").count() == 1


def test_log_numbers_run_on(spark, lake):
    run_log.create_log(lake)
    run_log.append_log(lake, [run_log.LogEntry("a", 1, "x"), run_log.LogEntry("b", 2, "x")], FIRST)
    failed = run_log.LogEntry("c", None, "x", run_log.FAILURE, "it broke")
    run_log.append_log(lake, [failed], SECOND)
    rows = run_log.read_log(lake)
    assert rows.columns == RUN_LOG.names
    assert [(r.ID_RODADA, r.TABELA, r.QTD_INCLUIDO, r.STATUS, r.OBSERVACAO) for r in rows.collect()] == [
        (3, "c", None, "ERRO", "it broke"),
        (2, "b", 2, "SUCESSO", None),
        (1, "a", 1, "SUCESSO", None),
    ]


def test_whole_job_twice(spark, lake, sf_dir):
    paths = write_files(spark, sf_dir, lake.root)
    for at in (FIRST, SECOND):
        log = medallion.run_medallion(lake, *paths, load_ts=at, as_of=AS_OF, rules=RULES)
    for layer, table in (("silver", "pedido"), ("gold", "tiers_clientes"), ("stage", "stg_pedido")):
        assert lake.remove_old_versions(layer, table) == 1
    rows = log.collect()
    assert [r.ID_RODADA for r in rows] == list(range(28, 0, -1))
    assert {r.STATUS for r in rows} == {"SUCESSO"}
    counts = {r.TABELA: r.QTD_INCLUIDO for r in rows[:14]}
    assert len(counts) == 14 and counts == {r.TABELA: r.QTD_INCLUIDO for r in rows[14:]}
    raw = lake.table("raw", "raw_pedido")
    assert raw.count() == 2 * counts["raw_pedido"] and raw.select(LOAD_COLUMN).distinct().count() == 2
    silver = lake.table("silver", "pedido")
    assert silver.count() == counts["silver.pedido"]
    assert {r[0] for r in silver.select("DT_CARGA").distinct().collect()} == {SECOND.replace(tzinfo=None)}
    for name in medallion.GOLD_TABLES:
        assert lake.table("gold", name).count() == counts[f"gold.{name}"] > 0
    # FIXTURES: 148 customers, 3,657 lines, 387, 442, 254 and 442 result rows at this scale.
    assert (counts["silver.cadastro"], counts["silver.pedido"]) == (148, 3657)
    assert counts["gold.pedidos_por_cliente_semestre"] == 387
    assert counts["gold.ticket_medio_cliente_ano_mes"] == counts["gold.tiers_clientes"] == 442
    assert counts["gold.intervalo_medio_compras"] == 254


def test_job_entry_point(spark, sf_dir, tmp_path, capsys):
    from ordstrata import job

    paths = write_files(spark, sf_dir, str(tmp_path))
    names = ["--root", str(tmp_path / "lake"), "--customers", paths[0], "--orders", paths[1]]
    job.main([*names, "--namespace", "entry", "--load-ts", "2024-01-01T00:00:00+00:00", "--as-of", "2024-01-01"])
    assert spark.table("entry_gold.tiers_clientes").count() == 442
    assert "gold.tiers_clientes" in capsys.readouterr().out


def test_failed_step_is_logged_and_raised(spark, lake, tmp_path):
    medallion.create_history(lake)
    bad = ("x", "e", "n", "d", "s", "c", "c", "e", "1", FIRST, "o", "u")
    lake.append_load("raw", "raw_cadastro", spark.createDataFrame([bad], RAW_CUSTOMERS), FIRST)
    with pytest.raises(PySparkException):
        medallion.load_silver(lake, FIRST)
    found = {row.TABELA: row for row in run_log.read_log(lake).collect()}
    assert found["silver.pedido"].STATUS == "SUCESSO"  # the other step is tried all the same
    row = found["silver.cadastro"]
    assert (row.STATUS, row.QTD_INCLUIDO) == ("ERRO", None)
    assert "CAST_INVALID_INPUT" in row.OBSERVACAO


def test_quotes_are_doubled_and_backslashes_are_plain(spark, tmp_path):
    schema = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
    rows = ['1;"Ana ""Nina"" Sa";x', '1;"tela 14""";z', '1;"C:\\";z', '1;"a;b";""', "1;;y"]
    (tmp_path / "f.csv").write_bytes("\n".join(["a;b;c", *rows]).encode())
    read = read_delimited(spark, str(tmp_path), schema)
    found = [r.b for r in read.collect()]
    assert found == ['Ana "Nina" Sa', 'tela 14"', "C:\\", "a;b", None]
    write_delimited(read, str(tmp_path / "again"))
    again = read_delimited(spark, str(tmp_path / "again"), schema)
    assert sorted(map(str, again.collect())) == sorted(map(str, read.collect()))


def test_an_empty_load_is_not_the_newest(spark, lake):
    schema = "x bigint, DT_CARGA timestamp"
    lake.create("raw", "h", spark.createDataFrame([], schema).schema, partition_by="DT_CARGA")
    rows = spark.range(3).withColumnRenamed("id", "x")
    assert lake.append_load("raw", "h", rows, FIRST_LOAD) == 3
    assert lake.append_load("raw", "h", rows.limit(0), SECOND_LOAD) == 0
    assert lake.latest("raw", "h").count() == 3


def test_an_empty_bucketed_result_and_a_pruned_year(spark, lake):
    rows = spark.sql("SELECT id AS k, CAST(2018 + id % 4 AS bigint) AS ANO FROM range(100)")
    rows = rows.union(spark.sql("SELECT 100L, CAST(NULL AS bigint)"))
    layout = ("ANO", (2019, 2020))
    assert lake.replace("gold", "t", rows.limit(0), bucket_by=layout) == 0
    assert lake.table("gold", "t").schema.simpleString() == rows.schema.simpleString()
    assert lake.table("gold", "t").count() == 0
    assert lake.bucketed("gold", "t", layout, [2019]).count() == 0
    assert lake.replace("gold", "t", rows, bucket_by=layout) == 101
    table = lake.table("gold", "t")
    assert sorted(table.collect(), key=str) == sorted(rows.collect(), key=str)
    picked = spark.sql(f"SELECT k FROM {lake.name('gold', 't')} WHERE ANO = 2020")
    assert picked.count() == 25
    plan = picked._jdf.queryExecution().executedPlan().toString()
    assert "ANO" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_every_step_is_tried(spark, lake):
    medallion.create_history(lake)

    def fails():
        raise ValueError("no")

    steps = {"a": ("x", fails), **{f"t{i}": ("x", lambda: 1) for i in range(9)}}
    with pytest.raises(ValueError, match="no"):
        run_log.run_steps(lake, FIRST_LOAD, steps)
    states = [r.STATUS for r in lake.table("raw", "log_rodadas").collect()]
    assert sorted(states) == ["ERRO"] + ["SUCESSO"] * 9


def test_a_failed_stage_is_logged_and_the_other_is_not(spark, lake, tmp_path):
    medallion.create_history(lake)
    (tmp_path / "c.csv").write_text("a;b\n1;2\n")
    header = ";".join(STAGE_ORDERS.names)
    (tmp_path / "o.csv").write_text(f"{header}\n{';' * (len(STAGE_ORDERS) - 1)}\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        medallion.load_stage(lake, FIRST, str(tmp_path / "c.csv"), str(tmp_path / "o.csv"))
    [row] = run_log.read_log(lake).collect()
    assert (row.TABELA, row.STATUS, row.QTD_INCLUIDO) == ("stg_cadastro", "ERRO", None)
    assert lake.table("stage", "stg_pedido").count() == 1


def test_header_drift(spark, tmp_path):
    for name, text in {
        "same": "a;b;c\n1;2;3\n",
        "moved": 'b;"a";c\na;b;c\n',
        "more": "a;b;c;d\n",
        "fewer": "a;\n1;2\n",
        "none": "",
    }.items():
        (tmp_path / f"{name}.csv").write_text(text)
    schema = spark.createDataFrame([], TEXT).schema
    rows = header_drift(spark, str(tmp_path), schema)
    found = [(r.file.rsplit("/", 1)[-1][:-4], *r[1:]) for r in rows.collect()]
    assert sorted(found, key=str) == [
        ("fewer", 3, "c", None),
        ("more", 4, None, "d"),
        ("moved", 1, "a", "b"),
        ("moved", 2, "b", "a"),
    ]


def test_same_rows(spark):
    given = [("1", None), ("1", None), (None, "1"), ("", "x")]

    def held(left, right):
        frames = [spark.createDataFrame(x, "a string, b string") for x in (left, right)]
        return same_rows(*frames, ["a", "b"])

    assert held(given, given[::-1]) and held([], [])
    assert not held(given, given[1:])
    assert not held(given, [*given[1:], (None, "1")])
    assert not held(given, [*given[:3], (None, "x")]) and not held(given, [])


def test_unchanged_deliveries_add_no_load(spark, lake, sf_dir):
    medallion.create_history(lake)
    paths = write_files(spark, sf_dir, lake.root)
    medallion.load_stage(lake, FIRST, *paths)
    for at in (FIRST, SECOND):
        medallion.load_raw(lake, at, *paths, skip_unchanged=True)
    log = run_log.read_log(lake).filter(F.col("DATA_RODADA") == SECOND)
    newest = {r.TABELA: r for r in log.collect()}
    assert (newest["raw_pedido"].QTD_INCLUIDO, newest["raw_pedido"].OBSERVACAO) == (0, run_log.UNCHANGED)
    assert lake.table("raw", "raw_pedido").select(LOAD_COLUMN).distinct().count() == 1


def test_text_layers_hold_plain_text_and_silver_dictionaries(spark, lake, tmp_path):
    rows = spark.createDataFrame([("a",), ("a",), ("b",)], "c string").coalesce(1)
    lake.replace("stage", "t", rows)
    lake.replace_split("stage", "split", rows, F.col("c") == "b", ["c"], ["c"])
    lake.create("raw", "t", T.StructType.fromDDL("c string, DT_CARGA timestamp"), "", "DT_CARGA")
    lake.append_load("raw", "t", rows, dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc))
    lake.replace("silver", "t", rows)
    dictionaries = {}
    for file in tmp_path.rglob("*.parquet"):
        found = pq.ParquetFile(file).metadata
        if found.num_rows:
            column = found.row_group(0).column(0)
            dictionaries.setdefault(file.relative_to(tmp_path).parts[0], set()).add(column.has_dictionary_page)
    assert dictionaries == {"stage": {False}, "raw": {False}, "silver": {True}}
    assert sorted(r.c for r in lake.table("raw", "t").collect()) == ["a", "a", "b"]
