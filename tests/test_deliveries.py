"""Deliveries, their ledger, streams, rejected rows and columns by name."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordstrata.plans import deliveries, medallion, run_log
from ordstrata.plans.deliveries import CUSTOMERS, KNOWN, create_ledger, deliver
from ordstrata.schemas import CUSTOMER_COLUMNS, STAGE_CUSTOMERS, names
from ordstrata.sinks.tables import LOAD_COLUMN
from ordstrata.sources.delimited import (
    delivered_files,
    header_drift,
    headers,
    read_by_name,
    read_rejecting,
)
from ordstrata.streaming.ingest import ingest, run_ingest

DAYS = [dt.datetime(2024, 1, n, tzinfo=dt.timezone.utc) for n in range(1, 10)]
ABC = T.StructType([T.StructField(c, T.StringType()) for c in "abc"])
HEADER = ";".join(names(CUSTOMER_COLUMNS)) + ";;;;"


def customer(key, city="x"):
    return f"{key};e{key};n;01/02/1990;F;01/02/2020;{city};SP;1;;;;"


def write(folder, name, *lines, header=HEADER):
    folder.mkdir(exist_ok=True, parents=True)
    (folder / name).write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


@pytest.fixture
def ready(lake):
    medallion.create_history(lake)
    create_ledger(lake)
    return lake


def load(lake, path, at, **options):
    return deliver(lake, CUSTOMERS, delivered_files(lake.spark, path), at, path, **options)


def loads(lake):
    counted = lake.table("raw", "raw_cadastro").groupBy(LOAD_COLUMN).count().orderBy(LOAD_COLUMN)
    return [row["count"] for row in counted.collect()]


def last(entries):
    return entries[-1].rows, entries[-1].note


def test_ragged_rows_are_kept_apart(spark, tmp_path):
    rows = ["1;2;3", "1;2", "4;5;6;7", '"a;b";"x ""y"" z";', "", '8;"9;9"', '1;2;"']
    write(tmp_path, "x.csv", *rows, header="a;b;c")
    found = read_rejecting(spark, str(tmp_path), ABC)
    good = [tuple(r)[:3] for r in found.filter("LINHA IS NULL").collect()]
    assert good[:2] == [("1", "2", "3"), ("a;b", 'x "y" z', None)]
    bad = {(r.LINHA, r.MOTIVO) for r in found.filter("LINHA IS NOT NULL").collect()}
    assert {("1;2", "short"), ("4;5;6;7", "long"), ('8;"9;9"', "short")} <= bad
    assert all(r.ARQUIVO.endswith("/x.csv") for r in found.collect())


def test_rejected_rows_have_their_table(ready, tmp_path):
    path = write(tmp_path / "in", "a.csv", customer(1), "2;e2", customer(3))
    entries = load(ready, path, DAYS[0])
    assert [(e.table, e.rows) for e in entries] == [("stg_cadastro_rejeitado", 1), ("raw_cadastro", 2)]
    [row] = ready.table("stage", "stg_cadastro_rejeitado").collect()
    assert (row.LINHA, row.MOTIVO) == ("2;e2", "short")
    assert ready.table("stage", "stg_cadastro").columns == names(STAGE_CUSTOMERS)
    # One version holds both, and an old one goes with both.
    assert ready.place("stage", "stg_cadastro") == ready.place("stage", "stg_cadastro_rejeitado")
    path = write(tmp_path / "in", "b.csv", customer(4))
    assert load(ready, path, DAYS[1])[0].rows == 0
    assert ready.table("stage", "stg_cadastro_rejeitado").count() == 0
    assert ready.remove_old_versions("stage", "stg_cadastro") == 1


def test_only_bad_rows_and_no_rows(ready, tmp_path):
    assert last(load(ready, write(tmp_path / "bad", "a.csv", "1;2"), DAYS[0])) == (0, run_log.EMPTY)
    assert last(load(ready, write(tmp_path / "none", "a.csv"), DAYS[1])) == (0, run_log.EMPTY)
    assert ready.table("stage", "stg_cadastro").count() == 0 and loads(ready) == []
    assert last(load(ready, str(tmp_path / "none"), DAYS[2])) == (0, KNOWN)


def test_a_file_is_loaded_once(ready, tmp_path):
    first = write(tmp_path / "1", "a.csv", customer(1), customer(2))
    other = write(tmp_path / "2", "a.csv", customer(1))
    assert last(load(ready, first, DAYS[0])) == (2, None)
    assert last(load(ready, first, DAYS[1])) == (0, KNOWN)
    assert last(load(ready, other, DAYS[2])) == (1, None)
    assert last(load(ready, first, DAYS[3])) == (0, KNOWN)
    # A new file with the rows of an old state is the newest load all the same.
    back = write(tmp_path / "3", "a.csv", customer(2), customer(1))
    assert last(load(ready, back, DAYS[4], skip_unchanged=True)) == (2, None)
    again = write(tmp_path / "4", "a.csv", customer(1), customer(2))
    assert last(load(ready, again, DAYS[5], skip_unchanged=True)) == (0, run_log.UNCHANGED)
    assert last(load(ready, again, DAYS[6])) == (0, KNOWN)
    assert loads(ready) == [2, 1, 2]


def test_a_changed_file_and_more_files_in_a_folder(ready, tmp_path):
    import os

    path = write(tmp_path / "in", "a.csv", customer(1))
    assert last(load(ready, path, DAYS[0])) == (1, None)
    write(tmp_path / "in", "b.csv", customer(2), customer(3))
    assert last(load(ready, path, DAYS[1])) == (2, None)  # the new file only
    write(tmp_path / "in", "a.csv", customer(4))
    os.utime(tmp_path / "in" / "a.csv", (2_000_000_000, 2_000_000_000))
    assert last(load(ready, path, DAYS[2])) == (1, None)
    assert loads(ready) == [1, 2, 1]


def test_two_deliveries_at_one_time_are_two_loads(ready, tmp_path):
    for n in (1, 2):
        load(ready, write(tmp_path / str(n), "a.csv", *map(customer, range(n))), DAYS[0])
    assert loads(ready) == [1, 2]


@pytest.mark.parametrize("at_state", [deliveries.DONE, "history"])
def test_a_run_cut_short_is_repeated_under_its_time(ready, tmp_path, monkeypatch, at_state):
    path = write(tmp_path / "in", "a.csv", customer(1), customer(2))
    append, append_load = ready.append, ready.append_load

    def dying(layer, table, rows):
        if at_state in {r.ESTADO for r in rows.collect()}:
            raise InterruptedError
        append(layer, table, rows)

    def dying_load(*given):
        if at_state == "history":
            raise InterruptedError
        return append_load(*given)

    monkeypatch.setattr(ready, "append", dying)
    monkeypatch.setattr(ready, "append_load", dying_load)
    with pytest.raises(InterruptedError):
        load(ready, path, DAYS[0])
    monkeypatch.undo()
    assert last(load(ready, path, DAYS[5])) == (2, None)
    [row] = ready.table("raw", "raw_cadastro").select(LOAD_COLUMN).distinct().collect()
    assert row[0].astimezone(dt.timezone.utc) == DAYS[0] and loads(ready) == [2]


def test_columns_are_found_by_name(spark, ready, tmp_path):
    plain = write(tmp_path / "1", "a.csv", customer(1, "one"))
    assert last(load(ready, plain, DAYS[0], by_name=True)) == (1, None)
    moved = "cidade;ID ;extra;EMAIL;;NOME"
    path = write(tmp_path / "2", "a.csv", 'two;2;"x;y";e2;;n2', "short;row", header=moved)
    assert last(load(ready, path, DAYS[1], by_name=True)) == (1, "new columns: extra")
    # A later file without the new column.
    assert last(load(ready, write(tmp_path / "3", "a.csv", customer(3)), DAYS[2], by_name=True)) == (1, None)
    rows = ready.table("raw", "raw_cadastro").orderBy("ID").collect()
    shown = [(r.ID, r.CIDADE, r.EMAIL, r.NOME, r.SEXO, r.extra) for r in rows]
    assert shown == [("1", "one", "e1", "n", "F", None), ("2", "two", "e2", "n2", None, "x;y"), ("3", "x", "e3", "n", "F", None)]
    no_key = write(tmp_path / "4", "a.csv", "e;n", header="EMAIL;NOME")
    with pytest.raises(ValueError, match="no column ID in"):
        load(ready, no_key, DAYS[3], by_name=True)
    twice = write(tmp_path / "5", "a.csv", "e;n", header="ID;id")
    with pytest.raises(ValueError, match="twice"):
        read_by_name(spark, [f"{twice}/a.csv"], STAGE_CUSTOMERS, ["ID"])


def test_headers_follow_the_rules_of_rows(spark, tmp_path):
    for name, text in {"a": '"x;y";"say ""z""";\n1;2;3\n', "b": "﻿a;b\n", "c": "", "d": "\n"}.items():
        (tmp_path / f"{name}.csv").write_text(text, encoding="utf-8")
    paths = [str(tmp_path / f"{n}.csv") for n in "abcd"]
    assert list(headers(spark, paths).values()) == [["x;y", 'say "z"', ""], ["a", "b"], [""]]
    drift = header_drift(spark, str(tmp_path / "a.csv"), T.StructType([T.StructField("x;y", T.StringType())]))
    assert [tuple(r)[1:] for r in drift.collect()] == [(2, None, 'say "z"'), (3, None, "")]


def test_compressed_files(spark, ready, tmp_path):
    import gzip

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv.gz").write_bytes(gzip.compress(f"{HEADER}\n{customer(1)}\n".encode()))
    assert last(load(ready, str(tmp_path / "in"), DAYS[0], by_name=True)) == (1, None)


def test_arrivals_are_streamed_once(ready, tmp_path):
    folder = tmp_path / "in"
    write(folder, "a.csv", customer(1), customer(2))
    write(folder, "b.csv", customer(3))
    assert ingest(ready, CUSTOMERS, str(folder)) == 2  # a load for each file
    assert ingest(ready, CUSTOMERS, str(folder)) == 0
    write(folder, "c.csv", *map(customer, range(4)))
    assert ingest(ready, CUSTOMERS, str(folder)) == 1
    assert loads(ready) == [2, 1, 4]
    # The ledger knows a file that a run without the stream has loaded.
    load(ready, write(folder, "d.csv", customer(9)), DAYS[0])
    assert ingest(ready, CUSTOMERS, str(folder)) == 0
    assert sorted(loads(ready)) == [1, 1, 2, 4]


def test_a_batch_killed_before_its_commit(ready, tmp_path, monkeypatch):
    folder = tmp_path / "in"
    write(folder, "a.csv", customer(1), customer(2))
    append_load = ready.append_load

    def dying(*given):
        append_load(*given)
        raise InterruptedError("killed")

    monkeypatch.setattr(ready, "append_load", dying)
    with pytest.raises(Exception, match="killed"):
        ingest(ready, CUSTOMERS, str(folder))
    monkeypatch.undo()
    before = ready.table("raw", "raw_cadastro").select(LOAD_COLUMN).distinct().collect()
    write(folder, "b.csv", customer(3))
    assert ingest(ready, CUSTOMERS, str(folder)) == 2
    assert loads(ready) == [2, 1]
    after = ready.table("raw", "raw_cadastro").select(F.min(LOAD_COLUMN)).collect()
    assert before == after
    states = [r.STATUS for r in run_log.read_log(ready).collect()]
    assert states.count("ERRO") == 1


def test_run_ingest_builds_results_when_something_came(lake, sf_dir, tmp_path):
    from checks.mapping import AS_OF, RULES
    from checks.queries import write_files

    paths = [f"{p}/*.csv" for p in write_files(lake.spark, sf_dir, str(tmp_path))]
    log = run_ingest(lake, *paths, AS_OF, RULES, files_per_load=100, gated=True)
    tables = {r.TABELA: r.QTD_INCLUIDO for r in log.collect()}
    assert tables["gold.tiers_clientes"] == 442 and tables["stg_pedido_rejeitado"] == 0
    written = lake.place("gold", "tiers_clientes")
    run_ingest(lake, *paths, AS_OF, RULES, files_per_load=100)
    assert lake.place("gold", "tiers_clientes") == written
