"""History, lookup, aggregate and window operators on small tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ordstrata.operators import aggregates, history, lookups, windows
from ordstrata.operators.quality import category_dimension, quality_report, upsert

LOAD = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def values(rows):
    return sorted(map(tuple, rows.collect()), key=str)


def test_keyed_rows_drops_blank_and_header_keys(spark):
    rows = spark.createDataFrame([("1",), (" ID ",), ("ID",), ("",), ("\t",), (None,), (" 2",)], "ID string")
    assert values(history.keyed_rows(rows, "ID")) == [(" 2",), ("1",)]


def test_content_id_tells_null_from_empty_and_repeats(spark):
    rows = spark.createDataFrame([("a", None), ("a", ""), (None, "a"), ("a", None)], "x string, y string")
    ids = [r[0] for r in rows.select(history.content_id("x", "y")).collect()]
    assert len(set(ids)) == 3 and ids[0] == ids[3]


def test_provenance_needs_a_time_zone(spark):
    rows = spark.range(3)
    with pytest.raises(ValueError):
        history.with_provenance(rows, dt.datetime(2024, 1, 1), "x")
    marked = history.with_provenance(rows, LOAD, "file").collect()
    assert len({r.UUID_LINHA for r in marked}) == 3
    assert {(r.DT_CARGA, r.ORIGEM) for r in marked} == {(dt.datetime(2024, 1, 1), "file")}


def test_latest_load(spark):
    rows = spark.createDataFrame([(1, 10), (2, 20), (3, 20)], "id int, load int")
    assert values(history.latest_load(rows, "load")) == [(2, 20), (3, 20)]
    assert values(history.latest_load(rows.filter("false"), "load")) == []


def test_lookups(spark):
    listed = lookups.literal_relation(spark, ["a", "b"], "x")
    assert values(listed) == [("a",), ("b",)]
    rows = spark.createDataFrame([("a",), ("c",), (None,)], "x string")
    kept = rows.select(lookups.keep_listed(F.col("x"), ["a", "b"]))
    assert values(kept) == [("a",), (None,), (None,)]
    assert values(lookups.members_only(rows, listed.union(listed), "x")) == [("a",)]


def test_with_dimension_equals_join_before_grouping(spark):
    detail = spark.createDataFrame([(1, 5), (1, 7), (2, 1), (3, 2)], "k int, v int")
    dimension = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b"), (2, None)], "k int, n string")
    totals = detail.groupBy("k").agg(F.sum("v").alias("v"))
    for how in ("left", "inner"):
        joined = lookups.with_dimension(totals, dimension, "k", ["n"], ["v"], how)
        plain = detail.join(dimension, "k", how).groupBy("k", "n").agg(F.sum("v").alias("v"))
        assert values(joined.select("k", "n", "v")) == values(plain)


def test_conditional_aggregates(spark):
    rows = spark.createDataFrame([(1, 2019, 5), (1, 2020, 7), (2, None, 3)], "k int, y int, v int")
    condition = F.col("y") == 2019
    found = rows.groupBy("k").agg(
        aggregates.rows_counted(),
        aggregates.count_where(condition),
        aggregates.any_where(condition),
        aggregates.sum_where(condition, F.col("v")),
    )
    assert values(found) == [(1, 2, 1, True, 5), (2, 1, 0, False, 0)]
    pivoted = aggregates.pivot_sums(rows, ["k"], "y", "v", {2019: "a", 2020: "b"})
    assert values(pivoted) == [(1, 5, 7), (2, 0, 0)]


def test_windows(spark):
    rows = spark.createDataFrame([("x", 3), ("x", 1), ("y", 2)], "k string, v int")
    assert values(rows.select("k", "v", windows.previous("v", "k"))) == [("x", 1, None), ("x", 3, 1), ("y", 2, None)]
    totals = rows.select("v", windows.running_total(["v"], "v"), windows.grand_total("v"))
    assert values(totals) == [(1, 1, 6), (2, 3, 6), (3, 6, 6)]
    tied = spark.createDataFrame([(1, 2), (1, 3), (2, 1)], "o int, v int")
    assert values(tied.select("o", windows.running_total(["o"], "v"))) == [(1, 5), (1, 5), (2, 6)]


def test_quality_report_upsert_and_dimension(spark):
    rows = spark.createDataFrame([(1, "a"), (1, None), (2, " "), (None, "b")], "k int, v string")
    report = quality_report(rows, {"no_value": F.col("v").isNull()}, [F.col("k")])
    assert sorted(tuple(r) for r in report.collect()) == [("duplicate_key", 1, 4), ("no_value", 1, 4)]
    none = quality_report(rows.limit(0), {"no_value": F.col("v").isNull()}, [F.col("k")])
    assert sorted(tuple(r) for r in none.collect()) == [("duplicate_key", 0, 0), ("no_value", 0, 0)]

    old = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (None, "x")], "k int, v string")
    new = spark.createDataFrame([(2, None), (3, "d"), (4, "e"), (None, "y")], "k int, v string")
    found = sorted((str(r.k), str(r.v), r.change) for r in upsert(old, new, ["k"]).collect())
    assert found == [
        ("1", "a", "kept"),
        ("2", "None", "kept"),
        ("3", "d", "updated"),
        ("4", "e", "inserted"),
        ("None", "x", "kept"),
        ("None", "y", "inserted"),
    ]
    keys = category_dimension(rows, "v", "id").collect()
    assert len(keys) == len({r.id for r in keys}) == 3
