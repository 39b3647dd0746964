"""What a job leaves on disk: packed tables and sources, no shuffle files of finished writes."""

import datetime as dt
import glob
import time
from concurrent.futures import ThreadPoolExecutor
from threading import Barrier

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from checks.queries import write_files
from ordstrata.schemas import STAGE_CUSTOMERS, STAGE_ORDERS
from ordstrata.session import DROP_SHUFFLE_FILES, shuffle_files_dropped
from ordstrata.sources import delimited
from ordstrata.sources.delimited import header_drift, read_delimited, write_delimited

AT = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)


def shuffle_files(spark):
    env = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get()
    places = env.blockManager().diskBlockManager().localDirsString()
    return {f for place in places for f in glob.glob(f"{place}/*/shuffle_*.data")}


def left_behind(spark, before):
    """Shuffle files that came since; those being deleted get five seconds."""
    for _ in range(50):
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    return shuffle_files(spark) - before


def grouped(spark):
    return spark.range(20_000, numPartitions=4).groupBy((F.col("id") % 997).alias("k")).count()


def test_a_finished_write_leaves_no_shuffle_files(spark, lake, tmp_path):
    before = shuffle_files(spark)
    rows = grouped(spark)
    lake.replace("gold", "t", rows, cluster_by=["k"])
    lake.replace("gold", "y", rows, bucket_by=("k", (100, 200)))
    lake.replace_split("silver", "s", rows, F.col("k") % 2 == 0, ["k", "count"], ["k"])
    lake.replace_hashed("silver", "h", rows, "k", 4)
    write_delimited(rows.select(F.col("k").cast("string")), str(tmp_path / "f"))
    assert left_behind(spark, before) == set()
    for table in ("t", "y"):
        assert lake.table("gold", table).agg(F.count("*"), F.sum("count")).first()[:] == (997, 20_000)


def test_rows_can_be_written_again(spark, lake):
    rows = grouped(spark)
    for table in ("t", "u"):
        assert lake.replace("gold", table, rows) == 997
    kept = rows.cache()
    try:
        assert lake.replace("gold", "v", kept) == 997 and kept.agg(F.sum("count")).first()[0] == 20_000
    finally:
        kept.unpersist()


@pytest.mark.parametrize("own", [None, "false", "true"])
def test_the_setting_of_the_session_comes_back(spark, own):
    if own:
        spark.conf.set(DROP_SHUFFLE_FILES, own)
    together = Barrier(3)

    def write(fails):
        with shuffle_files_dropped(spark):
            together.wait(20)
            with shuffle_files_dropped(spark):
                inside = spark.conf.get(DROP_SHUFFLE_FILES)
            together.wait(20)
            if fails:
                raise ValueError("no table")
        return inside

    try:
        with ThreadPoolExecutor(3) as pool:
            done = [pool.submit(write, fails) for fails in (False, True, False)]
        assert isinstance(done[1].exception(), ValueError)
        assert done[0].result() == done[2].result() == "true"
        assert spark.conf.get(DROP_SHUFFLE_FILES, None) == own
    finally:
        spark.conf.unset(DROP_SHUFFLE_FILES)


def test_tables_of_all_layers_are_packed(spark, lake, tmp_path):
    rows = spark.range(5_000, numPartitions=1).select(F.expr("uuid()").alias("c"))
    for layer in ("stage", "silver", "gold"):
        lake.replace(layer, "t", rows)
    lake.replace_split("silver", "split", rows, F.lit(False), ["c"], ["c"])
    lake.replace_hashed("silver", "hashed", rows.withColumn("k", F.lit(1)), "k", 1)
    lake.create("raw", "t", T.StructType.fromDDL("c string, DT_CARGA timestamp"), "", "DT_CARGA")
    lake.append_load("raw", "t", rows, AT)
    tables = {}
    for file in tmp_path.rglob("*.parquet"):
        found = pq.ParquetFile(file).metadata
        if found.num_rows:
            column = found.row_group(0).column(0)
            # 36 characters and their length, of which 16 bytes are what tells two ids apart.
            small = column.total_compressed_size < 25 * found.num_rows
            tables["/".join(file.relative_to(tmp_path).parts[:2])] = (column.compression, small)
    assert set(tables) == {
        "stage/t", "raw/t", "silver/t", "silver/split", "silver/hashed", "gold/t",
    }
    assert set(tables.values()) == {("ZSTD", True)}


def test_packed_sources_give_the_same_rows(spark, sf_dir, tmp_path):
    plain = write_files(spark, sf_dir, str(tmp_path / "plain"))
    packed = write_files(spark, sf_dir, str(tmp_path / "packed"), "gzip")
    for one, other, schema in zip(plain, packed, (STAGE_CUSTOMERS, STAGE_ORDERS)):
        assert glob.glob(f"{one}/*.csv") and glob.glob(f"{other}/*.csv.gz") and not glob.glob(f"{other}/*.csv")
        left, right = (read_delimited(spark, path, schema) for path in (one, other))
        assert left.count() == right.count() > 0
        assert left.exceptAll(right).isEmpty()
        assert header_drift(spark, other, schema).isEmpty()


def test_a_packed_file_is_no_longer_than_a_task_should_read(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(delimited.PACKED, "maxRecordsPerFile", "4")
    rows = spark.range(10, numPartitions=1).select(F.col("id").cast("string").alias("a"))
    write_delimited(rows, str(tmp_path / "f"), "gzip")
    assert len(glob.glob(f"{tmp_path}/f/*.csv.gz")) == 3
    again = read_delimited(spark, str(tmp_path / "f"), rows.schema)
    assert sorted(int(r.a) for r in again.collect()) == list(range(10))
