"""Tables that operators write and read again, and small helpers they share."""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

from ordstrata.session import scratch_folder


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(rows: DataFrame) -> DataFrame:
    """``rows`` written once to the shared scratch folder: lineage ends there, and later passes
    see the same rows even if an executor is lost."""
    spark = rows.sparkSession
    folder = scratch_folder(spark)
    rows.write.parquet(folder)
    return spark.read.schema(rows.schema).parquet(folder)


@contextmanager
def rows_at_once(spark: SparkSession, most: int) -> Iterator[None]:
    """Python functions over tables that are read inside get ``most`` rows at once, as long rows would
    fill memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Cache(dict):
    """Values of ``make`` by key; emptied when it holds ``limit`` keys, so memory stays bounded."""

    def __init__(self, make, limit: int = 200_000):
        super().__init__()
        self.make, self.limit = make, limit

    def __missing__(self, key):
        if len(self) >= self.limit:
            self.clear()
        value = self[key] = self.make(key)
        return value


def shared(spark: SparkSession, value: object) -> Callable[[], object]:
    """A function that gives ``value``, of bounded size, inside tasks. Classes of this package go
    with it."""
    packed = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(packed.value)
