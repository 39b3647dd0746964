"""Tables that keep one row per key and take changes into the partitions these touch."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordstrata.operators.quality import upsert
from ordstrata.sinks.tables import Lake

HASH_BUCKET = "BALDE"


@dataclass(frozen=True)
class Merged:
    inserted: int
    updated: int
    kept: int


class MergedTable:
    """A table of a lake with one row per key, partitioned by a hash of the key.

    Changes are joined to the rows of the partitions they fall into, and only these are written. The
    new content of the partitions is written beside the table first; if a run is cut short while it
    replaces them, the next one finds it whole and replaces them again, so none is lost or half
    merged. One writer at a time.
    """

    def __init__(
        self,
        lake: Lake,
        layer: str,
        table: str,
        schema: T.StructType,
        key: Sequence[str],
        n_buckets: int = 256,
        comment: str = "",
    ):
        self.lake, self.layer, self.table = lake, layer, table
        self.schema, self.key, self.n_buckets = schema, list(key), n_buckets
        bucket = T.StructField(HASH_BUCKET, T.IntegerType(), True, {"comment": "hash of the key"})
        self.stored_schema = T.StructType([*schema.fields, bucket])
        lake.create(layer, table, self.stored_schema, comment, HASH_BUCKET)
        self.place = f"{lake.root}/{layer}/{table}"
        self.pending = f"{lake.root}/{layer}/{table}__merge"

    def rows(self) -> DataFrame:
        return self.lake.table(self.layer, self.table).select(*self.schema.names)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.key), F.lit(self.n_buckets)).cast("int").alias(HASH_BUCKET)

    def merge(self, changes: DataFrame, ignore: Sequence[str] = ()) -> Merged:
        """Insert the rows of ``changes`` (the table's columns) whose keys are new, replace those
        that differ and leave equal ones as they are; columns to ``ignore`` make no difference.

        A key that is NULL or occurs twice among the changes raises an error, and nothing changes.
        The same changes again leave all rows as they are.
        """
        spark = self.lake.spark
        self.recover()
        changed = f"{self.pending}/changes"
        keyless = F.greatest(*(F.col(k).isNull().cast("int") for k in self.key), F.lit(0)) > 0
        given = Observation()
        observed = changes.select(*self.schema.names, self._bucket()).observe(
            given, F.count(F.lit(1)).alias("rows"), F.count_if(keyless).alias("keyless")
        )
        observed.write.mode("overwrite").partitionBy(HASH_BUCKET).parquet(changed)
        if not given.get["rows"]:
            self._discard()
            return Merged(0, 0, 0)
        new = spark.read.schema(self.stored_schema).parquet(changed)
        twice = new.groupBy(HASH_BUCKET, *self.key).count().filter("count > 1")
        if given.get["keyless"] or not twice.isEmpty():
            self._discard()
            raise ValueError(f"{self.layer}.{self.table}: a changed key is NULL or occurs twice")
        # Folder names, at most n_buckets.
        touched = [row[0] for row in new.select(HASH_BUCKET).distinct().collect()]
        current = self.lake.table(self.layer, self.table).filter(F.col(HASH_BUCKET).isin(touched))
        merged = upsert(current, new.select(*current.columns), [HASH_BUCKET, *self.key], ignore)
        counts = Observation()
        kinds = {kind: F.count_if(F.col("change") == kind) for kind in ("inserted", "updated")}
        counted = merged.observe(
            counts,
            *(n.alias(kind) for kind, n in kinds.items()),
            F.count_if((F.col("change") == "kept") & F.col("changed")).alias("kept"),
        )
        whole = counted.select(*self.schema.names, HASH_BUCKET)
        whole.write.mode("overwrite").partitionBy(HASH_BUCKET).parquet(f"{self.pending}/whole")
        found = counts.get
        self.recover()
        return Merged(found["inserted"], found["updated"], found["kept"])

    def recover(self) -> bool:
        """Finish a merge that was cut short while it replaced partitions, and forget one that was
        cut short before; whether there was one to finish."""
        spark = self.lake.spark
        path_of = spark._jvm.org.apache.hadoop.fs.Path
        files = path_of(self.pending).getFileSystem(spark._jsc.hadoopConfiguration())
        whole = f"{self.pending}/whole"
        finished = files.exists(path_of(f"{whole}/_SUCCESS"))
        if finished:
            self._apply(whole)
        self._discard()
        return finished

    def _apply(self, whole: str) -> None:
        spark = self.lake.spark
        rows = spark.read.schema(self.stored_schema).parquet(whole)
        # The partitions that the rows fall into are replaced, the others keep their files.
        (
            rows.repartition(HASH_BUCKET)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(HASH_BUCKET)
            .parquet(self.place)
        )
        name = self.lake.name(self.layer, self.table)
        spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")
        spark.catalog.refreshTable(name)

    def _discard(self) -> None:
        spark = self.lake.spark
        place = spark._jvm.org.apache.hadoop.fs.Path(self.pending)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
