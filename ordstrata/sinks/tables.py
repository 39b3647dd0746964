"""The tables of the four layers, as Parquet below one folder plus their names in the catalog.

* ``replace`` writes a new version into a folder of its own and then points the table's view to
  it. Readers see the old or the new version, never a half-written one, and a query may replace
  the table it reads. A job that loses executors or fails leaves the old version in place.
* ``append_load`` writes one partition per load. Repeating a load replaces its partition, so that
  a retried job does not add the rows twice. The folder names hold the load time in the session's
  time zone, which must stay the same (``build_session`` sets UTC).
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from threading import Lock

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordstrata.functions.numbers import range_bucket
from ordstrata.operators.expectations import Gate
from ordstrata.session import shuffle_files_dropped

LAYERS = ("stage", "raw", "silver", "gold")
LOAD_COLUMN = "DT_CARGA"
BUCKET_COLUMN = "FAIXA"
REJECTED_COLUMN, REJECTED = "REJEITADO", "_rejeitado"

# Layers of text that a run writes whole and reads whole once. Looking up each text of a dictionary
# takes longer there than the further bytes of plain text do.
PLAIN_LAYERS = ("stage", "raw")
PLAIN = {"parquet.enable.dictionary": "false"}
# Of all tables. The digits of row ids, most of a raw load, only shrink under a codec that codes single
# characters by how often they come.
CODEC = {"compression": "zstd"}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _column_list(schema: T.StructType, with_types: bool) -> str:
    columns = []
    for field in schema:
        column = f"`{field.name}`"
        if with_types:
            column += f" {field.dataType.simpleString()}"
        if field.metadata.get("comment"):
            column += f" COMMENT {_quoted(field.metadata['comment'])}"
        columns.append(column)
    return ", ".join(columns)


def arranged(rows: DataFrame, keys: Sequence[str | Column]) -> DataFrame:
    """Rows in key ranges, sorted inside each: every file covers a narrow range of the keys, and
    a frequent leading key is spread over as many files as it needs."""
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def _encoding(layer: str) -> dict[str, str]:
    return {**CODEC, **PLAIN} if layer in PLAIN_LAYERS else CODEC


class Lake:
    """Tables of one namespace. ``root`` is a folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str, namespace: str = "ordstrata"):
        self.spark = spark
        self.root = root.rstrip("/")
        self.namespace = namespace
        self._appending = Lock()
        for layer in LAYERS:
            place = _quoted(f"{self.root}/{layer}")
            spark.sql(f"CREATE DATABASE IF NOT EXISTS `{namespace}_{layer}` LOCATION {place}")

    def name(self, layer: str, table: str) -> str:
        return f"`{self.namespace}_{layer}`.`{table}`"

    def table(self, layer: str, table: str) -> DataFrame:
        return self.spark.table(self.name(layer, table))

    def replace(
        self,
        layer: str,
        table: str,
        rows: DataFrame,
        comment: str = "",
        cluster_by: Sequence[str] = (),
        bucket_by: tuple[str, Sequence[int]] | None = None,
        gate: Gate | None = None,
    ) -> int:
        """Replace the table with ``rows`` and return how many there are.

        ``bucket_by`` names a whole-number column and its range boundaries: each range becomes a
        partition folder, values outside the ranges share one below and one above, none is lost.
        Inside it each value has a folder, so a filter on the column reads its files only.
        ``cluster_by`` arranges the rows by further columns inside; without it a frequent value is
        spread over files by a hash of the row. With a ``gate`` that the rows do not pass an error
        is raised and the old version stays; the rules are counted while the rows are written.
        """
        schema = rows.schema
        keys = list(cluster_by)
        if bucket_by:
            column, boundaries = bucket_by
            rows = rows.withColumn(BUCKET_COLUMN, range_bucket(F.col(column), boundaries))
            keys = [BUCKET_COLUMN, column, *(keys or [F.xxhash64(*schema.names)])]
        if keys:
            rows = arranged(rows, keys)
        place = self._new_place(layer, table)
        written = Observation()
        measures = gate.measures() if gate else []
        counted = rows.observe(written, F.count(F.lit(1)).alias("rows"), *measures)
        writer = counted.write.options(**_encoding(layer))
        if bucket_by:
            writer = writer.partitionBy(BUCKET_COLUMN, column)
        with shuffle_files_dropped(self.spark):
            writer.parquet(place)
        if bucket_by and not written.get["rows"]:
            # Without a partition there is no file; one without rows holds the columns.
            self.spark.createDataFrame([], rows.schema).write.mode("append").parquet(place)
        if gate:
            gate.check(f"{layer}.{table}", written.get, self.spark.read.parquet(place))
        # The type of a partition column is read off its folders.
        typed = {bucket_by[0]} if bucket_by else set()
        self._show(layer, table, schema, comment, place, place, typed)
        return written.get["rows"]

    def _new_place(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}/{uuid.uuid4().hex}"

    def _show(
        self,
        layer: str,
        table: str,
        schema: T.StructType,
        comment: str,
        place: str,
        folder: str,
        typed: set[str] | frozenset[str] = frozenset(),
    ) -> None:
        """Point the table to ``folder``, a version at ``place`` or a part of one."""
        shown = [
            f"CAST(`{f.name}` AS {f.dataType.simpleString()}) AS `{f.name}`"
            if f.name in typed
            else f"`{f.name}`"
            for f in schema
        ]
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(layer, table)} ({_column_list(schema, False)})"
            f" COMMENT {_quoted(comment)} TBLPROPERTIES ('place' = {_quoted(place)})"
            f" AS SELECT {', '.join(shown)} FROM parquet.`{folder}`"
        )

    def replace_split(
        self,
        layer: str,
        table: str,
        rows: DataFrame,
        rejected: Column,
        columns: Sequence[str],
        rejected_columns: Sequence[str],
        comment: str = "",
        gate: Gate | None = None,
    ) -> tuple[int, int]:
        """Replace ``table`` by ``columns`` of the good rows and ``<table>_rejeitado`` by
        ``rejected_columns`` of the others, and return how many there are of each.

        Both are written in one pass, into two folders of one version, and counted in it. A ``gate``
        sees the good rows only."""
        schema = rows.schema
        place = self._new_place(layer, table)
        marked = rows.withColumn(REJECTED_COLUMN, F.coalesce(rejected, F.lit(False)))
        bad = F.col(REJECTED_COLUMN)
        written = Observation()
        measures = gate.measures(~bad) if gate else []
        counted = marked.observe(
            written, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"), *measures
        )
        writer = counted.write.options(**_encoding(layer)).partitionBy(REJECTED_COLUMN)
        with shuffle_files_dropped(self.spark):
            writer.parquet(place)
        found = written.get
        parts = {}
        for side, n in (("false", found["rows"]), ("true", found["rejected"])):
            parts[side] = f"{place}/{REJECTED_COLUMN}={side}"
            if not n:  # a side without rows has no folder
                nothing = self.spark.createDataFrame([], schema)
                nothing.write.mode("overwrite").parquet(parts[side])
        if gate:
            gate.check(f"{layer}.{table}", found, self.spark.read.parquet(parts["false"]))
        good = T.StructType([schema[c] for c in columns])
        others = T.StructType([schema[c] for c in rejected_columns])
        self._show(layer, table + REJECTED, others, f"{comment}, rejected", place, parts["true"])
        self._show(layer, table, good, comment, place, parts["false"])
        return found["rows"], found["rejected"]

    def replace_hashed(
        self,
        layer: str,
        table: str,
        rows: DataFrame,
        key: str,
        n_buckets: int,
        comment: str = "",
        gate: Gate | None = None,
        most_skew: float = 4.0,
    ) -> tuple[int, bool]:
        """Replace the table with ``rows`` in ``n_buckets`` hash buckets of ``key``, sorted inside, and
        return how many rows there are and whether the table has these buckets.

        Grouping by the key and joins of tables with as many buckets of it need no shuffle then. A
        bucket is read by one task, so where the fullest would hold more than ``most_skew`` times the
        mean, as under a very frequent key, the table is written like other tables, whose shuffles
        adaptive execution can split. The rows per bucket are counted first, by a pass that reads
        the key and what decides which rows there are.
        """
        bucket = F.pmod(F.hash(key), F.lit(n_buckets))  # that of Spark's bucketed tables
        with shuffle_files_dropped(self.spark):
            sizes = [r["count"] for r in rows.groupBy(bucket.alias("bucket")).count().collect()]
        if max(sizes, default=0) * n_buckets > most_skew * max(sum(sizes), n_buckets):
            return self.replace(layer, table, rows, comment, gate=gate), False
        place = self._new_place(layer, table)
        version = f"{table}__{place.rsplit('/', 1)[-1]}"
        written = Observation()
        measures = gate.measures() if gate else []
        counted = rows.repartition(n_buckets, key).observe(
            written, F.count(F.lit(1)).alias("rows"), *measures
        )
        writer = counted.write.format("parquet").bucketBy(n_buckets, key).sortBy(key)
        writer = writer.options(**_encoding(layer), path=place)
        with shuffle_files_dropped(self.spark):
            writer.saveAsTable(self.name(layer, version))
        stored = self.spark.table(self.name(layer, version))
        if gate:
            gate.check(f"{layer}.{table}", written.get, stored)
        shown = ", ".join(f"`{c}`" for c in rows.columns)
        self.spark.sql(
            f"CREATE OR REPLACE VIEW {self.name(layer, table)} ({_column_list(rows.schema, False)})"
            f" COMMENT {_quoted(comment)} TBLPROPERTIES ('place' = {_quoted(place)})"
            f" AS SELECT {shown} FROM {self.name(layer, version)}"
        )
        return written.get["rows"], True

    def part(self, layer: str, table: str, rejected: bool) -> DataFrame:
        """All columns of the good or the rejected rows of a table written by :meth:`replace_split`."""
        side = str(rejected).lower()
        return self.spark.read.parquet(f"{self.place(layer, table)}/{REJECTED_COLUMN}={side}")

    def place(self, layer: str, table: str) -> str:
        """Folder of the current version of a replaced table."""
        found = self.spark.sql(f"SHOW TBLPROPERTIES {self.name(layer, table)} ('place')")
        return found.first()["value"]

    def remove_old_versions(self, layer: str, table: str) -> int:
        """Delete the versions of a replaced table other than the current one, and return how many.

        Not for use while another run writes the table, or for versions that are still read.
        """
        if not self.spark.catalog.tableExists(self.name(layer, table)):
            return 0
        path_of = self.spark._jvm.org.apache.hadoop.fs.Path
        current = path_of(self.place(layer, table))
        files = current.getFileSystem(self.spark._jsc.hadoopConfiguration())
        found = [status.getPath() for status in files.listStatus(current.getParent())]
        old = [path for path in found if path.getName() != current.getName()]
        for path in old:
            bucketed = self.name(layer, f"{table}__{path.getName()}")
            self.spark.sql(f"DROP TABLE IF EXISTS {bucketed}")
            files.delete(path, True)
        return len(old)

    def bucketed(
        self, layer: str, table: str, bucket_by: tuple[str, Sequence[int]], values: Sequence[int]
    ) -> DataFrame:
        """Rows with the given values of the bucketed column, read from their partitions only."""
        column, boundaries = bucket_by
        buckets = sorted({sum(b <= value for b in boundaries) for value in values})
        rows = self.spark.read.parquet(self.place(layer, table))
        picked = rows.filter(F.col(BUCKET_COLUMN).isin(*buckets) & F.col(column).isin(*values))
        return picked.select(*self.table(layer, table).columns)

    def create(
        self,
        layer: str,
        table: str,
        schema: T.StructType,
        comment: str = "",
        partition_by: str | None = None,
    ) -> None:
        """Create the table with this schema where it is missing, over the files already in its
        folder if the catalog is new."""
        name = self.name(layer, table)
        if self.spark.catalog.tableExists(name):
            return
        place = f"{self.root}/{layer}/{table}"
        partitioned = f" PARTITIONED BY (`{partition_by}`)" if partition_by else ""
        given = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in _encoding(layer).items())
        options = f" OPTIONS ({given})" if given else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({_column_list(schema, True)})"
            f" USING parquet{options}{partitioned} COMMENT {_quoted(comment)} LOCATION {_quoted(place)}"
        )
        if partition_by:
            # The folder must exist for the partitions in it to be found.
            nothing = self.spark.createDataFrame([], schema)
            nothing.write.mode("append").partitionBy(partition_by).parquet(place)
            self.spark.sql(f"ALTER TABLE {name} RECOVER PARTITIONS")

    def create_empty(self, layer: str, table: str, schema: T.StructType, comment: str = "") -> None:
        """Replace the table with an empty one of this schema."""
        self.replace(layer, table, self.spark.createDataFrame([], schema), comment)

    def add_columns(self, layer: str, table: str, fields: Sequence[T.StructField]) -> list[str]:
        """Add to a created table those of the columns that it lacks, and return their names; rows
        written before have NULL there."""
        known = {c.upper() for c in self.table(layer, table).columns}
        new = T.StructType([f for f in fields if f.name.upper() not in known])
        if new:
            added = _column_list(new, True)
            self.spark.sql(f"ALTER TABLE {self.name(layer, table)} ADD COLUMNS ({added})")
        return new.names

    def append(self, layer: str, table: str, rows: DataFrame) -> None:
        """Append to a created table, columns by position. Appends of one run wait for each other:
        writers that end at once would remove each other's files."""
        with self._appending:
            rows.write.insertInto(self.name(layer, table))

    def append_load(self, layer: str, table: str, rows: DataFrame, load_ts: dt.datetime) -> int:
        """Write one load of a history table and return how many rows it has.

        ``rows`` holds the table's columns by name, the load time among them or not. A load
        without rows leaves no partition, so the newest load is the newest with rows.
        """
        load = load_ts.astimezone(dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S.%f UTC")
        columns = [c for c in self.table(layer, table).columns if c != LOAD_COLUMN]
        written = Observation()
        load_rows = rows.select(*columns).observe(written, F.count(F.lit(1)).alias("rows"))
        self.spark.sql(
            f"INSERT OVERWRITE TABLE {self.name(layer, table)}"
            f" PARTITION (`{LOAD_COLUMN}` = TIMESTAMP '{load}') SELECT * FROM {{load_rows}}",
            load_rows=load_rows,
        )
        if not written.get["rows"]:
            self.spark.sql(
                f"ALTER TABLE {self.name(layer, table)}"
                f" DROP IF EXISTS PARTITION (`{LOAD_COLUMN}` = TIMESTAMP '{load}')"
            )
        return written.get["rows"]

    def latest(self, layer: str, table: str) -> DataFrame:
        """Rows of the newest load. The load is found in the catalog's list of partitions, without
        touching data files, and only its partition is read."""
        loads = self.spark.sql(f"SHOW PARTITIONS {self.name(layer, table)}").select(
            F.url_decode(F.substring_index("partition", "=", -1)).cast("timestamp").alias("load")
        )
        newest = loads.agg(F.max("load").cast("string").alias("load")).first()["load"]
        history = self.table(layer, table)
        return history.filter(F.col(LOAD_COLUMN) == F.lit(newest).cast("timestamp"))
