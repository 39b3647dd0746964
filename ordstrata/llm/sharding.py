"""Contiguous shards of nearly equal bytes from global prefix sums."""

from __future__ import annotations

from functools import reduce
from itertools import accumulate
from operator import add

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ordstrata.llm.common import stored

ROW_BYTES = 16


def shard_by_bytes(
    docs: DataFrame, n_shards: int = 40, max_group_share: float = 0.1
) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every row of ``docs`` (doc_id, text).

    Rows are range-sorted by (hash of the text, doc_id), which puts equal texts side by side.
    Every range partition sums its bytes; the sums of the partitions before it turn running sums
    into global ones, and the line of bytes is cut at equal targets. A cut that falls among rows
    of equal text moves to the nearer end of them, if they hold at most ``max_group_share`` of a
    shard; larger groups are cut between two rows. Law: every shard's bytes are within one row, or
    half such a group at either end, of the target. A third of all rows with one text is spread,
    since doc_id orders them.

    A null text has size 16 and the checksum of empty text. Repeated rows each get a place; rows
    without doc_id count like others. An empty table gives no rows. Further columns are not read.
    """
    rows = stored(
        docs.select(
            "doc_id",
            (F.coalesce(F.octet_length("text"), F.lit(0)) + ROW_BYTES).cast("long").alias("size"),
            F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
            F.xxhash64("text").alias("group"),
        )
    )
    rows = stored(
        rows.repartitionByRange("group", "doc_id").withColumn("part", F.spark_partition_id())
    )
    # One row per partition, not per document.
    totals = sorted(
        rows.groupBy("part").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()
    )
    spark = docs.sparkSession
    bytes_before = [0, *accumulate(t.b for t in totals)]
    rows_before = [0, *accumulate(t.n for t in totals)]
    offsets = spark.createDataFrame(
        [(t.part, b, n) for t, b, n in zip(totals, bytes_before, rows_before)],
        "part int, bytes_before long, rows_before long",
    )
    inside = Window.partitionBy("part").orderBy("group", "doc_id")
    placed = stored(
        rows.withColumns(
            {
                "upto": F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, 0)),
                "nth": F.row_number().over(inside),
            }
        )
        .join(offsets, "part")
        .select(
            "doc_id",
            "size",
            "text_crc32",
            "group",
            (F.col("bytes_before") + F.col("upto") - F.col("size")).alias("start"),
            (F.col("rows_before") + F.col("nth") - 1).alias("index"),
        )
    )
    cuts = _cuts(placed, bytes_before[-1], n_shards, max_group_share)
    middle = F.col("start") + F.col("size") / 2
    shard = reduce(add, [(middle >= c).cast("int") for c in cuts], F.lit(0))
    sharded = placed.withColumn("shard", shard)
    first = sharded.groupBy("shard").agg(F.min("index").alias("first")).collect()
    first_of = reduce(
        lambda found, r: found.when(F.col("shard") == r.shard, F.lit(r.first)),
        first,
        F.when(F.lit(False), F.lit(0).cast("long")),
    )
    return sharded.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("index") - first_of).alias("slot")
    )


def _cuts(placed: DataFrame, total: int, n_shards: int, max_group_share: float) -> list[int]:
    """The byte positions at which shards 1 to ``n_shards`` - 1 begin."""
    cuts = {k: k * total // n_shards for k in range(1, n_shards)}
    groups = placed.groupBy("group").agg(
        F.min("start").alias("begin"), F.sum("size").alias("bytes")
    )
    end = F.col("begin") + F.col("bytes")
    # Groups that hold a target: no more of them than there are targets.
    crossing = groups.filter(
        F.floor(F.col("begin") * n_shards / F.lit(max(total, 1)))
        < F.floor(end * n_shards / F.lit(max(total, 1)))
    ).collect()
    for group in crossing:
        if group.bytes <= max_group_share * total / n_shards:
            for k, cut in cuts.items():
                if group.begin < cut < group.begin + group.bytes:
                    late = 2 * (cut - group.begin) > group.bytes
                    cuts[k] = group.begin + (group.bytes if late else 0)
    return sorted(cuts.values())
