"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import SparkSession

# What the plans rely on: strict casts, one time zone, run-time re-planning with skew splitting.
# HotSpot never compiles methods above 8,000 bytes of code, so larger fused stages run unfused.
SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Spark from 4.1 on deletes the shuffle files of a query when it ends; others do not know the setting.
DROP_SHUFFLE_FILES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_turn = Lock()
_inside: dict[str, tuple[int, str | None]] = {}  # by session: how many, and the setting before


def build_session(
    app_name: str = "ordstrata",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """A session with :data:`SETTINGS`.

    ``shuffle_partitions`` is the number AQE starts from before it merges small partitions: take
    a few times the executor cores, and at least shuffled bytes / 128 MB, on a cluster.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder for written intermediate tables, below ``spark.checkpoint.dir``.

    A local folder is taken only where that setting is absent and the session runs in one process;
    on a cluster every executor must see the folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        shared = tempfile.mkdtemp(prefix="run-")
    return f"{shared.rstrip('/')}/ordstrata-{uuid.uuid4().hex}"


@contextmanager
def shuffle_files_dropped(spark: SparkSession) -> Iterator[None]:
    """Queries that begin in here delete their shuffle files when they end.

    Otherwise the files stay until the driver happens to collect its garbage, and those of a whole
    job pile up. Meant for writes: a DataFrame whose own plan has been run in here makes its shuffles
    again when it is run once more. Several threads may be inside; the session's own setting comes
    back when the last one leaves.
    """
    key = spark._jsparkSession.sessionUUID()
    with _turn:
        n, before = _inside.get(key) or (0, spark.conf.get(DROP_SHUFFLE_FILES, None))
        spark.conf.set(DROP_SHUFFLE_FILES, "true")
        _inside[key] = (n + 1, before)
    try:
        yield
    finally:
        with _turn:
            n, before = _inside.pop(key)
            if n > 1:
                _inside[key] = (n - 1, before)
            elif before is None:
                spark.conf.unset(DROP_SHUFFLE_FILES)
            else:
                spark.conf.set(DROP_SHUFFLE_FILES, before)
