"""Tables of a registered query, in a scratch folder and namespace of their own."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ordstrata.session import scratch_folder
from ordstrata.sinks.tables import Lake


def new_lake(spark: SparkSession) -> Lake:
    folder = scratch_folder(spark)
    return Lake(spark, folder, namespace=folder.rsplit("/", 1)[-1].replace("-", "_"))
