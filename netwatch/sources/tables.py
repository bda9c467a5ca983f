"""Batch tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession


def load_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A parquet table ``<root>/<name>.parquet``; filters and column
    selection made later reach the scan. How finely it is split is the
    session's choice (``spark.sql.files.maxPartitionBytes``,
    ``spark.sql.files.minPartitionNum``)."""
    return spark.read.parquet(os.path.join(root, f"{name}.parquet"))
