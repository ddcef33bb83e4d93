"""Reading the shared parquet tables."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table_path(sf_dir: str, name: str) -> str:
    p = os.path.join(sf_dir, f"{name}.parquet")
    return p if os.path.exists(p) or "://" in sf_dir else os.path.join(sf_dir, name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it. Scan
    parallelism follows the row groups and ``spark.sql.files.maxPartitionBytes``."""
    return spark.read.parquet(table_path(sf_dir, name))
