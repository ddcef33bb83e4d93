"""Materialising an intermediate result in the shared checkpoint folder."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import PySparkNotImplementedError
from pyspark.sql import DataFrame

from cohortlens.session import checkpoint_dir, delete_on_exit


def materialize(df: DataFrame, name: str = "layer") -> DataFrame:
    """Write ``df`` once as Parquet under ``spark.checkpoint.dir`` and read it back.

    Later steps read the written table (with column pruning and filter
    pushdown) instead of re-running the plan, and the lineage is cut: an
    executor loss does not replay the upstream joins. Unlike
    ``Dataset.checkpoint`` the plan is computed exactly once. The written
    layer is removed when the session ends (results that read it may be
    used until then).
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), "tables", f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").parquet(path)
    try:
        delete_on_exit(spark.sparkContext, path)
    except PySparkNotImplementedError:  # Spark Connect has no context; the folder's owner cleans it
        pass
    return spark.read.parquet(path)
