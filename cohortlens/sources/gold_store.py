"""Stored gold: build the star schema once, then let every query read it.

``queries()`` derive gold from the raw tables on each call (the benchmark
contract). A deployment writes gold once per load (S06) and binds the
stored tables with ``Gold.from_path``: dimension joins then read small
tables, the activity fact is pruned by month partitions, and the derivation
joins (orders x lineitem, customer x nation x region) are not repeated.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.sources.bindings import Gold

GOLD_TABLES = ("fact_lms", "fact_activity", "dim_intern", "dim_course", "intern_mentors")


def write_gold(g: Gold, base: str, mode: str = "overwrite") -> dict[str, str]:
    """Write the gold tables under ``base``; the activity fact is partitioned
    by month so date-range queries read only the months they need."""
    out = {}
    for name in GOLD_TABLES:
        df: DataFrame = getattr(g, name)
        path = os.path.join(base, name)
        if name == "fact_activity":
            (df.withColumn("activity_month", F.date_format("date", "yyyy-MM"))
               .write.mode(mode).partitionBy("activity_month").parquet(path))
        else:
            df.write.mode(mode).parquet(path)
        out[name] = path
    return out


def gold_from_path(spark: SparkSession, base: str) -> Gold:
    """Bind stored gold tables (written by ``write_gold``) to the roles."""
    frames = {name: spark.read.parquet(os.path.join(base, name)) for name in GOLD_TABLES}
    frames["fact_activity"] = frames["fact_activity"].drop("activity_month")
    return Gold.from_frames(spark, **frames)
