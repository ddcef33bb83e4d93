"""Sinks and table layout.

Gold tables are written as Parquet under a base path (or as catalog tables).
The activity fact is laid out for the queries that read it: partitioned by
month (date-range filters prune whole folders) and, as a catalog table,
bucketed and sorted by intern so per-intern joins and aggregations over
two such tables need no shuffle.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.materialize import materialize


def write_tables(tables: dict[str, DataFrame], base: str, mode: str = "overwrite") -> dict[str, str]:
    """Full replace (``overwrite``) or ``append`` of each table. A
    failure of one table does not stop the others, but is raised at the end,
    so a half-written gold never looks like success."""
    written, errors = {}, []
    for name, df in tables.items():
        path = os.path.join(base, name)
        try:
            df.write.mode(mode).parquet(path)
            written[name] = path
        except Exception as e:  # noqa: BLE001 - collected and raised below
            errors.append(RuntimeError(f"table {name} was not written: {e}"))
    if errors:
        raise ExceptionGroup(f"{len(errors)} of {len(tables)} tables failed", errors)
    return written


def write_activity_layout(fact_activity: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Month partitions (partition pruning for date ranges). Rows are dealt
    by month and AQE splits large months, so one of any size is written by
    many tasks."""
    with_month = fact_activity.withColumn("activity_month", F.date_format("date", "yyyy-MM"))
    (with_month.hint("rebalance", "activity_month")
        .write.mode(mode).partitionBy("activity_month").parquet(path))


def save_bucketed(df: DataFrame, table: str, key: str = "intern_id", *, buckets: int,
                  sort_by: str | None = "date", mode: str = "overwrite") -> None:
    """Catalog table bucketed (and sorted) by ``key``: joins and
    aggregations on ``key`` between tables with equal bucket counts skip
    the shuffle. Choose ``buckets`` so that one holds a few hundred MB."""
    w = df.write.mode(mode).bucketBy(buckets, key)
    if sort_by and sort_by in df.columns:
        w = w.sortBy(sort_by)
    w.saveAsTable(table)


def export_by_course(lms: DataFrame, out_dir: str, course_col: str = "Course Name") -> None:
    """One folder per course plus the combined table."""
    lms = materialize(lms, "export")  # two writes, one run of the plan
    lms.write.mode("overwrite").partitionBy(course_col).option("header", True).csv(os.path.join(out_dir, "by_course"))
    lms.write.mode("overwrite").option("header", True).csv(os.path.join(out_dir, "combined"))


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict | None = None,
              partition_column: str | None = None, lower: int | None = None, upper: int | None = None,
              num_partitions: int = 8) -> DataFrame:
    """A database table scanned in parallel ranges of ``partition_column``
    (filters and projections are pushed into the database query)."""
    props = dict(properties or {})
    if partition_column is None:
        return spark.read.jdbc(url, table, properties=props)
    return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower, upperBound=upper,
                           numPartitions=num_partitions, properties=props)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", properties: dict | None = None) -> None:
    """S06 to a database: full replace of the table."""
    df.write.jdbc(url, table, mode=mode, properties=dict(properties or {}))


def load_or_build(spark: SparkSession, table: str, build) -> DataFrame:
    """The catalog table if it exists, else the result of ``build()``."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return build()
