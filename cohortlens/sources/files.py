"""File sources for the raw sheets.

Spark's CSV reader binds columns by position when one schema is applied to
many files; the sheets must be combined by *name*. Files are therefore
grouped by their header line (read by a Spark job) and each group is read in one scan;
groups are combined with ``unionByName(allowMissingColumns=True)``.
"""

from __future__ import annotations

import csv
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.operators.materialize import materialize

# The sheet layouts, all read as strings at bronze.
LMS_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in (
    "User Name", "Course Name", "Start Date", "End Date", "Mentor Name", "Progress (%)",
    "Completed Assignment", "Reviewed / Submitted", "Overall Knowledge Check", "Overall Test",
    "Reviewed / Total Assignments", "Overall Status")])
EOD_SCHEMA = T.StructType([
    T.StructField("Date", T.StringType()), T.StructField("First Name", T.StringType()),
    T.StructField("Last Name", T.StringType()), T.StructField("Activity", T.StringType()),
    T.StructField("Hours", T.DoubleType())])


def _fs_and_paths(spark: SparkSession, pattern: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(conf)
    statuses = fs.globStatus(path) or []
    return fs, [s.getPath() for s in statuses if s.isFile()]


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Glob on any Hadoop file system (driver-side listing only)."""
    _, paths = _fs_and_paths(spark, pattern)
    return sorted(p.toString() for p in paths)


def _headers(spark: SparkSession, files: list[str]) -> dict[str, list[str]]:
    """Header line -> files, read by a Spark job (one short row per file)."""
    lines = spark.read.text(files).select(F.col("_metadata.file_path").alias("file"),
                                          F.col("_metadata.file_block_start").alias("start"), "value")
    first = (lines.where(F.col("start") == 0).withColumn("i", F.monotonically_increasing_id())
             .groupBy("file").agg(F.min_by("value", "i").alias("header")))
    groups: dict[str, list[str]] = defaultdict(list)
    for r in first.collect():
        groups[r["header"].lstrip("\ufeff")].append(r["file"])
    return groups


CORRUPT = "_corrupt_record"


def read_files(spark: SparkSession, files: list[str], schema: T.StructType | None = None) -> DataFrame | None:
    """CSV files combined by column name. A line that does not fit its header
    (too many or too few cells, a cell of the wrong type) keeps its text in
    ``_corrupt_record``; see ``split_rejects``."""
    out = None
    for header, group in sorted(_headers(spark, files).items()) if files else []:
        names = [c.strip().strip('"') for c in next(csv.reader([header]))]
        fields = {f.name: f for f in schema.fields} if schema is not None else {}
        typed = T.StructType([*[fields.get(n, T.StructField(n, T.StringType())) for n in names], T.StructField(CORRUPT, T.StringType())])
        df = (spark.read.option("header", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
              .schema(typed).csv(group).withColumn("source_file", F.input_file_name()))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is not None and schema is not None:
        for f in schema.fields:
            if f.name not in out.columns:
                out = out.withColumn(f.name, F.lit(None).cast(f.dataType))
    return out


def read_sheets(spark: SparkSession, pattern: str, schema: T.StructType | None = None) -> DataFrame | None:
    """Every CSV matching ``pattern``, combined by column name. Returns
    None when nothing matches (S03: an absent source is not an error). Each
    row keeps its file name as lineage; a file that cannot be read fails the
    job rather than losing rows."""
    return read_files(spark, list_files(spark, pattern), schema)


def split_rejects(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejects): rejects are (source_file, line) of the lines that
    did not fit. The parsed rows are written once and read by both."""
    df = materialize(df, "sheets")
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.where(F.col(CORRUPT).isNotNull()).select("source_file", F.col(CORRUPT).alias("line"))


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """A typed empty frame for an absent optional source."""
    return spark.createDataFrame([], schema)


def read_optional(spark: SparkSession, pattern: str, schema: T.StructType) -> DataFrame:
    df = read_sheets(spark, pattern, schema)
    return df if df is not None else empty_like(spark, schema)
