"""The activity fact clustered by intern and date at once.

Folders by month help a date range but not one intern, buckets by intern the
reverse. Here each row gets a cell: its position among the quantiles of
intern_id and of date, bits interleaved. Files are ranges of cells, so each
holds few interns and few days; a small file index (bounds of both columns per
file) tells a reader which files a range needs, and Parquet's statistics and
Bloom filters on intern_id skip row groups inside them.
"""

from __future__ import annotations

import os
from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BITS = 8  # 256 quantiles a column, so at most 255 bounds reach the driver
DAY = "_day"


def _position(c: Column, bounds: Sequence[float]) -> Column:
    """How many bounds are at or below the value; null counts as 0."""
    if not bounds:
        return F.lit(0)
    inside = F.array(*[F.lit(float(b)) for b in bounds])
    return F.coalesce(F.size(F.filter(inside, lambda b: b <= c)), F.lit(0))


def interleave(a: Column, b: Column, bits: int = BITS) -> Column:
    """The bits of ``a`` and ``b`` in turn, those of ``a`` first."""
    out = F.lit(0)
    for i in range(bits):
        for c, at in ((a, 2 * i + 1), (b, 2 * i)):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c, i).bitwiseAND(F.lit(1)), at))
    return out


def write_clustered(facts: DataFrame, path: str, files: int, error: float = 0.002) -> DataFrame:
    """Write ``facts`` (intern_id, date, ...) in about ``files`` files and
    return the file index. An intern or a day with a large share of the rows
    is split by the other column, and one cell by a hash of the row, so no
    file grows with it. Rows with a null intern or date are kept; no range
    asks for them, so the index leaves them out of its bounds."""
    spark = facts.sparkSession
    numbered = facts.withColumn(DAY, F.unix_date("date").cast("double"))
    probs = [k / 2 ** BITS for k in range(1, 2 ** BITS)]
    keys = numbered.select(F.col("intern_id").cast("double").alias("_i"), DAY)
    bounds = [sorted(set(b)) for b in keys.approxQuantile(["_i", DAY], probs, error)]
    cell = interleave(_position(F.col("intern_id").cast("double"), bounds[0]), _position(F.col(DAY), bounds[1]))
    placed = numbered.withColumn("_cell", cell).withColumn("_salt", F.xxhash64(*facts.columns)).drop(DAY)
    rows = os.path.join(path, "rows")
    (placed.repartitionByRange(files, "_cell", "_salt").sortWithinPartitions("_cell", "intern_id", "date").drop("_cell", "_salt")
     .write.option("parquet.bloom.filter.enabled#intern_id", "true").parquet(rows))
    index = spark.read.parquet(rows).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min("intern_id").alias("min_intern"), F.max("intern_id").alias("max_intern"),
        F.min("date").alias("min_date"), F.max("date").alias("max_date"))
    index.coalesce(1).write.parquet(os.path.join(path, "index"))
    return read_index(spark, path)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(os.path.join(path, "index"))


def _filters(interns: tuple[int, int] | None, dates: tuple[str, str] | None) -> list[tuple[str, Column, Column]]:
    out = []
    if interns is not None:
        out.append(("intern", F.lit(interns[0]), F.lit(interns[1])))
    if dates is not None:
        out.append(("date", *[F.lit(date.fromisoformat(d)) for d in dates]))
    return out


def files_for(index: DataFrame, interns: tuple[int, int] | None = None, dates: tuple[str, str] | None = None) -> DataFrame:
    """The files whose bounds meet both ranges (ends included)."""
    for name, lo, hi in _filters(interns, dates):
        index = index.where((F.col(f"min_{name}") <= hi) & (F.col(f"max_{name}") >= lo))
    return index


def read_clustered(spark: SparkSession, path: str, interns: tuple[int, int] | None = None,
                   dates: tuple[str, str] | None = None) -> DataFrame:
    """The rows in both ranges, out of the files that can hold them. The names
    of these files are what the driver lists for any table that it reads."""
    everything = spark.read.parquet(os.path.join(path, "rows"))
    out = everything
    if interns is not None or dates is not None:
        files = [r.file for r in files_for(read_index(spark, path), interns, dates).select("file").collect()]
        out = spark.read.schema(everything.schema).parquet(*files) if files else everything.limit(0)
    for name, lo, hi in _filters(interns, dates):
        out = out.where(F.col("intern_id" if name == "intern" else name).between(lo, hi))
    return out
