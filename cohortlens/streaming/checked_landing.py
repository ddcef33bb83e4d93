"""Landing with its checks taken on the way.

The additive checks of a sheet (counts of rows that break a rule) are observed
by the write that lands it: no second scan of the sheet or of the table. Every
batch leaves one row per check beside its rows; since counts add up, the state
of the whole table is the sum over the batches, and a check of any batch or
range of batches costs a read of a few rows.

A batch is written to its own folder, rows first and checks after them; landing
it again replaces both. Checks that need the whole table (distinct names,
duplicates, orphans) are not additive and stay in ``etl.quality_report``.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.dates import parse_date
from cohortlens.functions.numeric import parse_percent, unsummable
from cohortlens.plans.common import STATUS_VALUES
from cohortlens.plans.etl import silver_eod, silver_lms
from cohortlens.session import checkpoint_dir, delete_on_exit
from cohortlens.sources.bindings import Gold

PROGRESS, START, END = 1, 2, 4       # bits of ``unparsed``: cells with a text that does not parse
DAY = 1


def _bit(raw: str, parsed: Column, bit: int) -> Column:
    return F.when(F.col(raw).isNotNull() & parsed.isNull(), F.lit(bit)).otherwise(F.lit(0))


def _flagged(bronze: DataFrame, kind: str) -> DataFrame:
    """The cleaned sheet with ``unparsed``, the bits of cells that do not parse."""
    if kind == "eod":
        return silver_eod(bronze.withColumn("unparsed", _bit("Date", parse_date(F.col("Date")), DAY)))
    return silver_lms(bronze.withColumn("unparsed", (
        _bit("Progress (%)", parse_percent(F.col("Progress (%)")), PROGRESS)
        + _bit("Start Date", parse_date(F.col("Start Date")), START) + _bit("End Date", parse_date(F.col("End Date")), END))))


def _outside(c: str, low: float, high: float) -> Column:
    return F.count_if(~F.coalesce(F.col(c).between(low, high), F.lit(False)))


def checks_of(kind: str) -> dict[str, Column]:
    """The additive checks of a sheet, by name. A null is outside any range."""
    has = lambda bit: F.count_if(F.col("unparsed").bitwiseAND(F.lit(bit)) != 0)
    if kind == "eod":
        return {"rows": F.count(F.lit(1)), "unnamed": F.count_if(F.col("full_name").isNull()),
                "undated": F.count_if(F.col("date").isNull()), "unparsed_date": has(DAY),
                "negative_hours": F.count_if(F.col("hours") < 0), "hours_outside": _outside("hours", 0.0, 10.0),
                "unsummable_hours": unsummable("hours")}
    return {"rows": F.count(F.lit(1)), "unnamed": F.count_if(F.col("intern_name").isNull()),
            "unparsed_progress": has(PROGRESS), "unparsed_start": has(START), "unparsed_end": has(END),
            "progress_above_100": F.count_if(F.col("progress") > 100), "progress_outside": _outside("progress", 0.0, 100.0),
            "unknown_status": F.count_if(~F.col("overall_status").isin(*STATUS_VALUES)),
            "completed_below_30": F.count_if((F.col("overall_status") == "Completed") & (F.col("progress") < 30))}


def land(bronze: DataFrame, kind: str, base: str, batch: int) -> dict[str, int]:
    """Clean and land one batch of a sheet (``kind`` 'lms' or 'eod') under
    ``base`` and return its checks, which are stored beside it."""
    spark = bronze.sparkSession
    seen = Observation()
    checks = checks_of(kind)
    rows = _flagged(bronze, kind).observe(seen, *[c.alias(name) for name, c in checks.items()])
    rows.drop("unparsed").write.mode("overwrite").parquet(os.path.join(base, kind, f"batch_id={batch}"))
    found = {name: int(seen.get.get(name) or 0) for name in checks}   # a write of no partition observes nothing
    spark.createDataFrame(list(found.items()), "check string, n long").coalesce(1).write.mode("overwrite").parquet(
        os.path.join(base, "checks", f"sheet={kind}", f"batch_id={batch}"))
    return found


def stored_checks(spark: SparkSession, base: str) -> DataFrame:
    """sheet, batch_id, check, n: one row per landed batch and check."""
    return spark.read.parquet(os.path.join(base, "checks")).select("sheet", "batch_id", "check", "n")


def table_checks(spark: SparkSession, base: str) -> DataFrame:
    """The checks of the whole landing tables: the sums over their batches."""
    return stored_checks(spark, base).groupBy("sheet", "check").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("batches"))


def landing_checks(g: Gold, cutoff: str = "1998-01-01") -> DataFrame:
    """B03 / B40 on the bound data: the LMS sheet landed in two batches (before
    ``cutoff`` and from then on), the EOD sheet in one, and the checks that the
    writes observed."""
    spark = g.bronze_eod.sparkSession
    base = os.path.join(checkpoint_dir(spark), "tables", f"checked-{uuid.uuid4().hex}")
    delete_on_exit(spark.sparkContext, base)
    early = F.col("ingest_date") < F.lit(cutoff).cast("date")
    land(g.bronze_lms.where(early), "lms", base, 0)
    land(g.bronze_lms.where(~early), "lms", base, 1)
    land(g.bronze_eod, "eod", base, 0)
    return table_checks(spark, base)
