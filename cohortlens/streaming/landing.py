"""Incremental landing of new files (ST1, B42).

The file stream source keeps a log of the files it has ingested in the
checkpoint, so re-running the landing adds nothing and a new file adds
only its own rows — the once-per-file guarantee the daily batch job
lacked. ``trigger(availableNow=True)`` processes whatever is new and stops,
so the same code runs from any scheduler. No state or watermark is needed:
every step is a per-row transformation or a stream-static join.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortlens.functions.dates import parse_date, utc_date
from cohortlens.functions.text import full_name
from cohortlens.plans.etl import silver_eod, silver_lms
from cohortlens.session import checkpoint_dir
from cohortlens.sources.files import EOD_SCHEMA, LMS_SCHEMA, read_files, read_sheets, split_rejects
from cohortlens.sources.tables import table_path

EVENTS_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType())])


def run_available(stream: DataFrame, sink: str, checkpoint: str, fmt: str = "parquet") -> None:
    """Process everything new once (availableNow) into an append-only sink."""
    q = (stream.writeStream.format(fmt).outputMode("append")
         .option("checkpointLocation", checkpoint).option("path", sink)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def land_sheets(spark: SparkSession, source_dir: str, sink: str, checkpoint: str, kind: str = "eod") -> None:
    """ST1 for CSV sheets dropped into ``source_dir``, columns bound by header.

    The stream's log decides which files are new; each batch reads its files
    by name and writes them to ``sink/batch_id=<n>``, which a retry of the
    batch overwrites. Lines that do not fit go to ``<sink>_rejects``."""
    schema = EOD_SCHEMA if kind == "eod" else LMS_SCHEMA

    def land(batch: DataFrame, batch_id: int) -> None:
        s = batch.sparkSession
        files = [r[0] for r in batch.select(F.input_file_name()).distinct().collect()]  # the batch's file names
        raw = read_files(s, sorted(files), schema)
        if raw is None:
            return
        good, bad = split_rejects(raw)
        good = good.withColumn("row_id", F.lit(None).cast("long"))
        clean = silver_eod(good) if kind == "eod" else silver_lms(good)
        clean.write.mode("overwrite").parquet(os.path.join(sink, f"batch_id={batch_id}"))
        bad.write.mode("overwrite").parquet(os.path.join(f"{sink}_rejects", f"batch_id={batch_id}"))

    q = (spark.readStream.text(source_dir).writeStream.foreachBatch(land)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))


def eod_stream_from_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The activity log as a stream: events rows joined (stream-static) to
    the customer names, cleaned like an EOD sheet."""
    # The file source watches a directory (or glob); the table is one file,
    # so it is named as a single-file glob under its folder.
    src = table_path(sf_dir, "events")
    if src.endswith(".parquet"):
        src = src[:-1] + "[t]"
    ev = spark.readStream.schema(EVENTS_SCHEMA).option("basePath", os.path.dirname(src)).parquet(src)
    cust = spark.read.parquet(table_path(sf_dir, "customer")).select("c_custkey", "c_name")
    j = ev.join(cust, ev.user_id == cust.c_custkey, "left")
    first = F.split_part(F.col("c_name"), F.lit("#"), F.lit(1))
    last = F.concat(F.split_part(F.col("c_name"), F.lit("#"), F.lit(2)), F.lit(" "))
    return j.select(
        F.col("event_id").alias("row_id"),
        parse_date(F.date_format(utc_date("ts"), "dd/MM/yyyy")).alias("date"),
        full_name(first, last).alias("full_name"),
        F.col("event_type").alias("activity"), F.col("value").cast("double").alias("hours"))


def landed_activity(spark: SparkSession, sf_dir: str, run_dir: str | None = None) -> DataFrame:
    """ST1 end to end on the bound data: stream the events table into a
    landing table under the shared checkpoint folder, then read the table."""
    base = run_dir or os.path.join(checkpoint_dir(spark), "landing", uuid.uuid4().hex)
    sink, ckpt = os.path.join(base, "eod_activity"), os.path.join(base, "_checkpoint")
    run_available(eod_stream_from_events(spark, sf_dir), sink, ckpt)
    return spark.read.parquet(sink)


def daily_batch(spark: SparkSession, lms_glob: str, eod_glob: str, base: str, count: bool = True) -> dict[str, int]:
    """B42 as a batch job: read every matching sheet (combined by name),
    clean and append to the landing tables; lines that do not fit their header
    go to ``<table>_rejects``. Not idempotent by itself (a
    re-run appends again); ``land_sheets`` is the incremental form."""
    counts = {}
    for kind, glob, schema, clean in (("lms_submissions", lms_glob, LMS_SCHEMA, silver_lms),
                                      ("eod_activity", eod_glob, EOD_SCHEMA, silver_eod)):
        df = read_sheets(spark, glob, schema)
        if df is None:
            counts[kind] = 0
            continue
        good, bad = split_rejects(df)
        clean(good.withColumn("row_id", F.lit(None).cast("long"))).write.mode("append").parquet(os.path.join(base, kind))
        bad.write.mode("append").parquet(os.path.join(base, f"{kind}_rejects"))
        counts[kind] = spark.read.parquet(os.path.join(base, kind)).count() if count else -1
    return counts


def export_and_land(g, kind: str = "eod") -> DataFrame:
    """B42 end to end on the bound data: the bronze sheet is exported as CSV
    files (S08) into the shared checkpoint folder, read back combined by
    header (S02), cleaned and appended to a landing table, which is returned.
    Every row of the given tables goes through the round trip."""
    spark = g.spark
    base = os.path.join(checkpoint_dir(spark), "sheets", uuid.uuid4().hex)
    lms_dir, eod_dir = os.path.join(base, "lms"), os.path.join(base, "eod")
    if kind == "eod":
        g.bronze_eod.drop("row_id").write.option("header", True).csv(eod_dir)
    else:
        g.bronze_lms.drop("row_id", "ingest_date").write.option("header", True).csv(lms_dir)
    daily_batch(spark, os.path.join(lms_dir, "*.csv"), os.path.join(eod_dir, "*.csv"), os.path.join(base, "landing"),
                count=False)
    table = "eod_activity" if kind == "eod" else "lms_submissions"
    return spark.read.parquet(os.path.join(base, "landing", table)).drop("row_id", "source_file")
