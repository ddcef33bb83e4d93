"""Daily and weekly hours kept current by a stateful stream (ST1, A03, A07).

The activity log streams in with an event-time watermark. A repeated event is
dropped while its first copy is within the watermark; hours are summed in
windows of a day, and the days into ISO weeks, and a window is appended to its
table when the watermark has passed its end. What is not closed yet lies in
the stream's state, which is read as a table: closed windows and open ones
together are the current view, exactly the batch result, as long as no row
comes later than the watermark allows. State holds the open windows and the
event ids of the watermark's span, however long the stream runs.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.dates import iso_week, iso_year
from cohortlens.functions.numeric import SUM_DECIMALS, finite
from cohortlens.plans.common import Params
from cohortlens.session import checkpoint_dir, delete_on_exit
from cohortlens.sources.tables import table_path
from cohortlens.streaming.landing import EVENTS_SCHEMA

DELAY = "31 days"  # how late a row may be
_MONDAY = "4 days"  # 1970-01-05, from which weeks are counted


def _units(c) -> F.Column:
    """Hours as a whole number of 1e-7, so sums do not depend on the order."""
    v = finite(c)
    whole = F.floor(v)
    return (whole.cast("decimal(17,0)") * F.lit(10 ** SUM_DECIMALS).cast("decimal(9,0)")
            + F.rint((v - whole) * float(10 ** SUM_DECIMALS)).cast("decimal(9,0)")).cast("decimal(28,0)")


def _hours(units) -> F.Column:
    return (units.cast("decimal(31,0)") * F.lit("0.0000001").cast("decimal(7,7)")).cast("double")


def _instant(ts) -> F.Column:
    """The wall-clock time read as UTC, whatever the session's time zone; a
    watermark needs an instant."""
    ts = F.col(ts)
    return F.timestamp_seconds(F.unix_date(F.to_date(ts)).cast("long") * 86400 + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def _first_day(window: str) -> F.Column:
    return F.date_from_unix_date((F.unix_seconds(F.col(window).getField("start")) / 86400).cast("int"))


def effort_stream(events: DataFrame, grain: str = "day", delay: str = DELAY) -> DataFrame:
    """(intern_id, window, units) of a stream with event_id, ts, user_id, value."""
    e = events.select("event_id", _instant("ts").alias("ts"), F.col("user_id").alias("intern_id"), _units("value").alias("units"))
    e = e.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"])
    days = e.groupBy(F.window("ts", "1 day").alias("window"), "intern_id").agg(F.sum("units").alias("units"))
    if grain == "day":
        return days
    week = F.window(F.window_time("window"), "7 days", "7 days", _MONDAY).alias("window")
    return days.groupBy(week, "intern_id").agg(F.sum("units").alias("units"))


def run_effort(spark: SparkSession, source: str, base: str, grain: str = "day", delay: str = DELAY,
               files_per_trigger: int | None = None) -> list[dict]:
    """Take in what is new at ``source`` (Parquet files of events) and append
    the windows that it closes. Run again, from any scheduler, it goes on from
    its checkpoint. Returns the progress of the micro-batches, which counts
    the state's rows and those that came too late."""
    r = spark.readStream.schema(EVENTS_SCHEMA).option("basePath", os.path.dirname(source))
    if files_per_trigger:
        r = r.option("maxFilesPerTrigger", files_per_trigger)
    days = effort_stream(r.parquet(source), grain, delay)
    closed = days.select("intern_id", _first_day("window").alias("date"), "units")
    q = (closed.writeStream.format("parquet").outputMode("append").option("path", os.path.join(base, "closed"))
         .option("checkpointLocation", os.path.join(base, "checkpoint")).trigger(availableNow=True).start())
    q.awaitTermination()
    return list(q.recentProgress)


def _open_windows(spark: SparkSession, base: str, nth: int) -> DataFrame:
    """The windows of the nth sum of the plan, counted from its end, that wait in the state."""
    ck = os.path.join(base, "checkpoint")
    sums = sorted(r.operatorId for r in spark.read.format("state-metadata").load(ck).select("operatorId", "operatorName").distinct().collect()
                  if r.operatorName == "stateStoreSave")  # a row for each operator of the plan
    s = spark.read.format("statestore").option("operatorId", sums[nth]).load(ck)
    return s.select(F.col("key.intern_id").alias("intern_id"), _first_day("key.window").alias("date"),
                    F.when(~F.col("value.isEmpty"), F.col("value.sum")).cast("decimal(38,0)").alias("units"))


def current_effort(spark: SparkSession, base: str, grain: str = "day") -> DataFrame:
    """(intern_id, date, hours): closed windows and open ones; ``date`` is the
    window's first day. A week still open also gets its days that are open."""
    closed = spark.read.schema("intern_id long, date date, units decimal(38,0)").parquet(os.path.join(base, "closed"))
    now = closed.unionByName(_open_windows(spark, base, 0))
    if grain == "week":
        days = _open_windows(spark, base, 1)
        now = now.unionByName(days.withColumn("date", F.date_trunc("week", "date").cast("date")))
    # One row a window, but for weeks that have open days besides.
    return now.groupBy("intern_id", "date").agg(_hours(F.sum("units")).alias("hours"))


def _run_dir(spark: SparkSession) -> str:
    base = os.path.join(checkpoint_dir(spark), "effort", uuid.uuid4().hex)
    delete_on_exit(spark.sparkContext, base)
    return base


def _source(sf_dir: str) -> str:
    src = table_path(sf_dir, "events")  # a pattern: the source wants a folder or one
    return f"{src[:-1]}[{src[-1]}]"


def streamed_outlier_days(spark: SparkSession, sf_dir: str, p: Params | None = None) -> DataFrame:
    """A03 from the stream: daily totals per intern with the outlier flag."""
    base = _run_dir(spark)
    run_effort(spark, _source(sf_dir), base, "day")
    return current_effort(spark, base, "day").withColumn("is_outlier", F.col("hours") > F.lit((p or Params()).outlier_hours))


def streamed_weekly_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A07 from the stream: hours per intern and ISO week of a year."""
    base = _run_dir(spark)
    run_effort(spark, _source(sf_dir), base, "week")
    w = current_effort(spark, base, "week")
    return w.select("intern_id", iso_year("date").alias("iso_year"), iso_week("date").alias("week"), "hours")
