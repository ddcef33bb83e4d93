"""Stored range sums and mergeable streaks (W02, F05, C10 over any dates).

Days are grouped into aligned blocks of 1, 8, 64, 512 and 4 096 days. For each
intern and block that has a log, one stored row holds what adds up over days:
exact hours, logged and active days, best day, first and last day, and a
summary of the runs of consecutive active days (run at the block's start, run
at its end, longest run). Such rows merge in date order, so

* a block is made of at most eight rows of the level below: an intern with a
  long history is built in many small groups, never sorted whole;
* any date range is covered by at most 14 blocks a level, found by arithmetic;
  a query reads the rows of these blocks and not the facts.
"""

from __future__ import annotations

import os
import uuid
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.dates import inclusive_days
from cohortlens.functions.numeric import exact_sum, join_parts, sum_parts
from cohortlens.plans.common import Params
from cohortlens.session import checkpoint_dir, delete_on_exit
from cohortlens.sources.bindings import Gold

FANOUT, LEVELS = 8, 5
SUMS = ("whole", "part", "logged_days", "active_days")
EPOCH = date(1970, 1, 1).toordinal()


def day_number(text: str) -> int:
    return date.fromisoformat(text).toordinal() - EPOCH


def cover(first: int, last: int) -> list[tuple[int, int, int]]:
    """The aligned blocks that make up the days ``first`` to ``last``, as
    (level, first block, last block); at most 2 * (FANOUT - 1) blocks a level
    below the top."""
    out: list[tuple[int, int, int]] = []
    at = first
    while at <= last:
        level = max(k for k in range(LEVELS) if at % FANOUT ** k == 0 and at + FANOUT ** k - 1 <= last)
        block = at // FANOUT ** level
        if out and out[-1][0] == level and out[-1][2] == block - 1:
            out[-1] = (level, out[-1][1], block)
        else:
            out.append((level, block, block))
        at += FANOUT ** level
    return out


def covers(first: int, last: int) -> Column:
    """Whether a stored row (``level``, ``block``) is one of the blocks that make
    up the days ``first`` to ``last``."""
    wanted = F.lit(False)
    for level, a, b in cover(first, last):
        wanted = wanted | ((F.col("level") == level) & F.col("block").between(a, b))
    return wanted


def _runs(start: Column) -> Column:
    """The pieces of a group merged in date order, from day ``start``: days
    without a piece are not active. A run that reaches a piece's end goes on
    in the next one if that begins on the next day."""
    pieces = F.array_sort(F.collect_list(F.struct("start", "days", "prefix", "suffix", "longest")))
    zero = F.lit(0)
    begin = F.struct(start.cast("int").alias("end"), zero.alias("prefix"), zero.alias("suffix"), zero.alias("longest"))

    def add(s: Column, c: Column) -> Column:
        before = F.when(c["start"] == s["end"], s["suffix"]).otherwise(zero)
        unbroken = s["prefix"] == c["start"] - start.cast("int")  # active on every day so far
        return F.struct(
            (c["start"] + c["days"]).alias("end"),
            (s["prefix"] + F.when(unbroken, c["prefix"]).otherwise(zero)).alias("prefix"),
            (c["suffix"] + F.when(c["prefix"] == c["days"], before).otherwise(zero)).alias("suffix"),
            F.greatest(s["longest"], c["longest"], before + c["prefix"]).alias("longest"))

    return F.aggregate(pieces, begin, add)


def _merged(start: Column) -> list[Column]:
    return [*[F.sum(c).alias(c) for c in SUMS], F.max("best_day").alias("best_day"),
            F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day"), _runs(start).alias("runs")]


def days_of(facts: DataFrame) -> DataFrame:
    """Level 0: one row per intern and day with a log. The facts are added up
    before the shuffle, so a hot intern costs a row a day and partition."""
    whole, part = sum_parts("hours")
    per = facts.where(F.col("date").isNotNull()).groupBy("intern_id", "date").agg(
        F.sum(whole).alias("whole"), F.sum(part).alias("part"), exact_sum("hours").alias("best_day"))
    active = F.when(F.col("best_day") > 0, 1).otherwise(0)
    day = F.unix_date("date")
    return per.select("intern_id", day.alias("block"), day.alias("start"), F.lit(1).alias("days"), "whole", "part",
                      F.lit(1).cast("bigint").alias("logged_days"), active.cast("bigint").alias("active_days"), "best_day",
                      day.alias("first_day"), day.alias("last_day"), active.alias("prefix"), active.alias("suffix"), active.alias("longest"))


def parents_of(rows: DataFrame, level: int) -> DataFrame:
    """The blocks of ``level`` out of those of the level below."""
    width = FANOUT ** level
    start = F.col("block") * width
    merged = rows.withColumn("block", F.floor(F.col("start") / width).cast("int")).groupBy("intern_id", "block").agg(*_merged(start))
    at_end = F.col("runs.end") == start + width
    return merged.select("intern_id", "block", start.cast("int").alias("start"), F.lit(width).alias("days"), *SUMS, "best_day",
                         "first_day", "last_day", F.col("runs.prefix").alias("prefix"),
                         F.when(at_end, F.col("runs.suffix")).otherwise(0).alias("suffix"), F.col("runs.longest").alias("longest"))


def write_rollup(facts: DataFrame, path: str) -> DataFrame:
    """Write all levels under ``path``, each from the written level below, and
    return the stored rollup. Rows without a date have no place in it."""
    spark = facts.sparkSession
    folder = lambda k: os.path.join(path, f"level={k}")
    days_of(facts).write.parquet(folder(0))
    for level in range(1, LEVELS):
        parents_of(spark.read.parquet(folder(level - 1)), level).write.parquet(folder(level))
    return read_rollup(spark, path)


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def blocks_in(rollup: DataFrame, p: Params | None = None) -> DataFrame:
    """The rows whose blocks make up the range, both ends included; without a
    range all blocks of the top level. An empty range has no rows; a range
    open at one side is not taken."""
    if p is None or not (p.start or p.end):
        return rollup.where(F.col("level") == LEVELS - 1)
    if not (p.start and p.end):
        raise ValueError("a range needs both ends")
    return rollup.where(covers(day_number(p.start), day_number(p.end)))


def _per_intern(rollup: DataFrame, p: Params | None) -> DataFrame:
    whole = blocks_in(rollup, p).groupBy("intern_id").agg(*_merged(F.lit(day_number("0001-01-01"))))
    return whole.select("intern_id", *SUMS, join_parts(F.col("whole"), F.col("part")).alias("total_hours"), "best_day",
                        F.date_from_unix_date("first_day").alias("first_date"), F.date_from_unix_date("last_day").alias("last_date"),
                        F.col("runs.longest").cast("bigint").alias("longest_streak"))


def streak_stats(rollup: DataFrame, p: Params | None = None) -> DataFrame:
    """W02 / B32 from the rollup, over any dates; the result of
    ``activity.streak_stats``."""
    return _per_intern(rollup, p).select(
        "intern_id", "active_days", F.col("best_day").alias("best_day_hours"),
        (F.col("total_hours") / F.col("logged_days")).alias("daily_avg_hours"), "first_date", "last_date", "longest_streak")


def range_summary(rollup: DataFrame, p: Params) -> DataFrame:
    """C10 / F05 from the rollup; the result of ``activity.range_summary``."""
    days = F.lit(day_number(p.end) - day_number(p.start) + 1)
    return _per_intern(rollup, p).select(
        "intern_id", "total_hours", "logged_days", "first_date", "last_date",
        inclusive_days(F.col("first_date"), F.col("last_date")).cast("int").alias("own_span_days"),
        days.alias("range_days"), (F.col("total_hours") / days).alias("hours_per_day"))


def session_rollup(g: Gold) -> DataFrame:
    """The rollup of a Gold, written once in the shared checkpoint folder."""
    if getattr(g, "_rollup", None) is None:
        spark = g.fact_activity.sparkSession
        path = os.path.join(checkpoint_dir(spark), "tables", f"rollup-{uuid.uuid4().hex}")
        g._rollup = write_rollup(g.fact_activity, path)
        delete_on_exit(spark.sparkContext, path)
    return g._rollup
