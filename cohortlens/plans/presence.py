"""Stored distinct counts: who was active, over any dates.

Distinct counts do not add up over days, but sets do. Every intern gets a
number, and for each group (the cohort, a mentor, an activity) and block of days
the store keeps the set of active interns as bitmaps of 32 768 numbers each. A
range of dates is covered by a few blocks (``rollup.cover``), their bitmaps are
united, and the bits are counted: exact, whatever the ids are (text, digests or
integers of 64 bits), with no distinct over the facts.

A batch of new facts is added as rows of its own: sets may be united in any
order and more than once, so a batch that is loaded twice changes nothing. One
writer at a time; a batch's bitmaps are one write, so readers see all of it or
nothing.
"""

from __future__ import annotations

import os
import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.operators.materialize import materialize
from cohortlens.operators.ranking import rank_rows
from cohortlens.plans.common import Params
from cohortlens.plans.rollup import FANOUT, LEVELS, covers, day_number
from cohortlens.session import checkpoint_dir, delete_on_exit
from cohortlens.sources.bindings import Gold

COHORT, MENTOR, ACTIVITY = "cohort", "mentor", "activity"


def _folder(path: str, part: str) -> str:
    return os.path.join(path, part)


def _stored(spark: SparkSession, path: str, part: str) -> DataFrame | None:
    p = spark._jvm.org.apache.hadoop.fs.Path(_folder(path, part))
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return None
    return spark.read.parquet(_folder(path, part))


def _numbered(spark: SparkSession, path: str, seen: DataFrame, bridge: DataFrame) -> DataFrame:
    """Numbers for the interns of ``seen``; those without one get the next,
    in order of their first mentor, so that a mentor's interns share bitmaps."""
    known = _stored(spark, path, "ids")
    ids = seen.select("intern_id").distinct()
    first = 0
    if known is not None:
        ids = ids.join(known, "intern_id", "left_anti")
        first = (known.agg(F.max("number")).first()[0] or 0)
    mentor = bridge.groupBy("intern_id").agg(F.min("mentor_name").alias("__m"))
    new = rank_rows(ids.join(mentor, "intern_id", "left"), [F.asc_nulls_last("__m"), F.asc("intern_id")], name="number")
    new.select("intern_id", (F.col("number") + first).alias("number")).write.mode("append").parquet(_folder(path, "ids"))
    return spark.read.parquet(_folder(path, "ids"))


def add_batch(spark: SparkSession, facts: DataFrame, bridge: DataFrame, path: str) -> None:
    """Add the logs of ``facts`` to the store at ``path`` (made if there is none).

    Rows without an intern or a date count nowhere; a null activity is a group
    of its own. An intern of several mentors counts once for each, one without
    a mentor only in the cohort and the activities."""
    logs = materialize(facts.where(F.col("intern_id").isNotNull() & F.col("date").isNotNull())
                       .select("intern_id", F.unix_date("date").alias("day"), "activity").distinct(), "logs")
    ids = _numbered(spark, path, logs, bridge)
    days = logs.select("intern_id", "day").distinct()
    by_mentor = days.join(bridge.select("intern_id", "mentor_name").distinct(), "intern_id")
    none = F.lit(None).cast("string")
    rows = reduce(DataFrame.unionByName, [
        days.select(F.lit(COHORT).alias("scope"), none.alias("name"), "intern_id", "day"),
        by_mentor.select(F.lit(MENTOR).alias("scope"), F.col("mentor_name").alias("name"), "intern_id", "day"),
        logs.select(F.lit(ACTIVITY).alias("scope"), F.col("activity").alias("name"), "intern_id", "day")])
    levels = F.explode(F.array(*[
        F.struct(F.lit(k).alias("level"), F.floor(F.col("day") / FANOUT ** k).cast("int").alias("block")) for k in range(LEVELS)]))
    # Bitmaps are begun before the shuffle, in sorted runs: a hot day or mentor
    # costs one bitmap a task and block.
    sets = rows.join(ids, "intern_id").select("scope", "name", "number", levels.alias("b")).groupBy(
        "scope", F.col("b.level").alias("level"), F.col("b.block").alias("block"), "name",
        F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    sets.write.mode("append").parquet(_folder(path, "sets"))


def compacted(sets: DataFrame) -> DataFrame:
    """The batches of a store united: one bitmap a group, block and bucket."""
    return sets.groupBy("scope", "level", "block", "name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))


def read_sets(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(_folder(path, "sets"))


def active(sets: DataFrame, scope: str, p: Params) -> DataFrame:
    """Distinct active interns of each group in the range, both ends included.
    A group without any has no row, but for the cohort, which has 0."""
    rows = sets.where((F.col("scope") == scope) & covers(day_number(p.start), day_number(p.end)))
    united = rows.groupBy("name", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    n = F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("active")
    if scope == COHORT:
        return united.agg(n)
    return united.groupBy("name").agg(n)


def retention(sets: DataFrame, scope: str, p: Params) -> DataFrame:
    """The range against the equally long one before it: interns active now,
    before, in both (retained), only now (new) and only before (lost), for each
    group with any of them."""
    first, last = day_number(p.start), day_number(p.end)
    now, then = covers(first, last), covers(first - (last - first + 1), first - 1)
    rows = sets.where((F.col("scope") == scope) & (now | then))
    united = rows.groupBy("name", "bucket").agg(
        F.bitmap_count(F.bitmap_or_agg(F.when(now, F.col("bits")))).alias("a"),
        F.bitmap_count(F.bitmap_or_agg(F.when(then, F.col("bits")))).alias("b"),
        F.bitmap_count(F.bitmap_or_agg("bits")).alias("either"))
    g = united.groupBy("name").agg(*[F.sum(c).alias(c) for c in ("a", "b", "either")])
    return g.select("name", F.col("a").alias("active"), F.col("b").alias("before"),
                    (F.col("a") + F.col("b") - F.col("either")).alias("retained"),
                    (F.col("either") - F.col("b")).alias("new"), (F.col("either") - F.col("a")).alias("lost"))


def session_sets(g: Gold) -> DataFrame:
    """The store of a Gold, written once in the shared checkpoint folder."""
    if getattr(g, "_presence", None) is None:
        spark = g.fact_activity.sparkSession
        path = os.path.join(checkpoint_dir(spark), "tables", f"presence-{uuid.uuid4().hex}")
        delete_on_exit(spark.sparkContext, path)
        add_batch(spark, g.fact_activity, g.bridge, path)
        g._presence = read_sets(spark, path)
    return g._presence
