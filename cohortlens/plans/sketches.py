"""Stored quantile sketches: quantiles over any dates.

For each group and block of days one stored row holds the count and a KLL
sketch of the values. Sketches merge, so a range of dates (``rollup.cover``)
needs a few tens of rows a group. Two readers:

* ``approximate`` answers from the sketches alone; the rank error of a KLL
  sketch of size 200 is some 1.3 % (``RANK_ERROR``);
* ``exact`` takes from the sketch only where to look: values below a bracket
  are counted, values inside are ranked, all others are left alone. Whether the
  bracket holds the wanted ranks is checked by the counts; a group whose sketch
  missed is ranked whole. So the result never rests on the sketch's luck.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.functions.numeric import finite
from cohortlens.operators.materialize import materialize
from cohortlens.operators.ranking import positions
from cohortlens.plans.common import Params, activity
from cohortlens.plans.rollup import FANOUT, LEVELS, covers, day_number
from cohortlens.session import checkpoint_dir, delete_on_exit
from cohortlens.sources.bindings import Gold

K = 200
RANK_ERROR = 0.0133     # of a sketch of size K, single rank, 99 %
BRACKET = 3             # brackets reach so many rank errors to each side


def write_sketches(values: DataFrame, path: str) -> DataFrame:
    """Store the sketches of ``values`` (group, date, value) for all levels and
    return them. Values that are null, NaN or infinite, and rows without a date,
    are left out; a null group is a group."""
    spark = values.sparkSession
    folder = lambda k: os.path.join(path, f"level={k}")
    rows = values.select("group", F.unix_date("date").alias("block"), finite("value").alias("v"))
    rows = rows.where(F.col("block").isNotNull() & F.col("v").isNotNull())
    rows.groupBy("group", "block").agg(F.count("v").alias("n"), F.kll_sketch_agg_double("v", K).alias("sketch")).write.parquet(folder(0))
    for level in range(1, LEVELS):
        below = spark.read.parquet(folder(level - 1)).withColumn("block", F.floor(F.col("block") / FANOUT).cast("int"))
        below.groupBy("group", "block").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", K).alias("sketch")).write.parquet(folder(level))
    return read_sketches(spark, path)


def read_sketches(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def _merged(stored: DataFrame, p: Params) -> DataFrame:
    """One row a group: its count in the range and the merged sketch."""
    rows = stored.where(covers(day_number(p.start), day_number(p.end)))
    return rows.groupBy("group").agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", K).alias("sketch"))


def approximate(stored: DataFrame, p: Params, qs: Sequence[float], names: Sequence[str]) -> DataFrame:
    """Quantiles from the sketches alone, with the group's exact count."""
    return _merged(stored, p).select("group", "n", *[
        F.kll_sketch_get_quantile_double("sketch", F.lit(float(q))).alias(n) for q, n in zip(qs, names)])


def _interpolated(k: Column, at: Column, value: Column) -> Column:
    """The value at the (0-based, fractional) rank ``k`` out of rows with their
    1-based position ``at``, linear between neighbours."""
    low, high = F.max(F.when(at == F.floor(k) + 1, value)), F.max(F.when(at == F.ceil(k) + 1, value))
    return low + (high - low) * F.max(F.when(at == F.floor(k) + 1, k - F.floor(k)))


def exact(values: DataFrame, stored: DataFrame, p: Params, q: float, name: str = "quantile", reach: float = BRACKET * RANK_ERROR) -> DataFrame:
    """The exact quantile ``q`` (linear interpolation) of each group of
    ``values`` (group, date, value) in the range: ``group``, ``n`` and ``name``.

    The counts come from ``values`` and not from the store, so that a store
    that lags behind costs time and not correctness. One row a group decides
    the brackets; it is joined by key, and AQE broadcasts it if it is small."""
    rows = values.where(F.col("date").between(F.lit(p.start).cast("date"), F.lit(p.end).cast("date")))
    rows = rows.select("group", "date", finite("value").alias("v")).where(F.col("v").isNotNull())
    at = lambda r: F.kll_sketch_get_quantile_double("sketch", F.lit(min(max(r, 0.0), 1.0)))
    brackets = materialize(_merged(stored, p).select(F.col("group").alias("__g"), at(q - reach).alias("lo"), at(q + reach).alias("hi")), "brackets")
    # A group that the store lacks has no bracket: all its rows are inside.
    below = F.coalesce(F.col("v") < F.col("lo"), F.lit(False))
    inside = ~below & F.coalesce(F.col("v") <= F.col("hi"), F.lit(True))
    counts = rows.join(brackets, rows["group"].eqNullSafe(brackets["__g"]), "left").groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(below).alias("n_below"), F.count_if(inside).alias("n_inside"),
        F.max("lo").alias("lo"), F.max("hi").alias("hi"))
    k = (F.col("n") - 1) * F.lit(float(q))
    holds = (F.col("n_below") <= F.floor(k)) & (F.col("n_below") + F.col("n_inside") > F.ceil(k))
    state = materialize(counts.select(F.col("group").alias("__g"), "n", "lo", "hi", holds.alias("holds"),
                                      F.when(holds, F.col("n_below")).otherwise(0).alias("skip")), "counts")
    wanted = rows.join(state, rows["group"].eqNullSafe(state["__g"])).where(inside | ~F.col("holds"))
    # The date splits a value that very many rows share.
    ranked = positions(wanted.select("group", "date", "v", "n", "skip"), [F.col("v"), F.col("date")], ["group"])
    ranked = ranked.withColumn("at", F.col("__pos") + F.col("skip"))
    near = ranked.where((F.col("at") == F.floor(k) + 1) | (F.col("at") == F.ceil(k) + 1))  # two rows a group
    return near.groupBy("group", "n").agg(_interpolated(k, F.col("at"), F.col("v")).alias(name))


def activity_hours(g: Gold) -> DataFrame:
    """The hours of each log row, grouped by activity."""
    return activity(g).select(F.col("activity").alias("group"), "date", F.col("hours").alias("value"))


def session_sketches(g: Gold) -> DataFrame:
    """The sketches of a Gold, written once in the shared checkpoint folder."""
    if getattr(g, "_sketches", None) is None:
        spark = g.fact_activity.sparkSession
        path = os.path.join(checkpoint_dir(spark), "tables", f"sketches-{uuid.uuid4().hex}")
        delete_on_exit(spark.sparkContext, path)
        g._sketches = write_sketches(activity_hours(g), path)
    return g._sketches


def activity_quantile(g: Gold, p: Params, q: float) -> DataFrame:
    """A16 / A21 for a range: exact quantile of the hours of a log row, by activity."""
    out = exact(activity_hours(g), session_sketches(g), p, q, "hours")
    return out.select(F.col("group").alias("activity"), F.col("n").alias("logs"), F.lit(float(q)).alias("q"), "hours")
