"""Dropout risk (B04) and the views built on it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.fmt import risk_level
from cohortlens.functions.numeric import round_half_even
from cohortlens.plans.common import Params, activity, hours_sum, max_date
from cohortlens.sources.bindings import Gold

# Weights and windows of the risk score.
PROGRESS_WEIGHT, EFFORT_WEIGHT, ASSIGNMENT_WEIGHT, RECENCY_WEIGHT = 40, 30, 20, 10
PROGRESS_FLOOR = 50.0          # average progress at or above this carries no risk
RECENT_DAYS, PREVIOUS_DAYS = 14, 28
RECENCY_PER_DAY = 1.5


def activity_windows(fa: DataFrame) -> DataFrame:
    """Per intern, one pass over activity: hours in [M-14, M], in [M-28, M-14),
    last active date and total hours (M = global last date)."""
    # The scalar subquery sits in one projection, so it is planned and run
    # once; the aggregates read it as a column (constant within the query).
    x = fa.withColumn("__m", max_date(fa))
    m = F.col("__m")
    d14, d28 = F.date_sub(m, RECENT_DAYS), F.date_sub(m, PREVIOUS_DAYS)
    d = F.col("date")
    agg = x.groupBy("intern_id", "__m").agg(
        F.coalesce(hours_sum(F.when(d >= d14, F.col("hours"))), F.lit(0.0)).alias("recent_hours"),
        F.coalesce(hours_sum(F.when((d >= d28) & (d < d14), F.col("hours"))), F.lit(0.0)).alias("prev_hours"),
        F.max("date").alias("last_date"),
        hours_sum().alias("total_hours"),
    )
    return agg.select("intern_id", "recent_hours", "prev_hours", "last_date",
                      F.datediff(m, F.col("last_date")).alias("days_since"), "total_hours")


def lms_summary(g: Gold) -> DataFrame:
    """Per intern over all LMS rows: mean progress and assignment sums."""
    return lms_totals(g.fact_lms)


def lms_totals(fact_lms: DataFrame) -> DataFrame:
    return fact_lms.groupBy("intern_id").agg(
        F.avg("progress").alias("avg_progress_raw"),
        F.sum("reviewed").alias("sum_reviewed"),
        F.sum("total_assg").alias("sum_total_assg"),
        F.count(F.lit(1)).alias("n_courses"),
    )


def dropout_risk(g: Gold, p: Params | None = None, keep_parts: bool = False) -> DataFrame:
    """Risk score 0-100 for every intern with LMS rows.

    The score only depends on the intern (never on the mentor looking at
    it), so it is computed once for everybody and scoped later by joining
    the mentor bridge. Both inputs are aggregated to one row per intern
    before the join, so a hot intern never skews a join.
    """
    return risk_scores(lms_summary(g), activity_windows(activity(g, p)), g.dim_intern, keep_parts)


def risk_scores(lms: DataFrame, act: DataFrame, dim_intern: DataFrame, keep_parts: bool = False) -> DataFrame:
    """The score from one row per intern of each input."""
    j = lms.join(act, "intern_id", "left").join(dim_intern, "intern_id", "left")

    avg_p = F.coalesce(F.col("avg_progress_raw"), F.lit(0.0))
    prog = F.greatest((F.lit(PROGRESS_FLOOR) - avg_p) / F.lit(PROGRESS_FLOOR), F.lit(0.0)) * PROGRESS_WEIGHT
    recent, prev = F.coalesce(F.col("recent_hours"), F.lit(0.0)), F.coalesce(F.col("prev_hours"), F.lit(0.0))
    effort = (F.when(prev > 0, F.greatest(F.lit(0.0), -(recent - prev) / prev) * EFFORT_WEIGHT)
               .when(recent > 0, F.lit(EFFORT_WEIGHT / 2.0)).otherwise(F.lit(float(EFFORT_WEIGHT))))
    assg = F.greatest(F.lit(1.0) - F.col("sum_reviewed") / F.greatest(F.col("sum_total_assg"), F.lit(1)),
                      F.lit(0.0)) * ASSIGNMENT_WEIGHT
    recency = F.when(F.col("days_since").isNull(), F.lit(float(RECENCY_WEIGHT))).otherwise(
        F.least(F.col("days_since") * RECENCY_PER_DAY, F.lit(float(RECENCY_WEIGHT))))

    parts = j.select(
        "intern_id",
        F.coalesce(F.col("intern_name"), F.lit("Unknown")).alias("intern_name"),
        avg_p.alias("avg_progress"), prog.alias("prog_risk"), effort.alias("effort_risk"),
        assg.alias("assg_lag"), recency.alias("recency_risk"),
        *(["recent_hours", "prev_hours", "last_date", "total_hours", "sum_reviewed", "sum_total_assg"] if keep_parts else []),
    )
    score = round_half_even(F.col("prog_risk") + F.col("effort_risk") + F.col("assg_lag") + F.col("recency_risk"), 1)
    out = parts.withColumn("risk_score", score).withColumn("risk_level", risk_level(F.col("risk_score")))
    for c in ("avg_progress", "prog_risk", "effort_risk", "assg_lag", "recency_risk"):
        out = out.withColumn(c, round_half_even(F.col(c), 1))
    return out
