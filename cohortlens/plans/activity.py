"""Effort analytics over fact_activity.

Everything here first aggregates to (intern, day) or coarser with partial
(map-side) aggregation, so a hot intern holding a large share of rows
costs one small row per partition, not one huge task.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.dates import inclusive_days, iso_week, iso_year, weekday0
from cohortlens.functions.numeric import round_half_even
from cohortlens.functions.text import lookup, short_label
from cohortlens.operators.relational import islands, share_of_total
from cohortlens.operators.scalar import attach_row
from cohortlens.plans.common import Params, activity, hours_sum
from cohortlens.sources.bindings import Gold


def total_hours(g: Gold, p: Params | None = None) -> DataFrame:
    """Total hours per intern with any activity."""
    return activity(g, p).groupBy("intern_id").agg(hours_sum().alias("total_hours"))


def daily_hours(g: Gold, p: Params | None = None) -> DataFrame:
    """(intern_id, date, hours); rows without a date are dropped like a pandas groupby."""
    fa = activity(g, p).where(F.col("date").isNotNull())
    return fa.groupBy("intern_id", "date").agg(hours_sum().alias("hours"))


def outlier_days(g: Gold, p: Params | None = None) -> DataFrame:
    """Daily totals per intern with the >12 h outlier flag."""
    limit = (p or Params()).outlier_hours
    return daily_hours(g, p).withColumn("is_outlier", F.col("hours") > F.lit(limit))


def daily_stats(g: Gold, p: Params | None = None) -> DataFrame:
    """Per intern, logged days, active days, mean / max daily hours and the
    best day (earliest on ties). The mean is over logged days only."""
    d = daily_hours(g, p)
    best = F.max(F.struct(F.col("hours"), (-F.unix_date("date")).alias("nd")))
    return d.groupBy("intern_id").agg(
        F.count(F.lit(1)).alias("logged_days"),
        F.count_if(F.col("hours") > 0).alias("active_days"),
        (hours_sum() / F.count(F.lit(1))).alias("mean_daily_hours"),
        F.max("hours").alias("max_daily_hours"),
        F.date_from_unix_date(-best["nd"]).alias("best_day"),
    )


# Activity labels of the EOD sheet and their icons; others get '•'.
ACTIVITY_ICON = {
    "PySpark Session": "⚡",
    "Data Engineering Course": "🏗️",
    "NumPy Practice": "🔢",
    "Advanced SQL Practice": "🗄️",
    "Power BI Dashboard Work": "📊",
    "PySpark LMS Learning": "📚",
    "Pandas Exam Preparation": "🐼",
    "PL/SQL Concepts": "🔍",
    "Project Research": "🔬",
    "Pandas Practice": "🐼",
    "Spark Architecture Study": "🏛️",
    "SQL Revision": "🔄",
}


def activity_label(c) -> "F.Column":
    """C13 + C22: '<icon> <first 18 characters>'."""
    return F.concat(lookup(c, ACTIVITY_ICON, "•"), F.lit(" "), short_label(c, 18))


def activity_hours(g: Gold, by=("intern_id",), p: Params | None = None) -> DataFrame:
    """Hours per activity within ``by`` with the share of the total
    and the display label."""
    a = activity(g, p).groupBy(*by, "activity").agg(hours_sum().alias("hours"))
    return share_of_total(a, "hours", list(by), "share").withColumn("label", activity_label(F.col("activity")))


def activity_by_mentor(g: Gold, p: Params | None = None) -> DataFrame:
    """B12 per mentor: activity hours of the mentor's cohort with share. Hours
    are first summed per (intern, activity), then fanned out over the bridge."""
    per = activity(g, p).groupBy("intern_id", "activity").agg(hours_sum().alias("h"))
    j = per.join(g.bridge, "intern_id")
    a = j.groupBy("mentor_name", "activity").agg(hours_sum("h").alias("hours"))
    return share_of_total(a, "hours", ["mentor_name"], "share")


def date_activity_hours(g: Gold, p: Params | None = None) -> DataFrame:
    """Hours per (intern, date, activity)."""
    fa = activity(g, p).where(F.col("date").isNotNull())
    return fa.groupBy("intern_id", "date", "activity").agg(hours_sum().alias("hours"))


def daily_activity_pivot(g: Gold, p: Params | None = None) -> DataFrame:
    """The cells of the (intern, date) x activity matrix that have
    data, with the day's total; a missing cell reads as 0. Long form, so the
    list of activities may be of any length."""
    cells = date_activity_hours(g, p)
    day = cells.groupBy("intern_id", "date").agg(hours_sum().alias("day_hours"))
    return cells.join(day, ["intern_id", "date"])


def weekly_hours(g: Gold, by=(), p: Params | None = None, with_year: bool = False) -> DataFrame:
    """Hours per ISO week (optionally per intern). The sheet's week number
    has no year, so years merge; ``with_year`` keeps them apart."""
    fa = activity(g, p).where(F.col("date").isNotNull()).withColumn("week", iso_week("date"))
    year = ["iso_year"] if with_year else []
    if with_year:
        fa = fa.withColumn("iso_year", iso_year("date"))
    return fa.groupBy(*by, *year, "week").agg(hours_sum().alias("hours"))


ISO_WEEKS = range(1, 54)


def weekly_trend_pivot(g: Gold, p: Params | None = None) -> DataFrame:
    """Intern x week matrix of hours over the 53 weeks that an ISO
    year can have, missing weeks = 0."""
    per = weekly_hours(g, ("intern_id",), p)  # one row per intern and week before the pivot
    cols = [F.coalesce(F.max(F.when(F.col("week") == w, F.col("hours"))), F.lit(0.0)).alias(f"w{w}") for w in ISO_WEEKS]
    return per.groupBy("intern_id").agg(*cols)


def weekly_with_cohort(g: Gold, p: Params | None = None) -> DataFrame:
    """Weekly hours per intern next to the cohort's weekly total."""
    per = weekly_hours(g, ("intern_id",), p)
    # At most 53 rows by the calendar.
    coh = F.broadcast(weekly_hours(g, (), p).withColumnRenamed("hours", "cohort_hours"))
    return per.join(coh, "week").join(g.dim_intern, "intern_id", "left")


def cohort_weekly_band(g: Gold, p: Params | None = None) -> DataFrame:
    """Cohort hours per week, their mean and the +-10 % target band."""
    wk = weekly_hours(g, (), p)
    mean = wk.agg((hours_sum() / F.count(F.lit(1))).alias("avg_hours"))   # one row: broadcast
    j = attach_row(wk, mean)
    return j.select("week", "hours", "avg_hours", (F.col("avg_hours") * 0.9).alias("band_low"),
                    (F.col("avg_hours") * 1.1).alias("band_high"))


def cohort_activity_mean(g: Gold, p: Params | None = None) -> DataFrame:
    """Hours per activity divided by the number of interns with any activity."""
    fa = activity(g, p)
    n = fa.agg(F.count_distinct("intern_id")).scalar()
    return fa.groupBy("activity").agg((hours_sum() / n).alias("cohort_avg_hours"))


def streak_stats(g: Gold, p: Params | None = None) -> DataFrame:
    """Active days, longest run of consecutive active days, best day
    and daily mean, per intern.

    Gaps-and-islands runs on the per-day aggregate (at most one row per
    intern and calendar day), so the window partitions stay small even for
    an intern with a huge number of raw rows.
    """
    d = daily_hours(g, p)
    act = islands(d.where(F.col("hours") > 0), ["intern_id"], "date", "island")
    runs = act.groupBy("intern_id", "island").agg(F.count(F.lit(1)).alias("run"))
    longest = runs.groupBy("intern_id").agg(F.max("run").alias("longest_streak"))
    stats = d.groupBy("intern_id").agg(
        F.count_if(F.col("hours") > 0).alias("active_days"),
        F.max("hours").alias("best_day_hours"),
        (hours_sum() / F.count(F.lit(1))).alias("daily_avg_hours"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"),
    )
    return stats.join(longest, "intern_id", "left").withColumn(
        "longest_streak", F.coalesce(F.col("longest_streak"), F.lit(0)).cast("bigint"))


def streak_calendar(g: Gold, p: Params | None = None) -> DataFrame:
    """Dense weekday x week grid per intern over the full weeks
    between the intern's first and last day; missing days = 0. Keyed by
    (iso_year, week) so weeks of different years never overwrite each other."""
    d = daily_hours(g, p)
    span = d.groupBy("intern_id").agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    lo = F.date_trunc("week", F.col("lo")).cast("date")
    hi = F.date_add(F.date_trunc("week", F.col("hi")).cast("date"), 6)
    spine = span.select("intern_id", F.explode(F.sequence(lo, hi, F.expr("INTERVAL 1 DAY"))).alias("date"))
    j = spine.join(d, ["intern_id", "date"], "left")
    return j.select("intern_id", iso_year("date").alias("iso_year"), iso_week("date").alias("week"),
                    weekday0("date").alias("dow"), "date",
                    F.coalesce(F.col("hours"), F.lit(0.0)).alias("hours"))


def top_activity_last_week(g: Gold, p: Params | None = None, days: int = 7) -> DataFrame:
    """Per intern, the activity with most hours in [last - 7, last] where
    last is the intern's own last date; ties go to the first activity by name."""
    a = date_activity_hours(g, p)
    last = a.groupBy("intern_id").agg(F.max("date").alias("last"))
    recent = a.join(last, "intern_id").where(F.col("date") >= F.date_sub(F.col("last"), days))
    per = recent.groupBy("intern_id", "activity").agg(hours_sum().alias("hours"))
    # At most one row per (intern, activity): the window partitions are tiny.
    w = Window.partitionBy("intern_id").orderBy(F.desc("hours"), F.asc("activity"))
    top = per.withColumn("rn", F.row_number().over(w)).where(F.col("rn") == 1)
    return top.select("intern_id", F.col("activity").alias("top_activity"),
                      round_half_even(F.col("hours"), 1).alias("top_hours"))


def range_summary(g: Gold, p: Params) -> DataFrame:
    """Per intern, over the chosen dates: hours, days with a log, the
    inclusive span of the range in days and the mean per day of it."""
    days = F.lit((date.fromisoformat(p.end) - date.fromisoformat(p.start)).days + 1)
    per = activity(g, p).groupBy("intern_id").agg(
        hours_sum().alias("total_hours"), F.count_distinct("date").alias("logged_days"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))
    return per.select("*", inclusive_days(F.col("first_date"), F.col("last_date")).cast("int").alias("own_span_days"),
                      days.alias("range_days"), (F.col("total_hours") / days).alias("hours_per_day"))
