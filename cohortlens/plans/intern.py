"""Intern-facing analytics, computed for every intern at once
(W01, W07, B14, B17, B18, B22, B25-B30, B33, B36).

Cohort-wide statistics (median / quartile of total hours, course means)
are one-row frames or scalar subqueries; they are computed by distributed
ranking, never by pulling the cohort into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.fmt import fmt_pct0, fmt_rank, fmt_ratio, signed_delta
from cohortlens.functions.numeric import exact_sum, round_half_even
from cohortlens.operators.ranking import approx_quantiles, exact_quantiles, rank_rows
from cohortlens.operators.scalar import attach_row
from cohortlens.plans.activity import total_hours
from cohortlens.plans.common import NOT_STARTED, Params, activity, course_dim, hours_sum, small_side
from cohortlens.plans.lms import course_avg_progress, with_scores
from cohortlens.sources.bindings import Gold

# Skill-intensity weights and the hours-ratio cap.
W_PROGRESS, W_HOURS, W_ASSIGN = 0.5, 0.3, 0.2
HOURS_RATIO_CAP = 1.5
# Badge and banner texts.
BADGE_ON_TRACK = "🎯 On track to complete all courses!"
BADGE_ALL_DONE = "🏆 All courses completed! Star intern!"
BADGE_LOW_EFFORT = "⚠️ Low effort detected — time to push harder!"
BADGE_STEADY = "📈 Progressing steadily. Keep the momentum!"
BANNER_TOP = "🚀 **Top Tier Alert!** Your average progress is **%.0f%%** — you're outpacing most of your cohort. Keep crushing it!"
BANNER_NOT_STARTED = "⚡ **Heads Up!** You haven't started **%d course(s)** yet. Every day counts — time to dive in!"
BANNER_BELOW_MEDIAN = ("📈 **Almost There!** You're **%.1f hrs** below the cohort median. "
                       "A little extra daily effort will move your rank significantly!")
BANNER_ON_TRACK = ("✅ **On Track!** You've logged **%.0f hrs** and your effort is above the cohort median. "
                   "Consistency is your superpower!")


def cohort_hour_stats(g: Gold, p: Params | None = None, approx: bool = False) -> DataFrame:
    """One row: median and 25th percentile of total hours per intern; exact
    (distributed ranking) by default, sketch-based with ``approx``."""
    th = total_hours(g, p)
    names = ["median_hours", "p25_hours"]
    if approx:
        return approx_quantiles(th, "total_hours", [0.5, 0.25], names)
    return exact_quantiles(th, "total_hours", [0.5, 0.25], names)


def hours_rank(g: Gold, p: Params | None = None) -> DataFrame:
    """Rank by total hours (desc, intern_id asc on ties) among
    interns with activity, with '#r of n'. Range-partitioned, no global window."""
    th = total_hours(g, p)
    r = rank_rows(th, [F.desc("total_hours"), F.asc("intern_id")], name="rank")
    n = th.agg(F.count(F.lit(1)).alias("n_ranked"))                        # one row: broadcast
    return attach_row(r, n).select("intern_id", "total_hours", "rank", "n_ranked",
                                              fmt_rank(F.col("rank"), F.col("n_ranked")).alias("rank_label"))


def mentor_hours_rank(g: Gold, p: Params | None = None) -> DataFrame:
    """W01 per mentor: rank of each cohort member's total hours within the
    mentor's cohort (range-partitioned by (mentor, hours), so a mentor with a
    huge cohort is spread over many tasks)."""
    th = total_hours(g, p).join(g.bridge, "intern_id")
    return rank_rows(th, [F.desc("total_hours"), F.asc("intern_id")], group=["mentor_name"], name="rank")


def masked_leaderboard(g: Gold, viewer_id, p: Params | None = None) -> DataFrame:
    """The hours leaderboard as one viewer sees it: their own row named,
    every other intern shown as 'Intern #r'. The ranked table is shared; the
    mask is applied at read time for the given viewer."""
    # The viewer test is projected once (the viewer may be a scalar subquery).
    r = hours_rank(g, p).join(g.dim_intern, "intern_id", "left").withColumn("is_viewer", F.col("intern_id") == viewer_id)
    me = F.col("is_viewer")
    name = F.when(me, F.concat(F.lit("⭐ "), F.col("intern_name"), F.lit(" (You)"))).otherwise(
        F.format_string("Intern #%d", F.col("rank")))
    return r.select(F.format_string("#%d", F.col("rank")).alias("rank_label"), name.alias("name"),
                    F.format_string("%.0f hrs", round_half_even(F.col("total_hours"), 0)).alias("hours_label"),
                    F.col("total_hours").alias("bar"), "is_viewer")


def _intern_lms(g: Gold) -> DataFrame:
    st = F.col("overall_status")
    return g.fact_lms.groupBy("intern_id").agg(
        F.avg("progress").alias("avg_progress"),
        F.sum("reviewed").alias("sum_reviewed"), F.sum("total_assg").alias("sum_total_assg"),
        F.count(F.lit(1)).alias("n_courses"), F.count_if(st == "Completed").alias("n_completed"),
        F.count_if(st.isin(*NOT_STARTED)).alias("n_not_started"),
        # A missing progress value fails the test (NaN >= 70 is false).
        F.coalesce(F.bool_and(F.coalesce(F.col("progress") >= 70, F.lit(False))), F.lit(True)).alias("all_above_70"))


def skill_intensity(g: Gold, p: Params | None = None) -> DataFrame:
    """100 * (0.5 * progress/100 + 0.3 * min(hours/median, 1.5)/1.5 + 0.2 * reviewed/total)."""
    lms = _intern_lms(g)
    th = total_hours(g, p)
    j = attach_row(lms.join(th, "intern_id", "left"), cohort_hour_stats(g, p))
    med = F.col("median_hours")
    med_g = F.when((med.isNull()) | (med == 0), F.lit(1.0)).otherwise(med)
    hours = F.coalesce(F.col("total_hours"), F.lit(0.0))
    ratio = F.least(hours / med_g, F.lit(HOURS_RATIO_CAP)) / HOURS_RATIO_CAP
    assg = F.col("sum_reviewed") / F.greatest(F.col("sum_total_assg"), F.lit(1))
    score = (F.col("avg_progress") / 100 * W_PROGRESS) + (ratio * W_HOURS) + (assg * W_ASSIGN)
    return j.select("intern_id", hours.alias("total_hours"), round_half_even(score * 100, 1).alias("skill_score"))


def cohort_skill_intensity(g: Gold, p: Params | None = None) -> DataFrame:
    """Mean skill score over interns with both LMS rows and activity; 50.0 when none."""
    lms = _intern_lms(g)
    th = total_hours(g, p)
    j = attach_row(lms.join(th, "intern_id"), cohort_hour_stats(g, p))
    med = F.col("median_hours")
    med_g = F.when((med.isNull()) | (med == 0), F.lit(1.0)).otherwise(med)
    ratio = F.least(F.col("total_hours") / med_g, F.lit(HOURS_RATIO_CAP)) / HOURS_RATIO_CAP
    assg = F.col("sum_reviewed") / F.when(F.col("sum_total_assg") == 0, 1).otherwise(F.col("sum_total_assg"))
    score = (F.col("avg_progress") / 100 * W_PROGRESS) + (ratio * W_HOURS) + (assg * W_ASSIGN)
    # Mean as exact sum / count; the per-intern scores are fixed to 9 decimals first.
    s = j.select(score.cast("decimal(38,9)").alias("s"))
    return s.agg(F.coalesce(round_half_even(F.sum("s").cast("double") / F.count(F.lit(1)) * 100, 1),
                            F.lit(50.0)).alias("cohort_skill_score"))


def outlook_badge(g: Gold, p: Params | None = None) -> DataFrame:
    """The ordered badge rule for every intern with LMS rows."""
    lms = _intern_lms(g)
    th = total_hours(g, p)
    stats = cohort_hour_stats(g, p)
    j = attach_row(lms.join(th, "intern_id", "left"), stats)
    hours = F.coalesce(F.col("total_hours"), F.lit(0.0))
    text = (F.when(F.col("all_above_70") & (hours >= F.col("median_hours")), BADGE_ON_TRACK)
             .when(F.col("n_completed") == F.col("n_courses"), BADGE_ALL_DONE)
             .when(hours < F.col("p25_hours"), BADGE_LOW_EFFORT).otherwise(BADGE_STEADY))
    kind = (F.when(F.col("all_above_70") & (hours >= F.col("median_hours")), "success")
             .when(F.col("n_completed") == F.col("n_courses"), "success")
             .when(hours < F.col("p25_hours"), "error").otherwise("info"))
    return j.select("intern_id", text.alias("badge_text"), kind.alias("badge_type"))


def banner(g: Gold, p: Params | None = None) -> DataFrame:
    """The ordered banner rule (top tier / not started / below median / on track)."""
    lms = _intern_lms(g)
    th = total_hours(g, p)
    j = attach_row(lms.join(th, "intern_id", "left"), cohort_hour_stats(g, p))
    med = F.col("median_hours")
    hours = F.coalesce(F.col("total_hours"), F.lit(0.0))
    ap = F.col("avg_progress")
    text = (F.when(ap >= 80, F.format_string(BANNER_TOP, round_half_even(ap, 0)))
             .when(F.col("n_not_started") > 0, F.format_string(BANNER_NOT_STARTED, F.col("n_not_started")))
             .when(hours < med, F.format_string(BANNER_BELOW_MEDIAN, round_half_even(med - hours, 1)))
             .otherwise(F.format_string(BANNER_ON_TRACK, round_half_even(hours, 0))))
    kind = (F.when(ap >= 80, "success").when(F.col("n_not_started") > 0, "warning")
             .when(hours < med, "warning").otherwise("info"))
    return j.select("intern_id", kind.alias("banner_type"), text.alias("banner_text"))


def radar_profile(g: Gold) -> DataFrame:
    """Per intern and course with data, own progress (first LMS row of
    that course) next to the cohort's course mean. Long form: one row per
    axis of the radar, a missing one reads as 0."""
    own = g.fact_lms_light.groupBy("intern_id", "course_id").agg(
        F.min(F.struct("lms_row_id", "progress")).alias("f"))
    # Courses of one name are one axis; the dimension and the means are small.
    dim = small_side(course_dim(g).join(course_avg_progress(g), "course_name", "left"), "course_means")
    per = own.join(dim, "course_id").groupBy("intern_id", "course_name").agg(
        F.min("f").alias("f"), F.first("avg_progress").alias("cohort_progress"))
    return per.select("intern_id", "course_name", F.coalesce("f.progress", F.lit(0.0)).alias("own_progress"),
                      F.coalesce("cohort_progress", F.lit(0.0)).alias("cohort_progress"))


def activity_benchmark(g: Gold, p: Params | None = None) -> DataFrame:
    """For each intern and activity with hours: own hours, the cohort
    mean per intern (A19) and the activity's place in the intern's own order
    by hours (ties by name). An activity without a row reads as 0 hours."""
    fa = activity(g, p)
    n = fa.agg(F.count_distinct("intern_id")).scalar()
    per = fa.groupBy("intern_id", "activity").agg(hours_sum().alias("my_hours"))
    # The cohort's hours add up the interns' own: the facts are read once.
    coh = small_side(per.groupBy("activity").agg((hours_sum("my_hours") / n).alias("cohort_avg_hours")), "cohort_hours")
    # One row per activity of an intern: the window partitions are tiny.
    w = Window.partitionBy("intern_id").orderBy(F.desc("my_hours"), F.asc("activity"))
    return per.join(coh, "activity", "left").withColumn("own_rank", F.row_number().over(w))


def kpi_strip(g: Gold, p: Params | None = None) -> DataFrame:
    """Hours, completed, assignments, rank and progress delta against the
    mean of course means, formatted, for every intern with LMS rows."""
    lms = _intern_lms(g)
    rk = hours_rank(g, p)
    mom = course_avg_progress(g).agg(F.avg("avg_progress").alias("__mom"))    # one row: broadcast
    j = attach_row(lms.join(rk, "intern_id", "left"), mom)
    mean_of_means = F.col("__mom")
    hours = F.coalesce(F.col("total_hours"), F.lit(0.0))
    return j.select(
        "intern_id",
        F.format_string("%.0f hrs", round_half_even(hours, 0)).alias("hours_label"),
        fmt_ratio(F.col("n_completed"), F.col("n_courses")).alias("completed_label"),
        fmt_ratio(F.col("sum_reviewed"), F.col("sum_total_assg")).alias("assignments_label"),
        F.coalesce(F.col("rank_label"), F.lit("N/A")).alias("rank_label"),
        fmt_pct0(F.col("avg_progress")).alias("progress_label"),
        F.concat(signed_delta(F.col("avg_progress") - mean_of_means), F.lit("% vs cohort")).alias("delta_label"))


def effort_vs_progress(g: Gold, p: Params | None = None) -> DataFrame:
    """B14 points: interns with both hours and progress."""
    th = total_hours(g, p)
    pr = g.fact_lms_light.groupBy("intern_id").agg(F.avg("progress").alias("progress"))
    return th.join(pr, "intern_id").join(g.dim_intern, "intern_id", "left").select(
        "intern_id", F.col("total_hours").alias("hours"), "progress", "intern_name")


def effort_trend_line(g: Gold, p: Params | None = None, points: int = 50) -> DataFrame:
    """Least-squares line of progress on hours (only when n > 2),
    sampled at ``points`` evenly spaced hours from min to max."""
    pts = effort_vs_progress(g, p)
    fit = pts.agg(F.regr_slope("progress", "hours").alias("slope"),
                  F.regr_intercept("progress", "hours").alias("intercept"),
                  F.count(F.lit(1)).alias("n"), F.min("hours").alias("lo"), F.max("hours").alias("hi"))
    fit = fit.where(F.col("n") > 2)
    x = F.col("lo") + F.col("i") * (F.col("hi") - F.col("lo")) / (points - 1)
    line = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    return line.select("i", round_half_even(x, 6).alias("hours"),
                       round_half_even(F.col("slope") * x + F.col("intercept"), 6).alias("progress"))


def intern_range_panel(g: Gold, p: Params | None = None) -> DataFrame:
    """KPIs of every intern over a date range (default: the whole span)."""
    fa = activity(g, p)
    act = fa.groupBy("intern_id").agg(hours_sum().alias("total_hours"),
                                      F.count_distinct("date").alias("active_days"))
    s = with_scores(g.fact_lms)
    kc, te = F.col("kc_pct"), F.col("test_pct")
    lms = s.groupBy("intern_id").agg(
        F.avg("progress").alias("avg_progress"), F.sum("reviewed").alias("r"), F.sum("total_assg").alias("t"),
        F.count_if(F.col("overall_status") == "Completed").alias("c"), F.count(F.lit(1)).alias("n"),
        (exact_sum(F.when(kc > 0, kc)) / F.count_if(kc > 0)).alias("kc"),
        (exact_sum(F.when(te > 0, te)) / F.count_if(te > 0)).alias("te"))
    j = lms.join(act, "intern_id", "left")
    hours = F.coalesce(F.col("total_hours"), F.lit(0.0))
    return j.select(
        "intern_id", hours.alias("total_hours"), F.coalesce(F.col("active_days"), F.lit(0)).alias("active_days"),
        F.format_string("%.0f hrs", round_half_even(hours, 0)).alias("hours_label"),
        fmt_pct0(F.col("avg_progress")).alias("progress_label"),
        F.format_string("%d/%d courses", F.col("c"), F.col("n")).alias("completed_label"),
        fmt_ratio(F.col("r"), F.col("t")).alias("assignments_label"),
        F.when(F.col("kc").isNull(), F.lit("N/A")).otherwise(fmt_pct0(F.col("kc"))).alias("kc_label"),
        F.when(F.col("te").isNull(), F.lit("N/A")).otherwise(fmt_pct0(F.col("te"))).alias("test_label"))


def deep_dive(g: Gold, p: Params | None = None) -> DataFrame:
    """All-time KPIs and the simple progress tier (<40 High, >70 Low)."""
    lms = _intern_lms(g)
    th = total_hours(g, p)
    j = lms.join(th, "intern_id", "left")
    ap = F.col("avg_progress")
    tier = F.when(ap < 40, "High").when(ap > 70, "Low").otherwise("Medium")
    return j.select(
        "intern_id", fmt_pct0(ap).alias("progress_label"),
        F.when(F.col("total_hours").isNull(), F.lit("N/A"))
         .otherwise(F.format_string("%.0f hrs", round_half_even(F.col("total_hours"), 0))).alias("hours_label"),
        fmt_ratio(F.col("sum_reviewed"), F.col("sum_total_assg")).alias("assignments_label"),
        F.format_string("%d/%d courses", F.col("n_completed"), F.col("n_courses")).alias("completed_label"),
        tier.alias("risk_tier"))
