"""Course-progress analytics over fact_lms."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.fmt import dash_if_nonpositive, fmt_pct0, fmt_ratio
from cohortlens.functions.numeric import exact_units, fraction_part, pct, round_half_even, zero_to_one
from cohortlens.functions.fmt import progress_band
from cohortlens.functions.text import first_token, initials, lookup
from cohortlens.operators.ranking import exact_quantiles
from cohortlens.operators.materialize import materialize
from cohortlens.plans.common import COURSE_SHORT, IN_PROGRESS, NOT_STARTED, STATUS_VALUES, course_dim, small_side
from cohortlens.sources.bindings import Gold


def with_scores(lms: DataFrame) -> DataFrame:
    """KC and test percentages from scored / total (0 -> 1 guard), or
    from the sheet's own 'scored / total' text where the pair is missing (a
    part that is no number counts as 0 of 1), or 0."""
    cols = set(lms.columns)
    out = lms
    for name, scored, total, text in (("kc_pct", "kc_scored", "kc_total", "Overall Knowledge Check"),
                                      ("test_pct", "test_scored", "test_total", "Overall Test")):
        if name in cols:
            continue
        if scored in cols and total in cols:
            out = out.withColumn(name, pct(F.col(scored), F.col(total)))
        elif text in cols:
            c = F.col(f"`{text}`")
            out = out.withColumn(name, pct(fraction_part(c, 0, 0.0), fraction_part(c, 1, 1.0)))
        else:
            out = out.withColumn(name, F.lit(0.0))
    return out


def course_avg_progress(g: Gold) -> DataFrame:
    """Mean progress per course name (all interns)."""
    per = g.fact_lms_light.groupBy("course_id").agg(F.sum("progress").alias("s"), F.count("progress").alias("n"))
    j = per.join(course_dim(g), "course_id")  # a row per course, not per fact
    return j.groupBy("course_name").agg((F.sum("s") / F.sum("n")).alias("avg_progress"))


def pending_reviews(g: Gold) -> DataFrame:
    """Rows with reviewed < total, with names and the pending count."""
    sub = g.fact_lms.where(F.col("reviewed") < F.col("total_assg"))
    j = sub.join(g.dim_intern, "intern_id").join(course_dim(g), "course_id")
    return j.select("lms_row_id", "intern_id", "intern_name", "course_id",
                    lookup("course_name", COURSE_SHORT).alias("course_short"),
                    "reviewed", "total_assg", (F.col("total_assg") - F.col("reviewed")).alias("pending"))


def score_summary(g: Gold) -> DataFrame:
    """Per LMS row KC % and test %, with the display strings."""
    j = with_scores(g.fact_lms).join(course_dim(g), "course_id")
    return j.select("lms_row_id", "intern_id", "course_name", "kc_pct", "test_pct",
                    dash_if_nonpositive(F.col("kc_pct")).alias("kc_display"),
                    dash_if_nonpositive(F.col("test_pct")).alias("test_display"))


def progress_heatmap(g: Gold) -> DataFrame:
    """Intern x course mean progress, one row per cell that has data
    (a missing cell reads as 0), so the course list may be of any length."""
    per = g.fact_lms_light.groupBy("intern_id", "course_id").agg(F.avg("progress").alias("progress"))
    return per.join(course_dim(g), "course_id").select("intern_id", lookup("course_name", COURSE_SHORT).alias("course"), "progress")


def score_distribution(g: Gold) -> DataFrame:
    """Box summary of KC % and test % over scores > 0 (stacked long):
    n, mean, population sd, min, quartiles, max."""
    s = with_scores(g.fact_lms)
    long = s.select(F.explode(F.array(
        F.struct(F.lit("kc_pct").alias("metric"), F.col("kc_pct").alias("v")),
        F.struct(F.lit("test_pct").alias("metric"), F.col("test_pct").alias("v")))).alias("x")
    ).select("x.metric", "x.v").where(F.col("v") > 0)
    long = materialize(long, "scores")  # read by the moments and by the quantiles
    # Exact sums of the 1-decimal values: the moments do not depend on order.
    t = exact_units(F.col("v"), 1)
    s1 = F.sum(t) / F.lit(10.0)
    s2 = F.sum(t * t) / F.lit(100.0)
    n = F.count(F.lit(1))
    mom = long.groupBy("metric").agg(
        n.alias("n"), (s1 / n).alias("mean"),
        F.sqrt(F.greatest((s2 - s1 * s1 / n) / n, F.lit(0.0))).alias("sd"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    q = exact_quantiles(long, "v", [0.25, 0.5, 0.75], ["q1", "median", "q3"], group=["metric"])
    out = mom.join(q, "metric")
    return out.select("metric", "n", round_half_even(F.col("mean"), 6).alias("mean"),
                      round_half_even(F.col("sd"), 6).alias("sd"), "min",
                      round_half_even(F.col("q1"), 6).alias("q1"), round_half_even(F.col("median"), 6).alias("median"),
                      round_half_even(F.col("q3"), 6).alias("q3"), "max")


def progress_by_course(g: Gold) -> DataFrame:
    """Each LMS row with intern first name and course short name."""
    j = g.fact_lms_light.join(g.dim_intern, "intern_id").join(course_dim(g), "course_id")
    return j.select("lms_row_id", "intern_id", "intern_name", first_token("intern_name").alias("first_name"),
                    initials("intern_name").alias("initials"),
                    lookup("course_name", COURSE_SHORT).alias("course_short"), "progress",
                    progress_band(F.col("progress")).alias("progress_band"))


def course_assignment_detail(g: Gold) -> DataFrame:
    """B16 detail: per LMS row pending, completion %, KC / test display."""
    s = with_scores(g.fact_lms).join(g.dim_intern, "intern_id").join(course_dim(g), "course_id")
    comp = round_half_even(F.col("reviewed") / zero_to_one(F.col("total_assg")) * 100, 0).cast("int")
    return s.select("lms_row_id", "intern_name", "course_name", "reviewed", "total_assg",
                    (F.col("total_assg") - F.col("reviewed")).alias("pending"), "overall_status",
                    comp.alias("completion_pct"), fmt_pct0(F.col("progress")).alias("progress_display"),
                    dash_if_nonpositive(F.col("kc_pct")).alias("kc_display"),
                    dash_if_nonpositive(F.col("test_pct")).alias("test_display"))


def course_panel_kpis(g: Gold) -> DataFrame:
    """B16 KPIs for every (mentor, course): rows, mean progress, status counts,
    assignment sums, mean KC / test over scores > 0.

    LMS rows are first reduced to one row per (intern, course) with
    decomposable partial sums; only that goes through the mentor bridge.
    """
    s = with_scores(g.fact_lms)
    st = F.col("overall_status")
    kc, te = F.col("kc_pct"), F.col("test_pct")
    per = s.groupBy("intern_id", "course_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum("progress").alias("sp"),
        F.count_if(st == "Completed").alias("c"), F.count_if(st.isin(*IN_PROGRESS)).alias("ip"),
        F.count_if(st.isin(*NOT_STARTED)).alias("ns"),
        F.sum("reviewed").alias("r"), F.sum("total_assg").alias("t"),
        F.sum(F.when(kc > 0, exact_units(kc, 1))).alias("kcs"), F.count_if(kc > 0).alias("kcn"),
        F.sum(F.when(te > 0, exact_units(te, 1))).alias("tes"), F.count_if(te > 0).alias("ten"))
    j = per.join(g.bridge, "intern_id")
    agg = j.groupBy("mentor_name", "course_id").agg(
        F.sum("n").alias("n_rows"), (F.sum("sp") / F.sum("n")).alias("avg_progress"),
        F.sum("c").alias("completed"), F.sum("ip").alias("in_progress"), F.sum("ns").alias("not_started"),
        F.sum("r").alias("total_reviewed"), F.sum("t").alias("total_assg"),
        (F.sum("kcs") / F.lit(10.0)).alias("kcs"), F.sum("kcn").alias("kcn"),
        (F.sum("tes") / F.lit(10.0)).alias("tes"), F.sum("ten").alias("ten"))
    out = agg.join(course_dim(g), "course_id")
    return out.select(
        "mentor_name", "course_id", "course_name", "n_rows", round_half_even(F.col("avg_progress"), 6).alias("avg_progress"),
        "completed", "in_progress", "not_started", "total_reviewed", "total_assg",
        F.when(F.col("kcn") > 0, round_half_even(F.col("kcs") / F.col("kcn"), 6)).otherwise(F.lit(0.0)).alias("avg_kc"),
        F.when(F.col("ten") > 0, round_half_even(F.col("tes") / F.col("ten"), 6)).otherwise(F.lit(0.0)).alias("avg_test"))


def status_by_course(g: Gold) -> DataFrame:
    """Row counts per (course, status), long form."""
    per = g.fact_lms_light.groupBy("course_id", "overall_status").agg(F.count(F.lit(1)).alias("n"))
    return per.join(course_dim(g), "course_id").groupBy("course_name", "overall_status").agg(F.sum("n").alias("n"))


# Column names are not case sensitive, so the spellings get names of their own.
STATUS_COLUMNS = (("Completed", "completed"), ("In Progress", "in_progress"), ("In progress", "in_progress_2"),
                  ("Not started", "not_started_2"), ("Not Started", "not_started"))


def status_pivot(g: Gold) -> DataFrame:
    """Course x status counts, one column per status spelling of the sheets
    and one for all others, missing = 0."""
    other = ~F.coalesce(F.col("overall_status").isin(*STATUS_VALUES), F.lit(False))
    cols = [*[F.sum(F.when(F.col("overall_status") == s, F.col("n")).otherwise(0)).alias(c) for s, c in STATUS_COLUMNS],
            F.sum(F.when(other, F.col("n")).otherwise(0)).alias("other")]
    return status_by_course(g).groupBy("course_name").agg(*cols)


def course_scoreboard(g: Gold) -> DataFrame:
    """Each intern's courses with short label, status style and 'r/t'."""
    j = g.fact_lms.join(course_dim(g), "course_id")
    short = F.replace(F.replace(F.col("course_name"), F.lit("Data Processing using "), F.lit("")),
                      F.lit(" & Pandas"), F.lit("/Pandas"))
    style = (F.when(F.col("overall_status") == "Completed", "done")
              .when(F.col("overall_status").isin(*IN_PROGRESS), "active").otherwise("waiting"))
    return j.select("lms_row_id", "intern_id", "course_name", short.alias("course_label"), "progress",
                    "overall_status", style.alias("status_style"),
                    fmt_ratio(F.col("reviewed"), F.col("total_assg")).alias("assignments"))


def course_vs_cohort(g: Gold) -> DataFrame:
    """Each LMS row's progress against the course mean, with the gap text."""
    # The means join the course dimension first; the facts meet one small table.
    dim = small_side(course_dim(g).join(course_avg_progress(g), "course_name", "left"), "course_means")
    j = g.fact_lms_light.join(dim, "course_id")
    coh = F.coalesce(F.col("avg_progress"), F.lit(0.0))
    delta = F.col("progress") - coh
    arrow = F.when(delta >= 0, F.lit("🟢 +")).otherwise(F.lit("🔴 "))
    return j.select(
        "lms_row_id", "intern_id",
        F.replace(F.col("course_name"), F.lit("Data Processing using "), F.lit("")).alias("course"),
        fmt_pct0(F.col("progress")).alias("my_progress"), fmt_pct0(coh).alias("cohort_avg"),
        F.concat(arrow, F.format_string("%.1f%%", round_half_even(F.abs(delta), 1))).alias("gap"),
        "overall_status")
