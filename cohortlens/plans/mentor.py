"""Mentor-facing analytics for every mentor at once (A15, B09, B19, B20, B23,
B24, B38, F02/F04).

A mentor's cohort is the set of interns with an LMS row naming the mentor
(``bridge_mentor_intern``). Per-intern results are computed once and then
fanned out over the bridge, always after aggregating to one row per intern.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.fmt import fmt_pct0, fmt_score
from cohortlens.functions.numeric import round_half_even
from cohortlens.functions.text import contains_regex, first_token
from cohortlens.plans.activity import total_hours
from cohortlens.plans.common import NOT_STARTED, Params, course_dim, hours_sum
from cohortlens.plans.lms import pending_reviews
from cohortlens.plans.risk import dropout_risk
from cohortlens.sources.bindings import Gold

# Action cards (title, text) shown to a mentor.
CARD_URGENT = ("🚨 Urgent: At-Risk Interns", "%d intern(s) need immediate check-in")
CARD_BACKLOG = ("📝 Review Backlog",
                "**%d assignments** are awaiting your review across %d intern-course combinations.")
CARD_MEDIUM = ("⚡ Medium Risk Watch", "%d interns are trending downward in effort. Consider a group check-in.")
CARD_CLEAR = ("✅ All Clear!", "No urgent action items. Your cohort is performing well!")
# Intervention plans by tier (name, progress, hours): our own wording.
PLAN_HIGH = ("%s needs help now: mean progress %s after %s of logged effort. "
             "Meet today, agree on one small next step per open course, and find a study partner in the cohort.")
PLAN_MEDIUM = ("%s is slowing down: mean progress %s after %s of logged effort. "
               "Ask in writing what is blocking, suggest the assignment closest to done, and look again in three days.")
PLAN_LOW = ("%s is doing fine: mean progress %s after %s of logged effort. "
            "Say so, and offer a task that lets others learn from it.")

# Risk badges and action-item thresholds.
RISK_ICON = {"High": "🔴", "Medium": "🟡", "Low": "🟢"}
BACKLOG_MIN_PENDING = 5
MEDIUM_WATCH_MIN = 2
TOP_RISK_N = 12


def cohort_by_regex(g: Gold, pattern: str) -> DataFrame:
    """interns with any LMS row whose raw mentor string matches ``pattern``
    as an unanchored regex (the sheet's behaviour: 'Raj' also finds 'Rajesh')."""
    m = g.fact_lms_mentor.where(contains_regex("mentor_name", pattern))
    return m.select("intern_id").distinct()


def mentor_courses(g: Gold) -> DataFrame:
    """The distinct courses each mentor's cohort is enrolled in."""
    per = g.fact_lms_light.select("intern_id", "course_id").distinct()
    j = per.join(g.bridge, "intern_id").select("mentor_name", "course_id").distinct()
    return j.join(course_dim(g), "course_id").select("mentor_name", "course_name")


def risk_register(g: Gold, p: Params | None = None) -> DataFrame:
    """Risk rows per mentor cohort with the display columns."""
    r = dropout_risk(g, p)
    j = r.join(g.bridge, "intern_id")
    icon = F.create_map(*[F.lit(x) for kv in RISK_ICON.items() for x in kv])
    return j.select("mentor_name", "intern_id", "intern_name", "risk_score", "risk_level",
                    F.concat(F.try_element_at(icon, F.col("risk_level")), F.lit(" "), F.col("risk_level")).alias("risk_label"),
                    fmt_score(F.col("risk_score")).alias("score_label"),
                    fmt_pct0(F.col("avg_progress")).alias("progress_label"))


def top_risk(g: Gold, p: Params | None = None, n: int = TOP_RISK_N) -> DataFrame:
    """The ``n`` highest risk scores over all interns (intern_id breaks
    ties). The limit is the feature; Spark plans it as TakeOrderedAndProject,
    a per-partition top-n and a merge of n rows per partition."""
    r = dropout_risk(g, p)
    return r.orderBy(F.desc("risk_score"), F.asc("intern_id")).limit(n).select(
        "intern_id", "intern_name", "risk_score", "prog_risk", "effort_risk", "assg_lag", "recency_risk")


def mentor_kpis(g: Gold, p: Params | None = None) -> DataFrame:
    """The KPI header of every mentor: cohort size, status counts over all
    LMS rows of the cohort, mean progress, hours, high-risk count, pending."""
    st = F.col("overall_status")
    lms = g.fact_lms.groupBy("intern_id").agg(
        F.count_if(st == "Completed").alias("c"), F.count_if(st == "In Progress").alias("ip"),
        F.count_if(st.isin(*NOT_STARTED)).alias("ns"), F.sum("progress").alias("sp"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.greatest(F.col("total_assg") - F.col("reviewed"), F.lit(0))).alias("pending"))
    th = total_hours(g, p)
    risk = dropout_risk(g, p).select("intern_id", (F.col("risk_level") == "High").cast("int").alias("hi"))
    per = lms.join(th, "intern_id", "left").join(risk, "intern_id", "left")
    j = per.join(g.bridge, "intern_id")
    return j.groupBy("mentor_name").agg(
        F.count(F.lit(1)).alias("n_interns"), F.sum("c").alias("completed"), F.sum("ip").alias("in_progress"),
        F.sum("ns").alias("not_started"),
        round_half_even(F.sum("sp") / F.sum("n"), 6).alias("avg_progress"),
        F.coalesce(hours_sum("total_hours"), F.lit(0.0)).alias("total_hours"),
        F.sum("hi").alias("high_risk"), F.sum("pending").alias("total_pending"))


def action_items(g: Gold, p: Params | None = None) -> DataFrame:
    """The action cards of every mentor (urgent list, review backlog,
    medium-risk watch, else all clear), one row per card."""
    r = dropout_risk(g, p).join(g.bridge, "intern_id")
    pend = pending_reviews(g).groupBy("intern_id").agg(
        F.sum("pending").alias("pending"), F.count(F.lit(1)).alias("pairs"))
    # The names on the urgent card are the rows of ``urgent_names``, never
    # gathered into one list per mentor.
    per_mentor_risk = r.groupBy("mentor_name").agg(
        F.count_if(F.col("risk_level") == "High").alias("n_high"),
        F.count_if(F.col("risk_level") == "Medium").alias("n_medium"))
    per_mentor_pend = pend.join(g.bridge, "intern_id").groupBy("mentor_name").agg(
        F.sum("pending").alias("total_pending"), F.sum("pairs").alias("pairs"))
    m = per_mentor_risk.join(per_mentor_pend, "mentor_name", "left")
    tp = F.coalesce(F.col("total_pending"), F.lit(0))
    def card(order, key, spec, text):
        return F.struct(F.lit(order).alias("ord"), F.lit(key).alias("card"), F.lit(spec[0]).alias("title"),
                        text.alias("text"))
    cards = F.array_compact(F.array(
        F.when(F.col("n_high") > 0, card(1, "urgent", CARD_URGENT, F.format_string(CARD_URGENT[1], F.col("n_high")))),
        F.when(tp > BACKLOG_MIN_PENDING, card(2, "backlog", CARD_BACKLOG, F.format_string(
            CARD_BACKLOG[1], tp, F.coalesce(F.col("pairs"), F.lit(0))))),
        F.when(F.col("n_medium") > MEDIUM_WATCH_MIN,
               card(3, "medium_watch", CARD_MEDIUM, F.format_string(CARD_MEDIUM[1], F.col("n_medium"))))))
    cards = F.when(F.size(cards) == 0, F.array(card(4, "all_clear", CARD_CLEAR, F.lit(CARD_CLEAR[1])))).otherwise(cards)
    return m.select("mentor_name", F.explode(cards).alias("x")).select("mentor_name", "x.ord", "x.card", "x.title", "x.text")


def urgent_names(g: Gold, p: Params | None = None) -> DataFrame:
    """The first names on each mentor's urgent card, one row per high-risk
    intern."""
    r = dropout_risk(g, p).where(F.col("risk_level") == "High").join(g.bridge, "intern_id")
    return r.select("mentor_name", "intern_id", first_token("intern_name").alias("first_name"), "risk_score")


def mentor_calendar(g: Gold, p: Params | None = None) -> DataFrame:
    """Hours per (mentor, intern, ISO week), long form."""
    from cohortlens.plans.activity import weekly_hours
    wk = weekly_hours(g, ("intern_id",), p)
    return wk.join(g.bridge, "intern_id").select("mentor_name", "intern_id", "week", "hours")


def profile_list(g: Gold, p: Params | None = None) -> DataFrame:
    """Each mentor's interns with risk level/score, mean progress and
    hours as one set-based plan (no per-intern loop)."""
    r = dropout_risk(g, p).select("intern_id", "intern_name", "risk_level", "risk_score", "avg_progress")
    th = total_hours(g, p)
    j = g.bridge.join(r, "intern_id", "left").join(th, "intern_id", "left")
    hours = F.coalesce(F.col("total_hours"), F.lit(0.0))
    return j.select("mentor_name", "intern_id", "intern_name", F.coalesce(F.col("risk_level"), F.lit("Low")).alias("risk_level"),
                    F.coalesce(F.col("risk_score"), F.lit(0.0)).alias("risk_score"),
                    F.coalesce(fmt_pct0(F.col("avg_progress")), F.lit("—")).alias("progress_label"),
                    F.format_string("%.0f hrs", round_half_even(hours, 0)).alias("hours_label"))


def intervention_plan(g: Gold, p: Params | None = None) -> DataFrame:
    """The template intervention plan of every intern, keyed like the
    deep-dive view: progress < 40 High, > 70 Low, else Medium, with progress
    as '%.0f%%' and hours as '%.0f hrs'."""
    lms = g.fact_lms.groupBy("intern_id").agg(F.avg("progress").alias("avg_progress"))
    th = total_hours(g, p)
    j = lms.join(th, "intern_id", "left").join(g.dim_intern, "intern_id", "left")
    ap = F.col("avg_progress")
    tier = F.when(ap < 40, "High").when(ap > 70, "Low").otherwise("Medium")
    name = F.coalesce(F.col("intern_name"), F.lit("Unknown"))
    prog = F.coalesce(fmt_pct0(ap), F.lit("nan%"))
    hrs = F.format_string("%.0f hrs", round_half_even(F.coalesce(F.col("total_hours"), F.lit(0.0)), 0))
    text = (F.when(tier == "High", F.format_string(PLAN_HIGH, name, prog, hrs))
             .when(tier == "Medium", F.format_string(PLAN_MEDIUM, name, prog, hrs))
             .otherwise(F.format_string(PLAN_LOW, name, prog, hrs)))
    return j.select("intern_id", tier.alias("risk_level"), text.alias("plan_text"))

