"""Registry of the queries exposed to the driver: key -> (spark, sf_dir) -> DataFrame.

Keys are the survey id in lower case plus a name. Every query reads the
shared tables of ``sf_dir`` in full; parameters that the analytics take
(viewer, regex pattern, cut-off date) are fixed here or derived from the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortlens.plans import activity as act
from cohortlens.plans import etl, intern, lms, maintain, mentor, presence, risk, rollup, sketches
from cohortlens.sources.bindings import Gold

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def register(key: str, fn: Callable[[Gold], DataFrame]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Gold(spark, sf_dir))
    run.__name__ = key
    run.__doc__ = fn.__doc__
    QUERIES[key] = run


def _first_intern(g: Gold):
    """The viewer for W07: the lowest intern id with activity (data-derived)."""
    return g.fact_activity.agg(F.min("intern_id")).scalar()


# --- risk ------------------------------------------------------------------
register("b04_dropout_risk", lambda g: risk.dropout_risk(g))
register("b04_risk_after_changes", lambda g: maintain.risk_after_changes(g))

# --- activity --------------------------------------------------------------
register("a02_total_hours", act.total_hours)
register("a03_daily_outliers", act.outlier_days)
register("a04_daily_stats", act.daily_stats)
register("a05_activity_share", lambda g: act.activity_hours(g, ("intern_id",)))
register("a05_cohort_activity_share", lambda g: act.activity_hours(g, ()))
register("a06_date_activity_hours", act.date_activity_hours)
register("a07_weekly_hours", lambda g: act.weekly_hours(g, ("intern_id",)))
register("a07_cohort_weekly_hours", lambda g: act.weekly_hours(g, ()))
# the views over a chosen range of dates; the filter reaches the scan.
RANGE = act.Params(start="2024-01-08", end="2024-01-21")
register("f05_dropout_risk_range", lambda g: risk.dropout_risk(g, RANGE))
register("f05_activity_share_range", lambda g: act.activity_hours(g, ("intern_id",), RANGE))
register("f05_daily_hours_range", lambda g: act.daily_hours(g, RANGE))
register("f05_weekly_hours_range", lambda g: act.weekly_hours(g, ("intern_id",), RANGE))
register("c10_range_summary", lambda g: act.range_summary(g, RANGE))
register("c10_range_rollup", lambda g: rollup.range_summary(rollup.session_rollup(g), RANGE))
register("a07_weekly_hours_by_year", lambda g: act.weekly_hours(g, ("intern_id",), with_year=True))
register("a19_cohort_activity_mean", act.cohort_activity_mean)
register("b05_weekly_trend", act.weekly_trend_pivot)
register("b10_weekly_with_cohort", act.weekly_with_cohort)
register("b12_activity_by_mentor", act.activity_by_mentor)
register("b15_cohort_weekly_band", act.cohort_weekly_band)
register("b27_top_activity_week", act.top_activity_last_week)
register("b31_daily_activity_pivot", act.daily_activity_pivot)
register("w02_streak_stats", act.streak_stats)
register("w02_streaks_rollup", lambda g: rollup.streak_stats(rollup.session_rollup(g)))
register("f05_streaks_range", lambda g: rollup.streak_stats(rollup.session_rollup(g), RANGE))
register("r05_streak_calendar", act.streak_calendar)

# Distinct counts and quantiles over chosen dates, from what is stored per block of days.
register("a14_active_interns_range", lambda g: presence.active(presence.session_sets(g), presence.COHORT, RANGE))
register("a14_activity_interns_range", lambda g: presence.active(presence.session_sets(g), presence.ACTIVITY, RANGE))
register("b20_mentor_retention_range", lambda g: presence.retention(presence.session_sets(g), presence.MENTOR, RANGE))
register("a16_activity_median_range", lambda g: sketches.activity_quantile(g, RANGE, 0.5))
register("a16_activity_p90_range", lambda g: sketches.activity_quantile(g, RANGE, 0.9))

# --- LMS -------------------------------------------------------------------
register("a01_course_avg_progress", lms.course_avg_progress)
register("b06_pending_reviews", lms.pending_reviews)
register("b07_score_summary", lms.score_summary)
register("b08_progress_heatmap", lms.progress_heatmap)
register("b11_score_distribution", lms.score_distribution)
register("b13_progress_by_course", lms.progress_by_course)
register("b16_course_detail", lms.course_assignment_detail)
register("b16_course_kpis", lms.course_panel_kpis)
register("b21_status_by_course", lms.status_by_course)
register("r04_status_pivot", lms.status_pivot)
register("b34_course_scoreboard", lms.course_scoreboard)
register("b35_course_vs_cohort", lms.course_vs_cohort)

# --- intern ----------------------------------------------------------------
register("a16_cohort_hour_quantiles", intern.cohort_hour_stats)
register("w01_hours_rank", intern.hours_rank)
register("w01_mentor_hours_rank", intern.mentor_hours_rank)
register("w07_masked_leaderboard", lambda g: intern.masked_leaderboard(g, _first_intern(g)))
register("b14_effort_vs_progress", intern.effort_vs_progress)
register("b14_trend_line", intern.effort_trend_line)
register("b17_intern_range_panel", intern.intern_range_panel)
register("b17_intern_range_panel_range", lambda g: intern.intern_range_panel(g, RANGE))
register("b18_deep_dive", intern.deep_dive)
register("b25_skill_intensity", intern.skill_intensity)
register("b26_cohort_skill_intensity", intern.cohort_skill_intensity)
register("b28_outlook_badge", intern.outlook_badge)
register("b29_banner", intern.banner)
register("b30_radar_profile", intern.radar_profile)
register("b33_activity_benchmark", intern.activity_benchmark)
register("b36_kpi_strip", intern.kpi_strip)

# --- mentor ----------------------------------------------------------------
register("f04_regex_cohort", lambda g: mentor.cohort_by_regex(g, "NATION_1"))
register("a15_mentor_courses", mentor.mentor_courses)
register("b09_risk_register", mentor.risk_register)
register("t02_top_risk", mentor.top_risk)
register("b19_action_items", mentor.action_items)
register("b19_urgent_names", mentor.urgent_names)
register("b20_mentor_kpis", mentor.mentor_kpis)
register("b23_mentor_calendar", mentor.mentor_calendar)
register("b24_profile_list", mentor.profile_list)
register("b38_intervention_plan", mentor.intervention_plan)

# --- bronze -> gold ----------------------------------------------------------
register("b01_dim_intern", lambda g: etl.star_schema(g)["dim_intern"])
register("b01_dim_course", lambda g: etl.star_schema(g)["dim_course"])
register("b01_dim_mentor", lambda g: etl.star_schema(g)["dim_mentor"])
register("b01_fact_lms", lambda g: etl.star_schema(g, materialized=True)["fact_lms"])
register("b01_fact_activity", lambda g: etl.star_schema(g)["fact_activity"])
register("b01_key_collisions", etl.key_collisions)
register("b02_dim_intern_seq", lambda g: etl.star_schema_sequential(g)["dim_intern"])
register("b02_fact_progress", lambda g: etl.star_schema_sequential(g)["fact_progress"])
register("b02_dim_course_seq", lambda g: etl.star_schema_sequential(g)["dim_course"])
register("b02_fact_effort", lambda g: etl.star_schema_sequential(g)["fact_effort"])
register("b03_quality_report", etl.quality_report)
register("u02_merge_new", etl.merged_lms)
register("b40_validate_output", etl.validate_output)

# --- profiles ------------------------------------------------------------------
from cohortlens.plans import ml, profile  # noqa: E402

register("b37_cohort_summary", profile.cohort_summary)
register("b37_course_list", profile.course_list)
register("t03_top_bottom_interns", profile.top_bottom_interns)
register("t04_sample_rows", profile.sample_rows)
register("c25_summary_json", profile.summary_json)
register("b39_progress_per_course", profile.progress_per_course)
register("b39_status_shares", profile.status_shares)
register("b39_ratio_profile", profile.ratio_profile)
register("b39_activity_shares", profile.activity_shares)
register("b39_mentors_per_course", profile.mentors_per_course)
register("b39_completed_values", profile.completed_assignment_values)
register("b39_total_values", profile.total_values)
register("b39_eod_profile", profile.eod_profile)
register("b41_status_mix", profile.status_mix)
register("b41_generation_summary", profile.generation_summary)

# --- machine learning ------------------------------------------------------------
register("m01_features", ml.features)
register("m02_clusters", ml.clusters)
register("m03_test_score_model", ml.test_score_model)
register("m04_dropout_model", ml.dropout_model)

# --- streaming -------------------------------------------------------------------
from cohortlens.streaming import landing  # noqa: E402

QUERIES["st1_incremental_landing"] = lambda spark, sf_dir: landing.landed_activity(spark, sf_dir)
QUERIES["st1_incremental_landing"].__doc__ = landing.landed_activity.__doc__
from cohortlens.streaming import checked_landing, effort, indexed_landing  # noqa: E402

QUERIES["st1_daily_effort"] = lambda spark, sf_dir: effort.streamed_outlier_days(spark, sf_dir)
QUERIES["st1_weekly_effort"] = lambda spark, sf_dir: effort.streamed_weekly_hours(spark, sf_dir)
register("u02_merge_indexed", indexed_landing.merged_by_index)
register("b03_landing_checks", checked_landing.landing_checks)
register("b42_daily_landing_eod", lambda g: landing.export_and_land(g, "eod"))
register("b42_daily_landing_lms", lambda g: landing.export_and_land(g, "lms"))

# --- reload views and set checks ------------------------------------------------------
from cohortlens.plans import reload  # noqa: E402

register("w05_latest_lms_rows", reload.latest_lms_rows)
register("b43_dim_mentor_from_facts", reload.dim_mentor_from_facts)
register("b43_outlier_count", reload.outlier_count)
register("s09_clustered_range", lambda g: reload.clustered_daily_hours(g, RANGE))
register("u03_unknown_statuses", reload.unknown_statuses)
register("u04_name_union", reload.name_union)
register("f09_signed_in_mentor", lambda g: reload.signed_in_mentor_dim(g, g.dim_mentor.agg(F.min("mentor_name")).scalar()))
