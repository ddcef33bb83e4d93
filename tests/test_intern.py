"""Skill intensity, at-risk label, ranks and badges (FIXTURES.md section 4)."""

import datetime as dt

from cohortlens.plans import intern, ml
from cohortlens.sources.bindings import Gold
from tests.helpers import act_rows, courses, lms_rows, names

DAY = dt.date(2026, 2, 1)


def test_skill_intensity_worked_example(spark):
    # progress 80, hours 30, cohort median 20, 3 of 4 reviewed -> 85.0
    lms = lms_rows(spark, [(1, "C", 80.0, 3, 4, "In Progress"), (2, "C", 10.0, 0, 4, "Not Started"),
                           (3, "C", 10.0, 0, 4, "Not Started")])
    act = act_rows(spark, [(1, DAY, "a", 30), (2, DAY, "a", 20), (3, DAY, "a", 10)])
    g = Gold.from_frames(spark, fact_lms=lms, fact_activity=act, dim_intern=names(spark, [1, 2, 3]),
                         dim_course=courses(spark, ["C"]))
    got = {r.intern_id: r.skill_score for r in intern.skill_intensity(g).collect()}
    assert got[1] == 85.0
    stats = intern.cohort_hour_stats(g).first()
    assert stats.median_hours == 20.0 and stats.p25_hours == 15.0


def test_at_risk_label(spark):
    # (39, any) -> 1; (40, h >= 0.75 median) -> 0; (59, 0.74 median) -> 1; (60, 0) -> 0
    lms = lms_rows(spark, [(1, "C", 39.0, 0, 1, "x"), (2, "C", 40.0, 0, 1, "x"), (3, "C", 59.0, 0, 1, "x"),
                           (4, "C", 60.0, 0, 1, "x")])
    act = act_rows(spark, [(1, DAY, "a", 100), (2, DAY, "a", 100), (3, DAY, "a", 74), (4, DAY, "a", 0.01),
                           (5, DAY, "a", 100), (6, DAY, "a", 100), (7, DAY, "a", 100)])
    g = Gold.from_frames(spark, fact_lms=lms, fact_activity=act, dim_intern=names(spark, range(1, 8)),
                         dim_course=courses(spark, ["C"]))
    got = {r.intern_id: r.is_at_risk for r in ml.features(g).collect()}
    assert got == {1: 1, 2: 0, 3: 1, 4: 0}


def test_rank_and_masked_leaderboard(spark):
    lms = lms_rows(spark, [(i, "C", 50.0, 1, 2, "In Progress") for i in range(1, 6)])
    act = act_rows(spark, [(1, DAY, "a", 5), (2, DAY, "a", 9), (3, DAY, "a", 9), (4, DAY, "a", 1)])
    g = Gold.from_frames(spark, fact_lms=lms, fact_activity=act, dim_intern=names(spark, range(1, 6)),
                         dim_course=courses(spark, ["C"]))
    ranks = {r.intern_id: (r.rank, r.rank_label) for r in intern.hours_rank(g).collect()}
    assert ranks == {2: (1, "#1 of 4"), 3: (2, "#2 of 4"), 1: (3, "#3 of 4"), 4: (4, "#4 of 4")}
    board = {r.rank_label: r.name for r in intern.masked_leaderboard(g, 3).collect()}
    assert board == {"#1": "Intern #1", "#2": "⭐ Intern 3 (You)", "#3": "Intern #3", "#4": "Intern #4"}
    kpi = {r.intern_id: r.rank_label for r in intern.kpi_strip(g).collect()}
    assert kpi[5] == "N/A"                                # no activity -> no rank


def test_badge_order(spark):
    lms = lms_rows(spark, [(1, "C", 90.0, 1, 1, "Completed"), (2, "C", 20.0, 1, 1, "Completed"),
                           (3, "C", 20.0, 0, 1, "In Progress"), (4, "C", 50.0, 0, 1, "In Progress")])
    act = act_rows(spark, [(1, DAY, "a", 50), (2, DAY, "a", 1), (3, DAY, "a", 0.5), (4, DAY, "a", 40)])
    g = Gold.from_frames(spark, fact_lms=lms, fact_activity=act, dim_intern=names(spark, range(1, 5)),
                         dim_course=courses(spark, ["C"]))
    got = {r.intern_id: r.badge_type for r in intern.outlook_badge(g).collect()}
    assert got == {1: "success", 2: "success", 3: "error", 4: "info"}
    banner = {r.intern_id: r.banner_type for r in intern.banner(g).collect()}
    assert banner[1] == "success" and banner[3] == "warning"
