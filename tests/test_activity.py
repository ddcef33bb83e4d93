"""Effort analytics: outliers, windows, streaks, calendar, top activity (FIXTURES.md section 2)."""

import datetime as dt

from pyspark.sql import functions as F

from cohortlens.plans import activity as act
from cohortlens.plans import risk
from cohortlens.sources.bindings import Gold
from tests.helpers import act_rows, courses, lms_rows, names

D = dt.date


def gold(spark, rows):
    ids = sorted({r[0] for r in rows})
    return Gold.from_frames(spark, fact_activity=act_rows(spark, rows), dim_intern=names(spark, ids),
                            fact_lms=lms_rows(spark, [(i, "C", 50.0, 1, 2, "In Progress") for i in ids]),
                            dim_course=courses(spark, ["C"]))


def test_outlier_boundary(spark):                     # A03: 12.0 is not an outlier, 12.1 is
    g = gold(spark, [(1, D(2026, 2, 3), "a", 6.0), (1, D(2026, 2, 3), "b", 6.0),
                     (2, D(2026, 2, 3), "a", 6.0), (2, D(2026, 2, 3), "b", 6.1)])
    got = {r.intern_id: r.is_outlier for r in act.outlier_days(g).collect()}
    assert got == {1: False, 2: True}


def test_window_edges(spark):                         # A09: [M-14, M] and [M-28, M-14)
    m = D(2026, 3, 1)
    rows = [(1, m, "a", 1.0), (1, m - dt.timedelta(14), "a", 2.0), (1, m - dt.timedelta(15), "a", 4.0),
            (1, m - dt.timedelta(28), "a", 8.0), (1, m - dt.timedelta(29), "a", 16.0)]
    w = risk.activity_windows(gold(spark, rows).fact_activity).first()
    assert (w.recent_hours, w.prev_hours, w.days_since, w.total_hours) == (3.0, 12.0, 0, 31.0)


def test_longest_streak_and_calendar(spark):          # W02: run of 3, gap, run of 2 -> 3
    days = [D(2026, 1, 5), D(2026, 1, 6), D(2026, 1, 7), D(2026, 1, 9), D(2026, 1, 10)]
    g = gold(spark, [(1, d, "a", 1.0) for d in days] + [(1, D(2026, 1, 6), "b", 2.0)])
    s = act.streak_stats(g).first()
    assert (s.longest_streak, s.active_days, s.best_day_hours) == (3, 5, 3.0)
    cal = act.streak_calendar(g).collect()
    assert len(cal) == 7 and sum(r.hours for r in cal) == 7.0   # one full ISO week, gaps filled with 0
    assert {r.dow for r in cal} == set(range(7))


def test_top_activity_tie_goes_to_first_name(spark):  # D16
    g = gold(spark, [(1, D(2026, 1, 10), "Zeta", 3.0), (1, D(2026, 1, 10), "Alpha", 3.0),
                     (1, D(2025, 12, 1), "Zeta", 50.0)])
    r = act.top_activity_last_week(g).first()
    assert (r.top_activity, r.top_hours) == ("Alpha", 3.0)


def test_week_53_and_pivot(spark):                    # D14, R02
    g = gold(spark, [(1, D(2027, 1, 1), "a", 2.0), (1, D(2026, 12, 28), "a", 1.0), (2, D(2027, 1, 4), "a", 5.0)])
    wide = {r.intern_id: r.asDict() for r in act.weekly_trend_pivot(g).collect()}
    assert wide[1]["w53"] == 3.0 and wide[2]["w1"] == 5.0 and wide[2]["w53"] == 0.0


def test_shares_sum_to_one(spark):
    g = gold(spark, [(1, D(2026, 1, 1), "a", 1.0), (1, D(2026, 1, 2), "b", 3.0), (2, D(2026, 1, 1), "a", 2.0)])
    per = act.activity_hours(g, ("intern_id",)).toPandas()
    assert (per.groupby("intern_id")["share"].sum().round(12) == 1.0).all()


def test_labels_of_known_names(spark):                # C13, C14, C22: the branches the bound data never reach
    from cohortlens.plans.lms import course_scoreboard, progress_by_course
    from cohortlens.sources.bindings import Gold
    from tests.helpers import lms_rows, names
    fa = spark.createDataFrame([(1, "PySpark Session"), (2, "Data Engineering Course"), (3, "Juggling")], "i int, a string")
    got = {r.i: r.x for r in fa.select("i", act.activity_label(F.col("a")).alias("x")).collect()}
    assert got == {1: "⚡ PySpark Session", 2: "🏗️ Data Engineering C", 3: "• Juggling"}
    g = Gold.from_frames(spark, fact_lms=lms_rows(spark, [(1, "c", 50.0, 1, 2, "Completed")]), dim_intern=names(spark, [1]),
                         dim_course=spark.createDataFrame([("c", "Data Processing using NumPy & Pandas")], "course_id string, course_name string"))
    assert progress_by_course(g).first().course_short == "NumPy/Pandas"
    assert course_scoreboard(g).first().course_label == "NumPy/Pandas"
