"""Dropout risk on the hand-worked cases R1-R5 (FIXTURES.md section 4)."""

import datetime as dt

import pytest

from cohortlens.plans import mentor, risk
from cohortlens.sources.bindings import Gold
from tests.helpers import act_rows, courses, lms_rows, mentors, names

M = dt.date(2026, 3, 1)


def d(days_before):
    return M - dt.timedelta(days=days_before)


@pytest.fixture(scope="module")
def gold(spark):
    lms = lms_rows(spark, [
        (1, "CRS-000", 80.0, 4, 4, "Completed"),     # R1 steady
        (2, "CRS-000", 25.0, 1, 4, "In Progress"),   # R2 falling
        (3, "CRS-000", 40.0, 2, 4, "In Progress"),   # R3 newly active
        (4, "CRS-000", 50.0, 0, 0, "Not Started"),   # R4 no activity rows
        (5, "CRS-000", 60.0, 4, 4, "Completed"),     # R5 dormant
    ])
    act = act_rows(spark, [
        (1, d(0), "SQL Revision", 20), (1, d(20), "SQL Revision", 20),
        (2, d(4), "SQL Revision", 5), (2, d(20), "SQL Revision", 10),
        (3, d(1), "SQL Revision", 3),
        (5, d(40), "SQL Revision", 5),
    ])
    return Gold.from_frames(spark, fact_lms=lms, fact_activity=act, dim_intern=names(spark, [1, 2, 3, 4]),
                            dim_course=courses(spark, ["CRS-000"]),
                            intern_mentors=mentors(spark, [(i, "Asha Rao, Raj") for i in range(1, 6)]))


def test_hand_worked_scores(gold):
    got = {r["intern_id"]: r for r in risk.dropout_risk(gold).collect()}
    expect = {  # prog, effort, assg, recency, score, level
        1: (0.0, 0.0, 0.0, 0.0, 0.0, "Low"),
        2: (20.0, 15.0, 15.0, 6.0, 56.0, "High"),
        3: (8.0, 15.0, 10.0, 1.5, 34.5, "Medium"),
        4: (0.0, 30.0, 20.0, 10.0, 60.0, "High"),
        5: (0.0, 30.0, 0.0, 10.0, 40.0, "Medium"),
    }
    for iid, (p, e, a, r, s, lvl) in expect.items():
        row = got[iid]
        assert (row.prog_risk, row.effort_risk, row.assg_lag, row.recency_risk) == (p, e, a, r), iid
        assert row.risk_score == s and row.risk_level == lvl, iid


def test_unknown_name_and_bounds(gold):
    rows = risk.dropout_risk(gold).collect()
    assert {r.intern_name for r in rows if r.intern_id == 5} == {"Unknown"}
    assert all(0 <= r.risk_score <= 100 for r in rows)


def test_mentor_views(gold):
    kpis = mentor.mentor_kpis(gold).collect()
    assert {r.mentor_name for r in kpis} == {"Asha Rao", "Raj"}
    raj = [r for r in kpis if r.mentor_name == "Raj"][0]
    assert raj.n_interns == 5 and raj.high_risk == 2 and raj.total_pending == 3 + 2
    cards = {(r.mentor_name, r.card) for r in mentor.action_items(gold).collect()}
    assert ("Raj", "urgent") in cards and ("Raj", "backlog") not in cards
    top = mentor.top_risk(gold, n=2).collect()
    assert [r.intern_id for r in top] == [4, 2]
