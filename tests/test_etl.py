"""Bronze -> gold on the edge rows of FIXTURES.md sections 1-2."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from cohortlens.plans import etl
from cohortlens.sources.bindings import Gold

LMS_COLS = ["row_id", "User Name", "Course Name", "Start Date", "End Date", "Mentor Name", "Progress (%)",
            "Completed Assignment", "Reviewed / Submitted", "Overall Knowledge Check", "Overall Test",
            "Reviewed / Total Assignments", "Overall Status"]
LMS = [
    (1, " mary-jane o'neil ", "Basic SQL", "01 Jan 2026", "28 Feb 2026", "Asha Rao, Raj", "80%", "3/4", "3/4",
     "68.0 / 70.0", "80 / 100", "3/4", "Completed"),                                        # L1
    (2, "Dev Shah", "Basic SQL", "01 Jan 2026", "28 Feb 2026", "Rajesh", None, None, None, None, "0 / 0", "-", "-"),  # L2
    (3, "Dev Shah", "Basic SQL", None, None, "Rajesh", "10%", "1/4", "1/1", "1 / 2", "1 / 2", "1/4", None),  # L3
    (4, "Isha Iyer", "Basic SQL", "01 Jan 2026", "28 Feb 2026", "Raj", "120%", "5/4", "5/4", "x / y", "50", "5/4",
     "In progress"),                                                                          # L4
    (5, None, "Basic SQL", "01 Jan 2026", "28 Feb 2026", "Raj", "50%", "1/4", "1/1", "1 / 2", "1 / 2", "1/4", "Completed"),  # L5
    (6, "asha k", "Basic Python Programming", "01 Jan 2026", "28 Feb 2026", "Raj", "abc%", "1/4", "1/1", "1 / 2",
     "1 / 2", "1/4", "Not started"),                                                          # L6
]
EOD_COLS = ["row_id", "Date", "First Name", "Last Name", "Activity", "Hours"]
EOD = [
    (1, "03/02/2026", "mary-jane", "o'neil", "SQL Revision", 6.0),
    (2, "03/02/2026", "Mary-Jane", "O'Neil ", "Pandas Practice", 6.1),   # day total 12.1 -> outlier
    (3, "13/02/2026", "Dev", "Shah", "SQL Revision", 3.0),
    (4, "bad", "Dev", "Shah", "SQL Revision", 2.0),                      # unparseable date
    (5, "14/02/2026", "Isha", "Iyer", "SQL Revision", -1.0),             # invalid hours
    (6, "14/02/2026", "Ghost", "Person", "SQL Revision", 1.0),           # orphan
]


@pytest.fixture(scope="module")
def g(spark):
    lms = spark.createDataFrame(LMS, "row_id long, " + ", ".join(f"`{c}` string" for c in LMS_COLS[1:]))
    eod = spark.createDataFrame(EOD, "row_id long, `Date` string, `First Name` string, `Last Name` string, "
                                     "`Activity` string, `Hours` double")
    return Gold.from_frames(spark, bronze_lms=lms, bronze_eod=eod)


def test_silver_values(g):
    s = {r.row_id: r for r in etl.silver_lms(g.bronze_lms).collect()}
    l1 = s[1]
    assert l1.intern_name == "Mary-Jane O'Neil" and l1.progress == 80.0
    assert (l1.reviewed, l1.total_assg, l1.kc_scored, l1.kc_total) == (3, 4, 68.0, 70.0)
    l2 = s[2]
    assert (l2.progress, l2.reviewed, l2.total_assg, l2.overall_status) == (0.0, 0, 1, "Not Started")
    assert (l2.kc_scored, l2.kc_total, l2.test_scored, l2.test_total) == (0.0, 1.0, 0.0, 1.0)
    l4 = s[4]
    assert (l4.progress, l4.kc_scored, l4.kc_total, l4.test_scored, l4.test_total) == (120.0, 0.0, 1.0, 50.0, 1.0)
    assert s[5].intern_name is None and s[6].progress is None
    assert s[1].start_date == dt.date(2026, 1, 1) and s[3].start_date is None


def test_star_schema(g):
    st = etl.star_schema(g)
    di = {r.intern_name: r.intern_id for r in st["dim_intern"].collect()}
    assert set(di) == {"Mary-Jane O'Neil", "Dev Shah", "Isha Iyer", "Asha K"}   # L5 quarantined
    assert all(len(v) == 32 for v in di.values())
    dc = sorted((r.course_id, r.course_name, r.start_date) for r in st["dim_course"].collect())
    assert dc == [("CRS-000", "Basic Python Programming", dt.date(2026, 1, 1)), ("CRS-001", "Basic SQL", None),
                  ("CRS-002", "Basic SQL", dt.date(2026, 1, 1))]
    assert {r.mentor_name for r in st["dim_mentor"].collect()} == {"Asha Rao", "Raj", "Rajesh"}
    fl = {r.row_id: r for r in st["fact_lms"].collect()}
    assert set(fl) == {1, 2, 3, 4, 6} and fl[3].course_id == "CRS-001"       # D2: null dates join null dates
    assert fl[1].intern_id == di["Mary-Jane O'Neil"]
    fa = {r.row_id: r for r in st["fact_activity"].collect()}
    assert set(fa) == {1, 2, 3, 4, 5} and fa[1].date == dt.date(2026, 2, 3) and fa[4].date is None
    seq = {r.intern_name: r.intern_id for r in etl.star_schema_sequential(g)["dim_intern"].collect()}
    assert sorted(seq.values()) == [1001, 1002, 1003, 1004] and seq["Asha K"] == 1001


def test_quality_report(g):
    r = etl.quality_report(g).first().asDict()
    assert r == {"unique_interns": 4, "courses": 3, "mentors": 3, "fact_lms_rows": 5, "fact_activity_rows": 5,
                 "duplicates": 1, "invalid_hours": 1, "invalid_progress": 1, "orphan_records": 1,
                 "outlier_days": 1, "unparsed_progress": 1, "unsummable_hours": 0}
    assert etl.key_collisions(g).count() == 0


def test_merge_new_is_anti_join(spark):
    base = spark.createDataFrame([("SQL", "Asha"), ("SQL", None)], "c string, name_norm string")
    new = spark.createDataFrame([("SQL", "Asha"), ("SQL", "Dev"), ("SQL", None), ("Py", "Asha")],
                                "c string, name_norm string")
    out = etl.merge_new(base, new, ["c", "name_norm"])
    assert out.count() == 2 + 2                          # union count = base + anti rows
    assert {(r.c, r.name_norm) for r in out.collect()} == {("SQL", "Asha"), ("SQL", None), ("SQL", "Dev"), ("Py", "Asha")}


GOOD = [("asha rao", "Basic SQL", "01 Jan 2026", "28 Feb 2026", "Raj", "80%", "3/4", "3/4", "1 / 2", "1 / 2", "3/4", "Completed"),
        ("dev shah", "Basic SQL", "01 Jan 2026", "28 Feb 2026", "Raj", "10%", "1/4", "1/4", "1 / 2", "1 / 2", "1/4", "In Progress")]
LOGS = [("03/02/2026", "Asha", "Rao", "SQL Revision", 2.0), ("03/02/2026", "Dev", "Shah", "SQL Revision", 3.0)]


def failed_checks(spark, lms=GOOD, eod=LOGS, cols=None, eod_cols=None, n=2):
    cols, eod_cols = cols or etl.LMS_COLUMNS, eod_cols or etl.EOD_COLUMNS
    g = Gold.from_frames(spark, bronze_lms=spark.createDataFrame(lms, ", ".join(f"`{c}` string" for c in cols)),
                         bronze_eod=spark.createDataFrame(eod, ", ".join(f"`{c}` {'double' if c == 'Hours' else 'string'}" for c in eod_cols)))
    return {r.check for r in etl.validate_output(g, expected_interns=n).collect() if not r.passed}


def with_cell(i, value, row=0, table=GOOD):
    out = [list(r) for r in table]
    out[row][i] = value
    return [tuple(r) for r in out]


def test_each_sheet_check_can_fail(spark):
    assert failed_checks(spark) == set()
    swapped = [etl.LMS_COLUMNS[1], etl.LMS_COLUMNS[0], *etl.LMS_COLUMNS[2:]]
    assert "lms_schema" in failed_checks(spark, lms=[(r[1], r[0], *r[2:]) for r in GOOD], cols=swapped)
    assert "eod_schema" in failed_checks(spark, eod=[(r[1], r[0], *r[2:]) for r in LOGS],
                                         eod_cols=["First Name", "Date", "Last Name", "Activity", "Hours"])
    assert failed_checks(spark, lms=GOOD + GOOD[:1]) == {"row_count"}
    assert failed_checks(spark, lms=with_cell(0, "dev shah")) == {"unique_names"}
    assert failed_checks(spark, lms=with_cell(0, None)) == set()  # a missing name counts as one name
    assert failed_checks(spark, eod=with_cell(4, 10.5, table=LOGS)) == {"hours_range"}
    assert failed_checks(spark, eod=with_cell(4, None, table=LOGS)) == {"hours_range"}
    assert failed_checks(spark, lms=with_cell(5, "130%")) == {"progress_range"}
    assert failed_checks(spark, lms=with_cell(5, None, row=1)) == {"progress_range"}
    assert failed_checks(spark, lms=with_cell(11, "Done", row=1)) == {"status_values"}
    assert failed_checks(spark, lms=with_cell(11, None, row=1)) == {"status_values"}
    assert failed_checks(spark, lms=with_cell(5, "20%")) == {"completed_progress"}
    assert failed_checks(spark, eod=LOGS[:1]) == {"eod_coverage"}
