"""Sheet reader (S02/S03), sinks (S06-S09) and incremental landing (ST1)."""

import os

import pytest

from cohortlens.sources import files, sinks
from cohortlens.streaming import landing

EOD_HEADER = "Date,First Name,Last Name,Activity,Hours"


def write(path, header, rows):
    with open(path, "w") as f:
        f.write(header + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")


def test_union_by_name_across_layouts(spark, tmpdir_fresh):
    write(os.path.join(tmpdir_fresh, "a.csv"), EOD_HEADER, [("03/02/2026", "Dev", "Shah", "SQL Revision", "2.5")])
    write(os.path.join(tmpdir_fresh, "b.csv"), "Hours,Activity,Date,First Name,Last Name",
          [("4.0", "NumPy Practice", "04/02/2026", "Isha", "Iyer")])
    df = files.read_sheets(spark, os.path.join(tmpdir_fresh, "*.csv"), files.EOD_SCHEMA)
    got = {(r["First Name"], r["Activity"], r["Hours"]) for r in df.collect()}
    assert got == {("Dev", "SQL Revision", 2.5), ("Isha", "NumPy Practice", 4.0)}
    assert files.read_sheets(spark, os.path.join(tmpdir_fresh, "*.xlsx")) is None
    assert files.read_optional(spark, os.path.join(tmpdir_fresh, "none*.csv"), files.EOD_SCHEMA).count() == 0


def test_landing_is_once_per_file(spark, tmpdir_fresh):
    src, sink, ckpt = (os.path.join(tmpdir_fresh, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    write(os.path.join(src, "day1.csv"), EOD_HEADER,
          [("03/02/2026", " dev", "shah ", "SQL Revision", "2.5"), ("13/02/2026", "Isha", "Iyer", "NumPy Practice", "1.0")])
    landing.land_sheets(spark, src, sink, ckpt)
    first = spark.read.parquet(sink)
    assert first.count() == 2
    assert {r.full_name for r in first.collect()} == {"Dev Shah", "Isha Iyer"}
    landing.land_sheets(spark, src, sink, ckpt)                 # re-run: nothing new
    assert spark.read.parquet(sink).count() == 2
    write(os.path.join(src, "day2.csv"), EOD_HEADER, [("14/02/2026", "Dev", "Shah", "SQL Revision", "3.0")])
    landing.land_sheets(spark, src, sink, ckpt)                 # only the new file's row
    assert spark.read.parquet(sink).count() == 3


def test_landing_binds_by_header_and_keeps_rejects(spark, tmpdir_fresh):
    src, sink, ckpt = (os.path.join(tmpdir_fresh, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    write(os.path.join(src, "a.csv"), "First Name,Last Name,Hours,Date,Activity",
          [("Asha", "Rao", "2.5", "03/02/2026", "SQL Revision"), ("Asha", "Rao", "abc", "03/02/2026", "SQL Revision"),
           ("Asha", "Rao", "1", "03/02/2026", "SQL Revision", "extra")])
    landing.land_sheets(spark, src, sink, ckpt)
    r = spark.read.parquet(sink).collect()
    assert [(x.full_name, str(x.date), x.hours, x.activity) for x in r] == [("Asha Rao", "2026-02-03", 2.5, "SQL Revision")]
    lines = {x.line for x in spark.read.parquet(f"{sink}_rejects").collect()}
    assert lines == {"Asha,Rao,abc,03/02/2026,SQL Revision", "Asha,Rao,1,03/02/2026,SQL Revision,extra"}
    good, bad = files.split_rejects(files.read_sheets(spark, os.path.join(src, "*.csv"), files.EOD_SCHEMA))
    assert good.count() == 1 and bad.count() == 2


def test_month_layout_splits_a_large_month(spark, tmpdir_fresh):
    df = spark.range(200_000).selectExpr("id AS intern_id", "DATE'2026-02-01' AS date", "uuid() AS activity", "1.0 AS hours")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        sinks.write_activity_layout(df, os.path.join(tmpdir_fresh, "m"))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    month = os.path.join(tmpdir_fresh, "m", "activity_month=2026-02")
    assert len([f for f in os.listdir(month) if f.endswith(".parquet")]) > 1
    assert spark.read.parquet(os.path.join(tmpdir_fresh, "m")).count() == 200_000


def test_daily_batch_and_sinks(spark, tmpdir_fresh):
    src = os.path.join(tmpdir_fresh, "eod")
    os.makedirs(src)
    write(os.path.join(src, "x.csv"), EOD_HEADER, [("03/02/2026", "Dev", "Shah", "SQL Revision", "2.5")])
    base = os.path.join(tmpdir_fresh, "landing")
    counts = landing.daily_batch(spark, os.path.join(tmpdir_fresh, "lms", "*.csv"), os.path.join(src, "*.csv"), base)
    assert counts == {"lms_submissions": 0, "eod_activity": 1}
    act = spark.read.parquet(os.path.join(base, "eod_activity"))
    sinks.write_activity_layout(act.withColumnRenamed("full_name", "intern_id"), os.path.join(tmpdir_fresh, "layout"))
    assert os.path.isdir(os.path.join(tmpdir_fresh, "layout", "activity_month=2026-02"))
    out = sinks.write_tables({"t": act}, os.path.join(tmpdir_fresh, "gold"))
    assert spark.read.parquet(out["t"]).count() == 1
    with pytest.raises(ExceptionGroup):
        sinks.write_tables({"t": act, "bad": act.selectExpr("raise_error('no') AS x")}, os.path.join(tmpdir_fresh, "gold2"))
    assert spark.read.parquet(os.path.join(tmpdir_fresh, "gold2", "t")).count() == 1  # the others are written
    sinks.save_bucketed(act.withColumnRenamed("full_name", "intern_id"), "eod_bucketed", buckets=4)
    assert spark.table("eod_bucketed").count() == 1
    assert sinks.load_or_build(spark, "eod_bucketed", lambda: None).count() == 1


def test_export_by_course(spark, tmpdir_fresh):
    df = spark.createDataFrame([("a", "Basic SQL"), ("b", "Basic SQL"), ("c", "Basic Python Programming")],
                               "`User Name` string, `Course Name` string")
    sinks.export_by_course(df, tmpdir_fresh)
    parts = sorted(os.listdir(os.path.join(tmpdir_fresh, "by_course")))
    assert [p for p in parts if p.startswith("Course Name=")] == ["Course Name=Basic Python Programming",
                                                                   "Course Name=Basic SQL"]
    assert spark.read.option("header", True).csv(os.path.join(tmpdir_fresh, "combined")).count() == 3


def test_stored_gold_round_trip(spark, tmpdir_fresh):
    from cohortlens.plans import risk
    from cohortlens.sources.bindings import Gold
    from cohortlens.sources.gold_store import gold_from_path, write_gold
    from tests.conftest import SF_SMALL
    g = Gold(spark, SF_SMALL)
    write_gold(g, os.path.join(tmpdir_fresh, "gold"))
    stored = gold_from_path(spark, os.path.join(tmpdir_fresh, "gold"))
    a = sorted(tuple(r) for r in risk.dropout_risk(g).collect())
    b = sorted(tuple(r) for r in risk.dropout_risk(stored).collect())
    assert a == b and len(a) > 0


LMS_HEADER = ("User Name,Course Name,Start Date,End Date,Mentor Name,Progress (%),Completed Assignment,"
              "Reviewed / Submitted,Overall Knowledge Check,Overall Test,Reviewed / Total Assignments,Overall Status")


def test_landing_lms_sheets(spark, tmpdir_fresh):
    src, sink, ckpt = (os.path.join(tmpdir_fresh, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    write(os.path.join(src, "sql.csv"), LMS_HEADER,
          [(" asha rao ", "Basic SQL", "01 Jan 2026", "28 Feb 2026", '"Asha Rao, Raj"', "80%", "3/4", "3/4",
            "68.0 / 70.0", "80 / 100", "3/4", "Completed"),
           ("dev shah", "Basic SQL", "01 Jan 2026", "28 Feb 2026", "Rajesh", "", "", "", "", "0 / 0", "-", "-")])
    landing.land_sheets(spark, src, sink, ckpt, kind="lms")
    rows = {r.intern_name: r for r in spark.read.parquet(sink).collect()}
    assert rows["Asha Rao"].progress == 80.0 and rows["Asha Rao"].mentor_name == "Asha Rao, Raj"
    assert (rows["Dev Shah"].progress, rows["Dev Shah"].total_assg, rows["Dev Shah"].overall_status) == \
        (0.0, 1, "Not Started")
    landing.land_sheets(spark, src, sink, ckpt, kind="lms")
    assert spark.read.parquet(sink).count() == 2
