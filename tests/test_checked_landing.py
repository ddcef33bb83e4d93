"""Checks observed by the landing write."""

import os

import pytest

from cohortlens.plans.etl import silver_eod, silver_lms
from cohortlens.sources.files import EOD_SCHEMA, LMS_SCHEMA
from cohortlens.streaming import checked_landing as cl


def eod(spark, rows):
    return spark.createDataFrame(rows, EOD_SCHEMA)


def lms(spark, rows):
    """rows: (name, start, progress, status)"""
    return spark.createDataFrame([(n, "C", s, "01 Mar 2026", "M", p, "1/2", "1/2", "1 / 2", "1 / 2", "1/2", st) for n, s, p, st in rows], LMS_SCHEMA)


EOD = [("01/02/2026", "a", "b", "x", 2.0), ("32/02/2026", "a", "b", "x", 11.0), (None, "c", "d", "x", -1.0),
       ("02/02/2026", None, None, "x", float("nan")), ("02/02/2026", "e", "f", None, None)]
LMS = [("ann", "01 Feb 2026", "50%", "Completed"), ("bob", "soon", "20%", "Completed"), (None, None, "x%", "Paused"),
       ("cy", "01 Feb 2026", "120%", "-"), ("di", "01 Feb 2026", None, None)]


def test_checks_of_a_batch_and_its_rows(spark, tmpdir_fresh):
    got = cl.land(eod(spark, EOD), "eod", tmpdir_fresh, 0)
    assert got == {"rows": 5, "unnamed": 1, "undated": 2, "unparsed_date": 1, "negative_hours": 1, "hours_outside": 4, "unsummable_hours": 1}
    want = silver_eod(eod(spark, EOD))
    landed = spark.read.parquet(os.path.join(tmpdir_fresh, "eod"))
    assert landed.columns == [*want.columns, "batch_id"]
    assert sorted(map(repr, landed.drop("batch_id").collect())) == sorted(map(repr, want.collect()))
    got = cl.land(lms(spark, LMS), "lms", tmpdir_fresh, 0)
    assert got == {"rows": 5, "unnamed": 1, "unparsed_progress": 1, "unparsed_start": 1, "unparsed_end": 0, "progress_above_100": 1,
                   "progress_outside": 2, "unknown_status": 1, "completed_below_30": 1}
    assert spark.read.parquet(os.path.join(tmpdir_fresh, "lms")).columns == [*silver_lms(lms(spark, LMS)).columns, "batch_id"]


def test_sums_over_batches_and_landing_again(spark, tmpdir_fresh):
    one, two = eod(spark, EOD[:2]), eod(spark, EOD[2:])
    cl.land(one, "eod", tmpdir_fresh, 0)
    cl.land(two, "eod", tmpdir_fresh, 1)
    cl.land(two, "eod", tmpdir_fresh, 1)          # a retry replaces its batch
    sums = {r["check"]: (r["n"], r["batches"]) for r in cl.table_checks(spark, tmpdir_fresh).collect()}
    whole = cl.land(eod(spark, EOD), "eod", os.path.join(tmpdir_fresh, "whole"), 0)
    assert sums == {k: (v, 2) for k, v in whole.items()}
    assert spark.read.parquet(os.path.join(tmpdir_fresh, "eod")).count() == 5
    assert cl.stored_checks(spark, tmpdir_fresh).where("batch_id = 0 and `check` = 'rows'").first()["n"] == 2


def test_one_scan(spark, tmpdir_fresh):
    """The landing reads its source once: an accumulator in the source counts."""
    reads = spark.sparkContext.accumulator(0)

    def counted(rows):
        for b in rows:
            reads.add(len(b))
            yield b

    src = eod(spark, EOD[:3]).mapInPandas(counted, EOD_SCHEMA)
    cl.land(src, "eod", tmpdir_fresh, 0)
    assert reads.value == 3


@pytest.mark.parametrize("kind", ["eod", "lms"])
def test_empty_batch(spark, tmpdir_fresh, kind):
    empty = spark.createDataFrame([], EOD_SCHEMA if kind == "eod" else LMS_SCHEMA)
    got = cl.land(empty, kind, tmpdir_fresh, 0)
    assert set(got) == set(cl.checks_of(kind)) and not any(got.values())
    path = os.path.join(tmpdir_fresh, "src")
    (eod(spark, EOD) if kind == "eod" else lms(spark, LMS)).write.parquet(path)
    none = spark.read.parquet(path).where("1 = 0")                      # pruned to nothing by the optimiser
    assert not any(cl.land(none, kind, tmpdir_fresh, 1).values())
