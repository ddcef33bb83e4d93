"""Stateful effort stream (ST1), snapshots (S06/S10), maintenance by changes
(B01/B04) and the membership index (U02/B42)."""

import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from cohortlens.operators import membership as mb
from cohortlens.plans import maintain
from cohortlens.plans.activity import daily_hours, weekly_hours
from cohortlens.plans.etl import merge_new
from cohortlens.plans.risk import dropout_risk
from cohortlens.sources.bindings import Gold
from cohortlens.sources.snapshots import PublishConflict, SnapshotStore
from cohortlens.streaming import effort
from cohortlens.streaming.indexed_landing import IndexedLanding
from cohortlens.streaming.landing import EVENTS_SCHEMA
from tests.helpers import lms_rows, names


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# --- ST1 --------------------------------------------------------------------

def event(i, day, user, hours, hour=12):
    ts = dt.datetime(2024, 1, 1, hour) + dt.timedelta(days=day) if day is not None else None
    return (i, ts, user, "SQL Revision", hours, None)


def put(spark, path, events):
    spark.createDataFrame(events, EVENTS_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def batch_daily(spark, events):
    once = list({e[0]: e for e in events}.values())
    fa = spark.createDataFrame(once, EVENTS_SCHEMA).select(F.col("user_id").alias("intern_id"), F.to_date("ts").alias("date"),
                                                            F.col("event_type").alias("activity"), F.col("value").alias("hours"))
    return Gold.from_frames(spark, fact_activity=fa)


@pytest.mark.parametrize("grain", ["day", "week"])
def test_effort_over_micro_batches_with_late_and_repeated_rows(spark, tmpdir_fresh, grain):
    src, base = os.path.join(tmpdir_fresh, "in"), os.path.join(tmpdir_fresh, "run")
    rnd = random.Random(1)
    first = [event(i, rnd.randrange(0, 8), rnd.randrange(5), rnd.choice([0.1, 2.7, 13.0, None])) for i in range(80)]
    first += [event(900, 0, 1, 1.5, 0), event(901, 7, 1, 1.5, 23), event(902, None, 1, 4.0)]
    second = [event(100 + i, rnd.randrange(6, 14), rnd.randrange(5), 0.3) for i in range(60)]
    second += first[:20] + [event(300, 2, 3, 5.0)]                      # repeated, and late by a few days
    third = [event(200 + i, rnd.randrange(12, 40), rnd.randrange(5), 1.1) for i in range(60)] + second[10:30] + second[:10]
    seen = []
    for part in (first, second, third):
        put(spark, src, part)
        effort.run_effort(spark, src, base, grain, delay="10 days")
        seen += part
        g = batch_daily(spark, seen)
        if grain == "day":
            want = daily_hours(g)
        else:
            want = weekly_hours(g, ("intern_id",), with_year=True)
        got = effort.current_effort(spark, base, grain)
        if grain == "week":
            got = got.select("intern_id", F.extract(F.lit("YEAROFWEEK"), "date").alias("iso_year"), F.weekofyear("date").alias("week"), "hours")
        assert rows(got.select(*want.columns)) == rows(want)
    before = rows(effort.current_effort(spark, base, grain))
    effort.run_effort(spark, src, base, grain, delay="10 days")          # started again: nothing new
    assert rows(effort.current_effort(spark, base, grain)) == before


def test_effort_state_is_bounded_and_too_late_rows_are_counted(spark, tmpdir_fresh):
    src, base = os.path.join(tmpdir_fresh, "in"), os.path.join(tmpdir_fresh, "run")
    held = []
    for k in range(6):  # six times ten days: the log grows, the state does not
        put(spark, src, [event(1000 * k + 10 * d + u, 10 * k + d, u, 1.0) for d in range(10) for u in range(3)])
        progress = effort.run_effort(spark, src, base, "day", delay="5 days")
        held.append(sum(op["numRowsTotal"] for op in progress[-1]["stateOperators"]))
    assert len(set(held)) == 1 and held[0] <= 3 * 6 + 3 * 11, held  # open days, and ids of the watermark's span
    put(spark, src, [event(9999, 1, 0, 100.0)])
    progress = effort.run_effort(spark, src, base, "day", delay="5 days")
    assert sum(op["numRowsDroppedByWatermark"] for p in progress for op in p["stateOperators"]) == 1
    day = effort.current_effort(spark, base).where("intern_id = 0 AND date = DATE'2024-01-02'").collect()
    assert [r.hours for r in day] == [1.0]


# --- S06, S10 -----------------------------------------------------------------

def test_a_failed_load_leaves_the_old_version(spark, tmpdir_fresh):
    store = SnapshotStore(spark, os.path.join(tmpdir_fresh, "gold"))
    assert store.latest() is None and store.fresh(10) is None
    df = lambda x: spark.createDataFrame([(x,)], "x int")
    one = store.publish({"a": df(1), "b": df(1), "c": df(1), "d": df(1)})
    bad = spark.createDataFrame([("no number",)], "s string").select(F.col("s").cast("int").alias("x"))
    with pytest.raises(Exception):
        store.publish({"a": df(2), "b": df(2), "c": bad, "d": df(2)}, onto=one)  # fails between tables
    now = store.latest()
    assert now.version == 1 and [now.table(t).first().x for t in "abcd"] == [1, 1, 1, 1]
    two = store.publish({"a": df(2), "b": df(2)}, onto=now)
    assert [two.table(t).first().x for t in "abcd"] == [2, 2, 1, 1]
    assert [now.table(t).first().x for t in "abcd"] == [1, 1, 1, 1]              # a pinned reader
    with pytest.raises(PublishConflict):
        store.publish({"a": df(3)}, onto=one)                                    # began from a version that is past
    assert [store.latest().table(t).first().x for t in "abcd"] == [2, 2, 1, 1]
    assert 0 <= two.age_seconds() < 600 and two.age_seconds(two.published + 90) == 90
    assert store.fresh(600).version == 2 and store.fresh(-1) is None
    assert store.vacuum(keep=1, grace_seconds=0) > 0
    assert store.versions() == [2] and [store.latest().table(t).first().x for t in "abcd"] == [2, 2, 1, 1]


# --- B01, B04 -----------------------------------------------------------------

def lms_fact(spark, spec):
    df = lms_rows(spark, [s[1:] for s in spec])
    ids = spark.createDataFrame([(k + 1, s[0]) for k, s in enumerate(spec)], "lms_row_id long, id long")
    return df.join(ids, "lms_row_id").drop("lms_row_id").withColumnRenamed("id", "lms_row_id").select(*df.columns)


def act_fact(spark, spec):
    return spark.createDataFrame([(r, i, d, a, float(h)) for r, i, d, a, h in spec],
                                 "row_id long, intern_id long, date date, activity string, hours double")


def test_maintained_risk_equals_a_rebuild(spark, tmpdir_fresh):
    rnd = random.Random(7)
    day = lambda: dt.date(2024, 1, 1) + dt.timedelta(days=rnd.randrange(60)) if rnd.random() > 0.05 else None
    lms = {k: (rnd.randrange(40), f"CRS-00{rnd.randrange(3)}", float(rnd.randrange(100)), rnd.randrange(5), 5, "Completed") for k in range(120)}
    act = {k: (rnd.randrange(45), day(), "SQL", rnd.randrange(1, 90) / 10) for k in range(400)}
    dim = names(spark, range(38))
    store = SnapshotStore(spark, os.path.join(tmpdir_fresh, "s"))
    full = lambda: (lms_fact(spark, [(k, *v) for k, v in lms.items()]), act_fact(spark, [(k, *v) for k, v in act.items()]))
    maintain.create(store, *full(), dim, folders=16)

    def step(change_lms, new_lms, drop_lms, change_act, new_act, drop_act):
        for k in change_lms + new_lms:
            lms[k] = (rnd.randrange(42), "CRS-001", float(rnd.randrange(100)), rnd.randrange(5), 5, "In Progress")
        for k in change_act + new_act:
            act[k] = (rnd.randrange(48), day(), "SQL", rnd.randrange(1, 90) / 10)
        op = lambda df, o: df.withColumn("op", F.lit(o))
        lf, af = full()
        cl = op(lf.where(F.col("lms_row_id").isin(change_lms)), "upsert").union(op(lf.where(F.col("lms_row_id").isin(new_lms)), "insert")) \
            .union(op(lf.where(F.col("lms_row_id").isin(drop_lms)), "delete"))
        ca = op(af.where(F.col("row_id").isin(change_act)), "upsert").union(op(af.where(F.col("row_id").isin(new_act)), "insert")) \
            .union(op(af.where(F.col("row_id").isin(drop_act)), "delete"))
        s = maintain.apply_changes(store, {"fact_lms": cl, "fact_activity": ca})
        for k in drop_lms:
            del lms[k]
        for k in drop_act:
            del act[k]
        return s

    for args in (([3, 4], [500, 501], [10], [5, 6], [900], [11, 12]), ([], [502], [], [], [], []), ([], [], [], [], [], [20]),
                 (list(range(20, 60)), [], list(range(60, 100)), [7], [], [])):
        s = step(*args)
        lf, af = full()
        g = Gold.from_frames(spark, fact_lms=lf, fact_activity=af.drop("row_id"), dim_intern=dim)
        assert rows(maintain.maintained_risk(s)) == rows(dropout_risk(g))
        assert rows(s.table("fact_lms")) == rows(lf) and rows(s.table("fact_activity")) == rows(af)
    before = store.latest()
    s = step([], [503], [], [], [], [])  # one intern: one folder of each table is written, the others are carried
    changed = {t: [p for p in s.parts(t) if s.tables[t]["folders"][p] != before.tables[t]["folders"].get(p)] for t in s.tables if t != "layout"}
    assert len(changed["fact_lms"]) == len(changed["lms_totals"]) == 1
    assert changed["fact_activity"] == changed["daily_hours"] == changed["dim_intern"] == []
    assert s.table("fact_lms", changed["fact_lms"]).count() < s.table("fact_lms").count()


# --- U02, B42 -----------------------------------------------------------------

def test_index_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(20_000).withColumn("k", F.col("id").cast("string")).withColumn("h", mb.key_hash(["k"]))
    blocks = mb.blocks_for(20_000 // 8)
    half = lambda c: mb.build_index(keys.where(c), 8, blocks, "h")
    index = mb.merge_index(half("id % 2 = 0 AND id < 10000"), half("id % 2 = 1 AND id < 10000"))
    got = mb.probe(keys, index, 8, blocks, "h").groupBy((F.col("id") < 10000).alias("old")).agg(F.avg(F.col("maybe").cast("int")).alias("p"))
    p = {r.old: r.p for r in got.collect()}
    assert p[True] == 1.0 and p[False] < 0.02


def sheet(spark, pairs):
    return spark.createDataFrame([(c, n, i) for i, (c, n) in enumerate(pairs)], "course string, name string, i int")


def test_indexed_landing_is_merge_new_and_lands_once(spark, tmpdir_fresh):
    old = [(f"c{i % 7}", f"n{i}") for i in range(3000)] + [(None, "x"), ("x", None), (None, None)]
    new = old[:15] + [(f"c{i % 7}", f"m{i}") for i in range(300)] + [("c0", "m0"), ("c0", "m0"), (None, "x"), (None, "y")]
    base, more = sheet(spark, old), sheet(spark, new)
    landing = IndexedLanding(SnapshotStore(spark, os.path.join(tmpdir_fresh, "l")), ["course", "name"], ranges=64, keys_per_range=32)
    first = landing.land(base)
    assert first.added == len(old)
    done = landing.land(more)
    want = merge_new(base, more, ["course", "name"])
    assert rows(done.snapshot.table("landing").select(*want.columns)) == rows(want)
    assert 16 <= done.maybe < 40 and done.base_rows_read < done.base_rows / 2     # few ranges are read
    again = landing.land(more)
    assert again.added == 0 and again.snapshot.version == done.snapshot.version
    third = landing.land(sheet(spark, [(f"d{i}", "z") for i in range(6000)]))     # the index grows
    assert third.added == 6000 and third.snapshot.table("index_meta").first().keys_per_range > 32
    assert landing.land(sheet(spark, [(f"d{i}", "z") for i in range(6000)] + old)).added == 0
    assert landing.land(base.limit(0)).added == 0


def test_indexed_landing_survives_a_failed_batch(spark, tmpdir_fresh, monkeypatch):
    store = SnapshotStore(spark, os.path.join(tmpdir_fresh, "l"))
    landing = IndexedLanding(store, ["course", "name"])
    landing.land(sheet(spark, [("a", "1")]))

    def fail(*a):
        raise RuntimeError("lost")
    monkeypatch.setattr(SnapshotStore, "_swap", fail)  # everything is written, nothing published
    with pytest.raises(RuntimeError):
        landing.land(sheet(spark, [("b", "2")]))
    monkeypatch.undo()
    assert store.latest().table("landing").count() == 1
    assert landing.land(sheet(spark, [("b", "2"), ("a", "1")])).added == 1
