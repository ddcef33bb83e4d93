"""Stored bitmaps and sketches against the facts."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.plans import presence, sketches
from cohortlens.plans.common import Params
from tests.helpers import D

START = D(2023, 11, 20)
RANGES = [Params(start="2023-12-01", end="2024-01-31"), Params(start="2024-01-08", end="2024-01-08"),
          Params(start="2023-01-01", end="2025-01-01"), Params(start="2030-01-01", end="2030-01-05")]


def logs(spark, ids, seed=1, per=6, days=120):
    rng = np.random.default_rng(seed)
    kind = "string" if isinstance(ids[0], str) else "long"
    rows = []
    for i in ids:
        for _ in range(rng.integers(1, per)):
            rows.append((i, D.fromordinal(START.toordinal() + int(rng.integers(0, days))), ["a", "b", None][rng.integers(0, 3)], 1.0))
    rows += rows[:20] + [(None, START, "a", 1.0), (ids[0], None, "a", 1.0)]
    return spark.createDataFrame(rows, f"intern_id {kind}, date date, activity string, hours double")


def bridge_of(spark, ids):
    kind = "string" if isinstance(ids[0], str) else "long"
    pairs = [(i, f"M{k % 4}") for k, i in enumerate(ids[:-5])] + [(i, "M9") for i in ids[:40]] + [(ids[0], "M9")]
    return spark.createDataFrame(pairs, f"intern_id {kind}, mentor_name string")


def truth(facts, bridge, scope, p):
    f = facts.toPandas().dropna(subset=["intern_id", "date"])
    f = f[(f["date"] >= D.fromisoformat(p.start)) & (f["date"] <= D.fromisoformat(p.end))]
    if scope == presence.COHORT:
        return {None: set(f["intern_id"])}
    if scope == presence.MENTOR:
        f = f.merge(bridge.toPandas(), on="intern_id").rename(columns={"mentor_name": "name"})
    else:
        f = f.rename(columns={"activity": "name"})
    return {k if isinstance(k, str) else None: set(x["intern_id"]) for k, x in f.groupby("name", dropna=False)}


def shifted(p):
    a, b = D.fromisoformat(p.start), D.fromisoformat(p.end)
    n = (b - a).days + 1
    return Params(start=str(D.fromordinal(a.toordinal() - n)), end=str(D.fromordinal(a.toordinal() - 1)))


@pytest.mark.parametrize("ids", [[2 ** 40 + 7 * i for i in range(300)], [f"{i:032x}" for i in range(300)]], ids=["beyond 32 bits", "digests"])
def test_distinct_counts_equal_the_facts(spark, tmpdir_fresh, ids):
    f, b = logs(spark, ids).cache(), bridge_of(spark, ids).cache()
    presence.add_batch(spark, f, b, os.path.join(tmpdir_fresh, "s"))
    sets = presence.read_sets(spark, os.path.join(tmpdir_fresh, "s")).cache()
    for p in RANGES:
        for scope in (presence.COHORT, presence.MENTOR, presence.ACTIVITY):
            want, past = truth(f, b, scope, p), truth(f, b, scope, shifted(p))
            got = presence.active(sets, scope, p).collect()
            if scope == presence.COHORT:
                assert got[0]["active"] == len(want[None])
            else:
                assert {r["name"]: r["active"] for r in got} == {k: len(v) for k, v in want.items()}
            if scope == presence.MENTOR:
                for r in presence.retention(sets, scope, p).collect():
                    now, then = want.pop(r["name"], set()), past.pop(r["name"], set())
                    assert (r["active"], r["before"], r["retained"], r["new"], r["lost"]) == (
                        len(now), len(then), len(now & then), len(now - then), len(then - now))
                assert not want and not past


def test_batches_may_come_in_any_order_and_twice(spark, tmpdir_fresh):
    ids = list(range(200))
    one, two = logs(spark, ids[:150], 1), logs(spark, ids[100:], 2)
    b = bridge_of(spark, ids)
    path = os.path.join(tmpdir_fresh, "s")
    for batch in (two, one, two):
        presence.add_batch(spark, batch, b, path)
    numbers = spark.read.parquet(os.path.join(path, "ids")).toPandas()
    assert numbers["intern_id"].is_unique and sorted(numbers["number"]) == list(range(1, len(numbers) + 1))
    sets = presence.read_sets(spark, path)
    small = presence.compacted(sets).cache()
    assert small.count() < sets.count()
    both = one.unionByName(two).cache()
    for p in RANGES[:2]:
        want = {k: len(v) for k, v in truth(both, b, presence.MENTOR, p).items()}
        for s in (sets, small):
            assert {r["name"]: r["active"] for r in presence.active(s, presence.MENTOR, p).collect()} == want


def test_empty_facts(spark, tmpdir_fresh):
    f = logs(spark, [1]).where("false")
    presence.add_batch(spark, f, bridge_of(spark, list(range(9))), os.path.join(tmpdir_fresh, "s"))
    sets = presence.read_sets(spark, os.path.join(tmpdir_fresh, "s"))
    assert presence.active(sets, presence.COHORT, RANGES[0]).collect()[0]["active"] == 0
    assert presence.retention(sets, presence.MENTOR, RANGES[0]).count() == 0


# --- sketches -------------------------------------------------------------------

def values(spark, seed=4, n=6000):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(n):
        grp = ["hot", "hot", "ties", None, "few"][0 if i % 3 == 0 else (4 if i % 997 == 0 else 1 + i % 3)]
        v = {"hot": float(rng.lognormal()), "ties": 8.0 if rng.random() < 0.9 else float(rng.integers(0, 10)),
             "few": float(i), None: float(rng.normal())}[grp]
        rows.append((grp, D.fromordinal(START.toordinal() + int(rng.integers(0, 120))), v))
    rows += [("hot", START, None), ("hot", START, float("nan")), ("hot", None, 5.0), ("none", START, None)]
    return spark.createDataFrame(rows, "group string, date date, value double")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    v = values(spark).cache()
    return v, sketches.write_sketches(v, str(tmp_path_factory.mktemp("sk") / "s")).cache()




def groups(v, p):
    x = v.where(F.col("value").isNotNull() & ~F.isnan("value") & F.col("date").between(p.start, p.end)).toPandas()
    return {k if isinstance(k, str) else None: np.sort(g["value"].to_numpy()) for k, g in x.groupby("group", dropna=False)}


@pytest.mark.parametrize("p", RANGES, ids=lambda p: p.start)
def test_exact_quantiles_by_bracket(stored, p):
    v, s = stored
    for q in (0.0, 0.25, 0.9, 1.0):
        got = {r["group"]: (r["n"], r["quantile"]) for r in sketches.exact(v, s, p, q).collect()}
        want = {k: (len(x), pytest.approx(float(np.quantile(x, q)), abs=1e-12)) for k, x in groups(v, p).items()}
        assert got == want


def test_a_bracket_that_misses_is_noticed(stored, spark):
    """A store that lags behind, or lacks a group, or a bracket of no width:
    the quantile stays exact."""
    v, s = stored
    p = RANGES[0]
    want = {k: pytest.approx(float(np.median(x)), abs=1e-12) for k, x in groups(v, p).items()}
    shifted_up = v.withColumn("value", F.col("value") + 100)
    for store in (s.where("`group` <> 'ties'"), s.where("level = 9")):
        assert {r["group"]: r["quantile"] for r in sketches.exact(v, store, p, 0.5).collect()} == want
    moved = {k: pytest.approx(float(np.median(x)) + 100, abs=1e-9) for k, x in groups(v, p).items()}
    assert {r["group"]: r["quantile"] for r in sketches.exact(shifted_up, s, p, 0.5).collect()} == moved
    assert {r["group"]: r["quantile"] for r in sketches.exact(v, s, p, 0.5, reach=0.0).collect()} == want


def test_rank_error_of_merged_sketches(stored):
    v, s = stored
    p = RANGES[0]
    qs = (0.1, 0.5, 0.9)
    for r in sketches.approximate(s, p, qs, ("a", "b", "c")).collect():
        x = groups(v, p)[r["group"]]
        assert r["n"] == len(x)
        for q, name in zip(qs, "abc"):
            low, high = np.searchsorted(x, r[name], "left") / len(x), np.searchsorted(x, r[name], "right") / len(x)
            assert low - 3 * sketches.RANK_ERROR <= q <= high + 3 * sketches.RANK_ERROR
    level0 = s.where("level = 0").count()
    assert s.where("level = 2").count() < level0
