"""Stored range sums and streaks against the facts."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortlens.plans import activity, rollup
from cohortlens.plans.common import Params
from cohortlens.sources.bindings import Gold
from tests.helpers import ACT_SCHEMA, D


def facts(spark, seed=5, interns=5, days=700, start=D(2022, 11, 3)):
    rng = np.random.default_rng(seed)
    rows = []
    for i in range(interns):
        for k in range(days):
            if rng.random() < (0.97, 0.9, 0.5, 0.1, 1.0)[i]:
                for _ in range(rng.integers(1, 3)):
                    rows.append((i, D.fromordinal(start.toordinal() + k), "a", float(rng.choice([0.0, 0.1, 2.35, 7.5], p=[.1, .3, .3, .3]))))
    rows += [(0, None, "a", 3.0), (9, start, "a", None), (9, D(1969, 12, 30), "a", 1.0), (9, D(1969, 12, 31), "a", 1.5), (9, D(1970, 1, 1), "a", 0.25)]
    return spark.createDataFrame(rows, ACT_SCHEMA)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    f = facts(spark).cache()
    path = str(tmp_path_factory.mktemp("rollup") / "r")
    rollup.write_rollup(f, path)
    return f, path


def rows_of(df):
    cols = sorted(df.columns)
    return sorted(map(repr, df.select(*cols).collect()))


@pytest.mark.parametrize("seed", range(4))
def test_cover_is_exact_and_short(seed):
    rng = np.random.default_rng(seed)
    for _ in range(200):
        a = int(rng.integers(-30_000, 30_000))
        b = a + int(rng.integers(0, 12_000))
        got = []
        for level, lo, hi in rollup.cover(a, b):
            w = rollup.FANOUT ** level
            got += range(lo * w, (hi + 1) * w)
        assert got == list(range(a, b + 1))
        blocks = sum(hi - lo + 1 for level, lo, hi in rollup.cover(a, b) if level < rollup.LEVELS - 1)
        assert blocks <= 2 * (rollup.FANOUT - 1) * (rollup.LEVELS - 1)
    assert rollup.cover(5, 4) == []


def test_streaks_equal_those_of_the_facts(spark, stored):
    f, path = stored
    g = Gold.from_frames(spark, fact_activity=f)
    got = rollup.streak_stats(rollup.read_rollup(spark, path))
    assert got.dtypes == [(c, t) for c, t in activity.streak_stats(g).select(*got.columns).dtypes]
    assert rows_of(got) == rows_of(activity.streak_stats(g))


@pytest.mark.parametrize("start,end", [("2022-11-03", "2024-12-31"), ("2023-01-17", "2023-01-17"), ("2023-02-02", "2023-08-29"),
                                       ("1969-12-29", "1970-01-05"), ("2023-05-09", "2023-05-01"), ("1900-01-01", "2100-01-01")])
def test_any_range_equals_the_facts(spark, stored, start, end):
    f, path = stored
    g, p, r = Gold.from_frames(spark, fact_activity=f), Params(start=start, end=end), rollup.read_rollup(spark, path)
    assert rows_of(rollup.streak_stats(r, p)) == rows_of(activity.streak_stats(g, p))
    assert rows_of(rollup.range_summary(r, p)) == rows_of(activity.range_summary(g, p))


def test_a_range_reads_few_rows(spark, stored):
    f, path = stored
    p = Params(start="2022-11-20", end="2024-08-20")
    read = rollup.blocks_in(rollup.read_rollup(spark, path), p)
    per = read.groupBy("intern_id").count().agg(F.max("count")).first()[0]
    assert per <= 2 * 7 * 3 + 7 < 60 and f.where("intern_id = 4").count() > 900


def test_half_open_ranges_are_refused_and_no_facts_give_no_rows(spark, stored, tmp_path):
    _, path = stored
    with pytest.raises(ValueError):
        rollup.blocks_in(rollup.read_rollup(spark, path), Params(start="2023-01-01"))
    empty = rollup.write_rollup(spark.createDataFrame([], ACT_SCHEMA), os.path.join(tmp_path, "none"))
    assert rollup.streak_stats(empty).collect() == []
