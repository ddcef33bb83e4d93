"""k-means with all restarts in one scan."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from cohortlens.operators import kmeans
from cohortlens.plans import ml
from cohortlens.sources.bindings import Gold
from tests.conftest import SF_SMALL


def blobs(spark, n=600, seed=3, k=4):
    rng = np.random.default_rng(seed)
    mid = rng.normal(size=(k, 3)) * 6
    rows = [(i, *map(float, mid[i % k] + rng.normal(size=3))) for i in range(n)]
    return spark.createDataFrame(rows, "id long, a double, b double, c double")


def numpy_cost(x, centers):
    return float(((x[:, None, :] - centers[None]) ** 2).sum(axis=2).min(axis=1).sum())


def test_finds_the_blobs_and_its_cost_is_true(spark):
    pts = kmeans.points(blobs(spark), "id", ["a", "b", "c"])
    x = np.array([r["x"] for r in pts.collect()])
    assert np.allclose(x.mean(axis=0), 0) and np.allclose(x.std(axis=0, ddof=1), 1)
    got = kmeans.fit(pts, "id", 4, restarts=5, seed=1)
    assert got.cost == pytest.approx(numpy_cost(x, got.centers), rel=1e-9)
    assert got.cost == min(got.costs) and len(got.costs) == 5
    # a fixed point: each centre is the mean of its rows
    own = ((x[:, None, :] - got.centers[None]) ** 2).sum(axis=2).argmin(axis=1)
    for c in range(4):
        assert np.allclose(x[own == c].mean(axis=0), got.centers[c], atol=1e-3)
    near = {r["id"]: r["c"] for r in pts.select("id", kmeans.nearest("x", got.centers).alias("c")).collect()}
    ids = [r["id"] for r in pts.collect()]
    assert [near[i] for i in ids] == own.tolist()


def test_one_scan_a_round_serves_all_restarts(spark):
    pts = kmeans.points(blobs(spark, 300), "id", ["a", "b", "c"])
    one = kmeans.fit(pts, "id", 4, restarts=1, seed=1, max_iter=6, tol=0.0)
    ten = kmeans.fit(pts, "id", 4, restarts=10, seed=1, max_iter=6, tol=0.0)
    assert ten.passes <= 4 + 6 + 1 and one.passes <= ten.passes
    assert ten.costs[0] == pytest.approx(one.cost, rel=1e-12)   # a restart does not depend on the others
    again = kmeans.fit(pts, "id", 4, restarts=10, seed=1, max_iter=6, tol=0.0)
    assert again.costs == ten.costs and (again.centers == ten.centers).all()


def test_start_centres_are_drawn_by_squared_distance(spark):
    """400 restarts on three places: the second centre falls on a place as often
    as its squared distance from the first says."""
    rows = [(i, 0.0) for i in range(50)] + [(50, 3.0), (51, 4.0)]
    pts = spark.createDataFrame(rows, "id long, v double").select("id", F.array("v").alias("x"))
    first = np.zeros((400, 1, 1))
    drawn = kmeans._draw(pts, "id", first, 400, 1, 1, 7).ravel()
    assert set(drawn) == {3.0, 4.0}                       # never a row that lies on a centre
    assert abs((drawn == 4.0).mean() - 16 / 25) < 0.08


def test_equal_rows_constant_and_null_features(spark):
    same = spark.createDataFrame([(i, 1.0, None) for i in range(9)], "id long, a double, b double")
    pts = kmeans.points(same, "id", ["a", "b"])
    got = kmeans.fit(pts, "id", 3, restarts=2)
    assert got.cost == 0.0 and got.centers.shape == (3, 2)


def test_personas_cost_no_more_than_ten_separate_fits(spark):
    g = Gold(spark, SF_SMALL)
    pts = kmeans.points(ml.training_table(g), "intern_id", ml.CLUSTER_FEATURES)
    ours = kmeans.fit(pts, "intern_id", ml.N_CLUSTERS, ml.N_INIT, ml.SEED)
    v = pts.select(array_to_vector("x").alias("features")).cache()
    theirs = min(KMeans(k=ml.N_CLUSTERS, seed=ml.SEED + i, maxIter=300, tol=1e-4).fit(v).summary.trainingCost for i in range(4))
    assert ours.cost <= theirs * (1 + 1e-3)
