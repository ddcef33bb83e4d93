"""Models are not bit-reproducible against another library: checked by invariants."""

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from cohortlens.plans import ml
from cohortlens.sources.bindings import Gold
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def g(spark):
    return Gold(spark, SF_SMALL)


def test_features_one_row_per_intern(g):
    f = ml.features(g)
    assert f.count() == f.select("intern_id").distinct().count() > 0
    assert f.where(F.col("total_assg") < 1).count() == 0
    assert set(r[0] for r in f.select("is_at_risk").distinct().collect()) <= {0, 1}


def test_clusters_and_personas(g):
    c = ml.clusters(g, n_init=2).toPandas()
    f = ml.features(g).count()
    assert len(c) == f and c["cluster"].nunique() <= 3
    means = c.groupby("cluster")["progress"].mean()
    for cl, persona in c.groupby("cluster")["persona"].first().items():
        if persona == "High Performers":
            assert means[cl] > 75
        if persona == "Needs Support":
            assert means[cl] < 45


def test_forest_models(g):
    r = ml.test_score_model(g).toPandas()
    assert len(r) == ml.features(g).count()
    assert ((r["test_pct"] - r["predicted_test_pct"]).round(1) - r["score_diff"]).abs().max() < 0.11
    d = ml.dropout_model(g).toPandas()
    assert d["risk_probability"].between(0, 1).all()
    assert set(d["predicted_risk_class"].unique()) <= {0, 1}


def test_model_edge_rules(spark):
    import datetime as dt
    from tests.helpers import act_rows, courses, lms_rows, names
    day = dt.date(2026, 2, 1)

    def gold(n, progress):
        lms = lms_rows(spark, [(i, "C", progress, 1, 2, "In Progress") for i in range(1, n + 1)])
        act = act_rows(spark, [(i, day, "a", 5.0 + i) for i in range(1, n + 1)])
        return Gold.from_frames(spark, fact_lms=lms, fact_activity=act, dim_intern=names(spark, range(1, n + 1)),
                                dim_course=courses(spark, ["C"]))

    assert ml.clusters(gold(3, 50.0)).count() == 0            # n <= k: no personas
    assert ml.test_score_model(gold(4, 50.0)).count() == 0    # n < 5: no model
    one_class = ml.dropout_model(gold(6, 90.0)).toPandas()     # nobody at risk
    assert len(one_class) == 6
    assert (one_class["risk_probability"] == 0.5).all()
    assert (one_class["predicted_risk_class"] == one_class["is_at_risk"]).all()


def test_model_quality(g):
    r = ml.test_score_model(g).toPandas()
    rss = ((r["test_pct"] - r["predicted_test_pct"]) ** 2).sum()
    assert 1 - rss / ((r["test_pct"] - r["test_pct"].mean()) ** 2).sum() > 0.3
    d = ml.dropout_model(g).toPandas()
    pos, neg = d[d["is_at_risk"] == 1]["risk_probability"], d[d["is_at_risk"] == 0]["risk_probability"]
    if len(pos) and len(neg):
        auc = sum((p > neg).sum() + 0.5 * (p == neg).sum() for p in pos) / (len(pos) * len(neg))
        assert auc > 0.9


def test_clusters_keep_the_best_restart(g):
    def cost(c):
        x = c[ml.CLUSTER_FEATURES]
        x = (x - x.mean()) / x.std()
        return sum(((part - part.mean()) ** 2).to_numpy().sum() for _, part in x.groupby(c["cluster"]))

    best = cost(ml.clusters(g, n_init=4).toPandas())
    assert best <= min(cost(ml.clusters(g, n_init=n).toPandas()) for n in (1, 2)) * (1 + 1e-6)


def test_forest_after_an_observed_query(spark, g):
    seen = Observation()
    spark.range(10).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 10}
    assert ml.dropout_model(g).count() == len(ml.dropout_model(g).collect()) > 0
