"""Machine learning on the per-intern feature table.

Features are one row per intern, built with aggregates (M01). Models are
trained on executors (M02 by ``operators.kmeans``, M03 and M04 by Spark ML)
over the feature table, written once.
"""

from __future__ import annotations

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.numeric import exact_sum, round_half_even
from cohortlens.operators import kmeans
from cohortlens.operators.materialize import materialize
from cohortlens.operators.ranking import exact_median
from cohortlens.plans.activity import total_hours
from cohortlens.plans.lms import with_scores
from cohortlens.sources.bindings import Gold

# Model settings and the at-risk rule.
SEED = 42
N_TREES, MAX_DEPTH = 50, 5
N_CLUSTERS, N_INIT = 3, 10
KMEANS_MAX_ITER, KMEANS_TOL = 300, 1e-4   # run each restart to convergence
AT_RISK_PROGRESS, AT_RISK_PROGRESS_LOW_EFFORT, LOW_EFFORT_SHARE = 40, 60, 0.75
MIN_ROWS = 5
CLUSTER_FEATURES = ["progress", "hours", "assg_ratio", "kc_pct"]
REGRESSION_FEATURES = ["progress", "hours", "assg_ratio", "kc_pct"]
CLASSIFIER_FEATURES = ["progress", "hours", "assg_ratio", "kc_pct", "test_pct"]
# Persona names and thresholds on cluster mean progress.
PERSONA_HIGH, PERSONA_SUPPORT, PERSONA_STEADY, PERSONA_EFFICIENT = (
    "High Performers", "Needs Support", "Steady Workers", "Efficient Learners")
PERSONA_HIGH_MIN, PERSONA_SUPPORT_MAX = 75, 45


def features(g: Gold) -> DataFrame:
    """One row per intern with LMS rows and activity (inner join):
    mean progress, assignment sums and ratio, mean KC % / test %, hours, and
    the at-risk label (progress < 40, or < 60 with hours under 0.75 x the
    median hours of all interns with activity)."""
    s = with_scores(g.fact_lms)
    lms = s.groupBy("intern_id").agg(
        F.avg("progress").alias("progress"), F.sum("reviewed").alias("reviewed"),
        F.sum("total_assg").alias("total_assg_raw"),
        (exact_sum("kc_pct") / F.count("kc_pct")).alias("kc_pct"),
        (exact_sum("test_pct") / F.count("test_pct")).alias("test_pct"))
    th = total_hours(g)
    med = exact_median(th, "total_hours", "m").scalar()
    j = lms.join(th, "intern_id")
    total = F.when(F.col("total_assg_raw") == 0, F.lit(1)).otherwise(F.col("total_assg_raw"))
    p = F.col("progress")
    risk = (p < AT_RISK_PROGRESS) | ((p < AT_RISK_PROGRESS_LOW_EFFORT) & (F.col("total_hours") < med * LOW_EFFORT_SHARE))
    out = j.select("intern_id", p.alias("progress"), F.col("reviewed").cast("bigint").alias("reviewed"),
                   total.cast("bigint").alias("total_assg"), (F.col("reviewed") / total).alias("assg_ratio"),
                   round_half_even(F.col("kc_pct"), 6).alias("kc_pct"),
                   round_half_even(F.col("test_pct"), 6).alias("test_pct"),
                   F.col("total_hours").alias("hours"), risk.cast("int").alias("is_at_risk"))
    return out.na.fill(0)


def training_table(g: Gold) -> DataFrame:
    """The feature table written to the shared checkpoint folder: every model
    makes several passes over it, none of which re-runs the aggregations."""
    return materialize(features(g), "ml_features")


def _assembled(df: DataFrame, cols: list[str], name: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=cols, outputCol=name, handleInvalid="keep").transform(df)


def clusters(g: Gold, k: int = N_CLUSTERS, n_init: int = N_INIT, max_iter: int = KMEANS_MAX_ITER) -> DataFrame:
    """Personas from k-means on standardised features: ``n_init`` restarts,
    each to convergence or ``max_iter`` rounds, served together by one scan of
    the feature table a round; the lowest cost is kept. Persona rule on cluster
    means: > 75 progress High Performers, < 45 Needs Support, hours above the
    mean of cluster means Steady Workers, else Efficient Learners. Empty when
    there are <= k interns."""
    f = training_table(g)
    if f.count() <= k:
        return f.limit(0).withColumn("cluster", F.lit(0)).withColumn("persona", F.lit(""))
    pts = kmeans.points(f, "intern_id", CLUSTER_FEATURES)
    best = kmeans.fit(pts, "intern_id", k, n_init, SEED, max_iter, KMEANS_TOL)
    near = pts.select("intern_id", kmeans.nearest("x", best.centers).alias("cluster"))
    # Written to the shared checkpoint folder: the means and the result read it.
    pred = materialize(f.join(near, "intern_id").select(*f.columns, "cluster"), "clusters")
    means = pred.groupBy("cluster").agg(F.avg("progress").alias("cp"), F.avg("hours").alias("ch"))
    mean_of_means = means.agg(F.avg("ch")).scalar()
    persona = (F.when(F.col("cp") > PERSONA_HIGH_MIN, PERSONA_HIGH)
                .when(F.col("cp") < PERSONA_SUPPORT_MAX, PERSONA_SUPPORT)
                .when(F.col("ch") > mean_of_means, PERSONA_STEADY).otherwise(PERSONA_EFFICIENT))
    labels = means.select("cluster", persona.alias("persona"))
    # One row per cluster: broadcast is bounded by k.
    return pred.join(F.broadcast(labels), "cluster").select(*f.columns, "cluster", "persona")


def test_score_model(g: Gold) -> DataFrame:
    """Random-forest regression of test % on the other features, fitted
    and applied on the same rows (anomaly view), with the residual."""
    f = training_table(g)
    if f.count() < MIN_ROWS:
        return f.limit(0).withColumn("predicted_test_pct", F.lit(0.0)).withColumn("score_diff", F.lit(0.0))
    x = _assembled(f, REGRESSION_FEATURES)
    rf = RandomForestRegressor(featuresCol="features", labelCol="test_pct", numTrees=N_TREES, maxDepth=MAX_DEPTH,
                               seed=SEED, featureSubsetStrategy="all")
    pred = rf.fit(x).transform(x)
    out = pred.withColumn("predicted_test_pct", round_half_even(F.col("prediction"), 1))
    return out.select(*f.columns, "predicted_test_pct",
                      round_half_even(F.col("test_pct") - F.col("predicted_test_pct"), 1).alias("score_diff"))


def dropout_model(g: Gold) -> DataFrame:
    """Random-forest classifier of the at-risk label with balanced class
    weights n / (2 n_class); with one class only, probability 0.5 and the
    label itself as prediction."""
    f = training_table(g)
    n = f.count()
    if n < MIN_ROWS:
        return f.limit(0).withColumn("risk_probability", F.lit(0.0)).withColumn("predicted_risk_class", F.lit(0))
    counts = f.groupBy("is_at_risk").agg(F.count(F.lit(1)).alias("n_class"))
    n_classes = counts.count()
    if n_classes < 2:
        return f.withColumn("predicted_risk_class", F.col("is_at_risk")).withColumn("risk_probability", F.lit(0.5))
    # One row per class: the weight table has two rows and is broadcast.
    w = f.join(F.broadcast(counts), "is_at_risk").withColumn("weight", F.lit(float(n)) / (2 * F.col("n_class")))
    x = _assembled(w, CLASSIFIER_FEATURES)
    rf = RandomForestClassifier(featuresCol="features", labelCol="is_at_risk", weightCol="weight",
                                numTrees=N_TREES, maxDepth=MAX_DEPTH, seed=SEED, featureSubsetStrategy="sqrt")
    # A copy has no training summary, which holds the session and cannot be sent once the session has observed a write.
    pred = rf.fit(x).copy().transform(x)
    return pred.select(*f.columns,
                       round_half_even(vector_to_array("probability")[1], 3).alias("risk_probability"),
                       F.col("prediction").cast("int").alias("predicted_risk_class"))
