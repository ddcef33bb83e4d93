"""A key holding most of the rows: results stay exact and the hot group is
spread over several tasks instead of one."""

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from cohortlens.operators import exact_quantiles, keep_last, rank_rows


def hot_frame(spark, n_hot=6000, n_cold=30):
    rng = np.random.default_rng(3)
    g = ["hot"] * n_hot + [f"c{i}" for i in range(n_cold)]
    pdf = pd.DataFrame({"id": np.arange(len(g)), "g": g, "v": rng.random(len(g)).round(6)})
    return pdf, spark.createDataFrame(pdf)


def test_grouped_rank_spreads_hot_group(spark):
    pdf, df = hot_frame(spark)
    ranked = rank_rows(df, [F.desc("v"), F.asc("id")], group=["g"], name="r", num_partitions=8)
    # the positions of the hot group come from several range partitions
    parts = ranked.where("g = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 4
    got = ranked.toPandas().set_index("id")["r"]
    exp = pdf.sort_values(["g", "v", "id"], ascending=[True, False, True])
    exp["r"] = exp.groupby("g").cumcount() + 1
    assert (got.loc[exp["id"]].values == exp["r"].values).all()


def test_hot_group_quantile_and_keep_last(spark):
    pdf, df = hot_frame(spark)
    q = {r.g: r.m for r in exact_quantiles(df, "v", [0.5], ["m"], group=["g"], num_partitions=8).collect()}
    assert np.isclose(q["hot"], pdf[pdf.g == "hot"]["v"].median())
    last = {r.g: r.id for r in keep_last(df, ["g"], "id").collect()}
    assert last["hot"] == pdf[pdf.g == "hot"]["id"].max()
