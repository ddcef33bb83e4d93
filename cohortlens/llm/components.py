"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import materialize


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of the undirected ``edges`` (a, b longs):
    root is the smallest node of its component.

    Each round every node picks its smallest neighbour (an aggregate with
    map-side combine), follows the pick once more, and the edges are redrawn
    between picks; loops vanish. Components at least halve, so the rounds are
    logarithmic; each is written, which cuts the lineage.
    """
    e = materialize(edges.where(F.col("a") != F.col("b"))
                    .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc_edges")
    both = e.select(F.col("a").alias("node")).union(e.select("b")).distinct()
    labels = both.withColumn("root", F.col("node"))
    while not e.isEmpty():
        near = e.select("a", "b").union(e.select("b", "a")).toDF("node", "other")
        pick = near.groupBy("node").agg(F.least(F.min("other"), F.first("node")).alias("p"))
        pick = materialize(pick, "cc_pick")
        then = pick.select(F.col("node").alias("p"), F.col("p").alias("pp"))
        jump = materialize(pick.join(then, "p", "left").select("node", F.coalesce("pp", "p").alias("p")), "cc_jump")
        labels = materialize(labels.join(jump.withColumnRenamed("node", "root"), "root", "left")
                             .select("node", F.coalesce("p", "root").alias("root")), "cc_labels")
        left, right = jump.toDF("a", "pa"), jump.toDF("b", "pb")
        e = e.join(left, "a").join(right, "b").where(F.col("pa") != F.col("pb"))
        e = materialize(e.select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc_edges")
    return labels
