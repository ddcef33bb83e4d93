"""Centroid clustering in integers with a bisector tournament.

For centroids i < j, |x - ci|^2 <= |x - cj|^2 says the same as
x . (2 cj - 2 ci) <= |cj|^2 - |ci|^2: an integer normal and a threshold, made
once a round for each pair. A vector starts with centroid 0 and meets 1, 2,
...: the sign of one linear test a centroid tells which of two stays, zero
keeps the smaller number, and after k - 1 tests the nearest is left. Only its
distance is computed.

Each round is one map over the vectors; a task sends its sums, one row for
each component of a centroid, and the driver sees as many rows of totals.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortlens.llm.common import materialize

CLUSTERS, ROUNDS, WIDTH, SCALE, SEED = 8, 10, 64, 1024, 3
# 64 squared differences of components up to this, in size, fit in a long.
LARGEST = 1 << 27
STEP = 8192  # vectors handled at a time
MAX_LONG = (1 << 63) - 1


def matrix(col: pa.Array, width: int) -> np.ndarray:
    return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), width)


def bisectors(c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """normal[i, j] and threshold[i, j] of each pair i < j of centroids."""
    sq = (c * c).sum(axis=1)
    return 2 * (c[None, :, :] - c[:, None, :]), sq[None, :] - sq[:, None]


def tournament(x: np.ndarray, normal: np.ndarray, threshold: np.ndarray) -> np.ndarray:
    """The nearest centroid of each row, by k - 1 sign tests."""
    winner = np.zeros(len(x), np.int64)
    for j in range(1, len(normal)):
        for i in range(j):  # the rows that i has won so far
            rows = np.flatnonzero(winner == i)
            if len(rows):
                winner[rows[x[rows] @ normal[i, j] > threshold[i, j]]] = j
    return winner


def _sums(c: np.ndarray):
    """(cluster, axis, n, s): count and sum of each component over a partition."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, width = c.shape
        normal, threshold = bisectors(c)
        n, total = np.zeros(k, np.int64), np.zeros((k, width), np.int64)  # 2^36 rows of a partition fit
        for b in batches:
            for part in (b.slice(i, STEP) for i in range(0, b.num_rows, STEP)):
                x = matrix(part.column(0), width)
                w = tournament(x, normal, threshold)
                n += np.bincount(w, minlength=k)
                for i in range(k):
                    total[i] += x[w == i].sum(axis=0)
        at = np.indices((k, width), dtype=np.int32).reshape(2, -1)
        yield pa.RecordBatch.from_arrays([pa.array(at[0]), pa.array(at[1]), pa.array(np.repeat(n, width)), pa.array(total.ravel())],
                                         names=["cluster", "axis", "n", "s"])
    return run


def _assign(c: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        normal, threshold = bisectors(c)
        for b in batches:
            for part in (b.slice(i, STEP) for i in range(0, b.num_rows, STEP)):
                x = matrix(part.column(1), c.shape[1])
                w = tournament(x, normal, threshold)
                d = x - c[w]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(w.astype(np.int32)), pa.array((d * d).sum(axis=1))],
                                                 names=["vec_id", "cluster", "distance"])
    return run


def integer_vectors(rows: DataFrame, id_col: str = "vec_id", vector: str = "embedding", width: int = WIDTH, scale: int = SCALE) -> DataFrame:
    """(vec_id, x): floor(scale * component) of the vectors with exactly
    ``width`` components, none null or non-finite."""
    v = F.col(vector).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) <= LARGEST / scale))
    kept = rows.where(F.col(vector).isNotNull() & (F.size(vector) == width) & sound)
    return kept.select(F.col(id_col).cast("long").alias("vec_id"), F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x).cast("long")).alias("x"))


def bisector_clusters(rows: DataFrame, clusters: int = CLUSTERS, rounds: int = ROUNDS, id_col: str = "vec_id",
                      vector: str = "embedding", width: int = WIDTH, scale: int = SCALE, seed: int = SEED) -> DataFrame:
    """Per kept vector of ``rows``: vec_id, cluster, distance (squared),
    cluster_inertia, inertia, centroid_sha256.

    Centroids start as the ``clusters`` vectors with the smallest
    sha256("<seed>:<id>"), all of them if fewer; a null id comes last, rows of
    one id by their components. Of equal centroids the smaller number wins
    all, and an empty one stays where it is. Left out: null vectors, those of
    another length or with a null or non-finite component, and those with a
    component beyond 2^27 after scaling, whose distance no long holds. A sum
    of distances beyond a long reads as the largest long. Repeated rows count
    each. Other columns are not read. Empty input gives no rows.
    """
    x = materialize(integer_vectors(rows, id_col, vector, width, scale), "bc_vectors")
    spark = rows.sparkSession
    start = (x.withColumn("h", F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256))
             .orderBy(F.col("h").asc_nulls_last(), "x").limit(clusters).select("x").collect())  # k rows
    if not start:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    c = np.array([r.x for r in start], np.int64)
    for _ in range(rounds):
        sums = x.select("x").mapInArrow(_sums(c), "cluster int, axis int, n long, s long")
        total = sums.groupBy("cluster", "axis").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(28,0)")).alias("s"))
        new = c.copy()
        for r in total.where("n > 0").collect():  # a row for each component of a centroid
            new[r.cluster, r.axis] = int(r.s) // r.n
        if (new == c).all():  # further rounds would change nothing
            break
        c = new
    out = materialize(x.select("vec_id", "x").mapInArrow(_assign(c), "vec_id long, cluster int, distance long"), "bc_assigned")
    per = out.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(28,0)")).alias("s")).collect()  # k rows
    inertia = min(MAX_LONG, sum(int(r.s) for r in per))
    stats = spark.createDataFrame([(r.cluster, min(MAX_LONG, int(r.s)), inertia, ",".join(map(str, c[r.cluster].tolist()))) for r in per],
                                  "cluster int, cluster_inertia long, inertia long, csv string")
    stats = stats.withColumn("centroid_sha256", F.sha2(F.col("csv").cast("binary"), 256)).drop("csv")
    return out.join(F.broadcast(stats), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
