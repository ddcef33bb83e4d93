"""k-means with restarts, all of them in each scan of the points.

Every restart keeps its own centres. One pass over the points serves all
restarts that still move: a task compares its rows with all centres at once and
gives one row per restart and centre (count, sums, cost), so what is shuffled
and what reaches the driver depends on restarts and centres, not on the points.

Start centres are drawn as in k-means++, exactly and in parallel: a row's
waiting time is an exponential variable divided by its squared distance to the
centres chosen so far, and the shortest wait wins, which is a draw with
probability in proportion to that distance. The variable comes from a hash of
row, restart and step, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.operators.materialize import materialize

BLOCK = 8192                      # rows compared at a time in a task
SUM_TYPE = "decimal(38,12)"       # sums of a task's parts: exact, so in any order


@dataclass(frozen=True)
class Fit:
    centers: np.ndarray           # (k, features) of the best restart, in the scaled space
    cost: float                   # its sum of squared distances
    costs: tuple[float, ...]      # of every restart
    passes: int                   # scans of the points


def points(df: DataFrame, key: str, cols: list[str], name: str = "points") -> DataFrame:
    """``key`` and the standardised features ``x`` (mean 0, sample deviation 1;
    a constant or null feature is 0), written once for the passes."""
    stats = df.agg(*[f(c).alias(f"{n}{i}") for i, c in enumerate(cols) for n, f in (("m", F.avg), ("s", F.stddev_samp))]).first()

    def scaled(i: int, c: str) -> Column:
        mean, dev = stats[f"m{i}"], stats[f"s{i}"]
        if not dev or dev != dev:
            return F.lit(0.0)
        return F.coalesce((F.col(c) - F.lit(float(mean))) / F.lit(float(dev)), F.lit(0.0))

    return materialize(df.select(key, F.array(*[scaled(i, c) for i, c in enumerate(cols)]).alias("x")), name)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _distances(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances, rows x restarts x centres; differences, not dot
    products, so that a row on a centre is at distance 0."""
    d = np.zeros((len(x), *centers.shape[:2]))
    for j in range(centers.shape[2]):
        d += (x[:, j, None, None] - centers[None, :, :, j]) ** 2
    return d


def _draw(pts: DataFrame, key: str, centers: np.ndarray | None, restarts: int, width: int, step: int, seed: int) -> np.ndarray:
    """One more start centre for every restart, in one pass: (restarts, features).
    Where every row lies on a centre all waits are infinite and any row is taken."""
    u = [(F.shiftrightunsigned(F.xxhash64(F.col(key), F.lit(seed), F.lit(r), F.lit(step)), 12).cast("double") + 0.5)
         / float(1 << 52) for r in range(restarts)]
    rows = pts.select(key, "x", F.array(*[-F.log(v) for v in u]).alias("e"))

    def waits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x, e = _matrix(b.column("x"), width), _matrix(b.column("e"), restarts)
            best = []
            for at in range(0, len(x), BLOCK):
                part = e[at:at + BLOCK].copy()
                if centers is not None:
                    d = _distances(x[at:at + BLOCK], centers).min(axis=2)
                    with np.errstate(divide="ignore"):
                        part /= d
                low = part.argmin(axis=0)
                best += [(r, float(part[i, r]), at + int(i)) for r, i in enumerate(low)]
            if best:
                pick = pa.array([i for _, _, i in best])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r for r, _, _ in best], pa.int32()), pa.array([w for _, w, _ in best], pa.float64()),
                     b.column(key).take(pick), b.column("x").take(pick)], names=["r", "w", key, "x"])

    kind = pts.schema[key].dataType.simpleString()
    cand = rows.mapInArrow(waits, f"r int, w double, `{key}` {kind}, x array<double>")
    won = cand.groupBy("r").agg(F.min_by("x", F.struct("w", key)).alias("x")).collect()   # one row a restart
    return np.array([r["x"] for r in sorted(won, key=lambda r: r["r"])])


def _pass(pts: DataFrame, centers: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Counts, sums and costs for (restart, centre) in one scan."""
    n_r, k, width = centers.shape
    sums = [f"s{j}" for j in range(width)]

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total, cost = np.zeros((n_r, k), np.int64), np.zeros((n_r, k, width)), np.zeros((n_r, k))
        for b in batches:
            every = _matrix(b.column("x"), width)
            for at in range(0, len(every), BLOCK):
                x = every[at:at + BLOCK]
                d = _distances(x, centers)
                near = d.argmin(axis=2)     # ties: smaller number
                for r in range(n_r):
                    own = near[:, r]
                    count[r] += np.bincount(own, minlength=k)
                    cost[r] += np.bincount(own, weights=d[np.arange(len(x)), r, own], minlength=k)
                    for j in range(width):
                        total[r, :, j] += np.bincount(own, weights=x[:, j], minlength=k)
        r, c = np.divmod(np.arange(n_r * k), k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(r, pa.int32()), pa.array(c, pa.int32()), pa.array(count.ravel()), pa.array(cost.ravel()),
             *[pa.array(total[:, :, j].ravel()) for j in range(width)]], names=["r", "c", "n", "cost", *sums])

    fields = ", ".join(["r int, c int, n long, cost double", *[f"{s} double" for s in sums]])
    got = pts.select("x").mapInArrow(partial, fields).groupBy("r", "c").agg(
        F.sum("n").alias("n"), *[F.sum(F.col(c).cast(SUM_TYPE)).cast("double").alias(c) for c in ["cost", *sums]])
    count, total, cost = np.zeros((n_r, k)), np.zeros((n_r, k, width)), np.zeros((n_r, k))
    for row in got.collect():               # restarts x centres rows
        count[row["r"], row["c"]], cost[row["r"], row["c"]] = row["n"], row["cost"]
        total[row["r"], row["c"]] = [row[s] for s in sums]
    return count, total, cost


def fit(pts: DataFrame, key: str, k: int, restarts: int, seed: int = 0, max_iter: int = 300, tol: float = 1e-4) -> Fit:
    """Lloyd's rounds for all ``restarts`` until no centre of a restart moves by
    more than ``tol``; the restart of the lowest cost is kept (ties: the first).
    An empty centre stays where it is. Needs at least one point."""
    width = len(pts.select("x").first()["x"])
    centers, passes = None, 0
    for step in range(k):
        drawn = _draw(pts, key, centers, restarts, width, step, seed)[:, None, :]
        centers = drawn if centers is None else np.concatenate([centers, drawn], axis=1)
        passes += 1
    moving = np.arange(restarts)
    for _ in range(max_iter):
        count, total, _ = _pass(pts, centers[moving])
        passes += 1
        new = np.where(count[:, :, None] > 0, total / np.maximum(count, 1)[:, :, None], centers[moving])
        moved = np.sqrt(((new - centers[moving]) ** 2).sum(axis=2)).max(axis=1)
        centers[moving] = new
        moving = moving[moved > tol]
        if not len(moving):
            break
    costs = _pass(pts, centers)[2].sum(axis=1)
    best = int(costs.argmin())
    return Fit(centers[best], float(costs[best]), tuple(map(float, costs)), passes + 1)


def nearest(x, centers: np.ndarray) -> Column:
    """The number of the centre nearest to the array column ``x`` (ties: smaller)."""
    def dist(c) -> Column:
        terms = [(F.col(x)[j] - F.lit(float(v))) * (F.col(x)[j] - F.lit(float(v))) for j, v in enumerate(c)]
        return sum(terms[1:], terms[0])
    return F.array_min(F.array(*[F.struct(dist(c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(centers)]))["i"]
