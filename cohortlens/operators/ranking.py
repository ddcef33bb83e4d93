"""Ranking and quantiles without funnelling rows into one task.

``Window.orderBy(...)`` without ``partitionBy`` moves every row into a
single partition, and a global ``percentile`` keeps every distinct value in
one aggregation buffer. Both break at cluster scale. Here the rows are
range-partitioned on the sort key instead; each partition is sorted
locally, the per-partition (and per-group) row counts are a small side
table, and a row's position is its partition's offset plus its place in
the partition. Every step is parallel; the side table has at most one row
per (partition, group).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.common import col_of
from cohortlens.operators.materialize import materialize

_PID, _MID = "__pid", "__mid"


def _sort_key_names(order: Sequence) -> list[Column]:
    return [col_of(c) for c in order]


def _ranged(df: DataFrame, order: Sequence, group: Sequence[str], num_partitions: int | None) -> tuple[DataFrame, DataFrame]:
    """(rows, stats): the rows range-partitioned and sorted, written once with
    their partition and place, and per (partition, group) the offset, the
    first place and the group's count. Both come from the written table, so
    they always agree, whatever columns the rows carry."""
    cols = [F.col(g) for g in group] + _sort_key_names(order)
    n = num_partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    s = materialize(df.repartitionByRange(n, *cols).sortWithinPartitions(*cols)
                    .withColumn(_PID, F.spark_partition_id()).withColumn(_MID, F.monotonically_increasing_id()), "ranked")
    stats = s.groupBy(_PID, *group).agg(F.count(F.lit(1)).alias("__n"), F.min(_MID).alias("__first"))
    # One row per (partition, group): at most num_partitions rows without a group.
    w = Window.partitionBy(*group) if group else Window.partitionBy()
    before = w.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    stats = (stats.withColumn("__offset", F.coalesce(F.sum("__n").over(before), F.lit(0)))
             .withColumn("__cnt", F.sum("__n").over(w)))
    return s, stats


def positions(df: DataFrame, order: Sequence, group: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """``df`` with __pos (1-based position in ``order`` within ``group``, whose
    nulls are a group) and __cnt (rows of the group)."""
    group = list(group)
    s, stats = _ranged(df, order, group, num_partitions)
    keys = [_PID, *group]
    stats = stats.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__offset", "__first", "__cnt")
    if not group:
        stats = F.broadcast(stats)
    cond = [F.col(k).eqNullSafe(F.col(f"__k{i}")) for i, k in enumerate(keys)]
    return s.join(stats, cond, "inner").select(
        *[F.col(c) for c in df.columns], (F.col("__offset") + (F.col(_MID) - F.col("__first")) + 1).alias("__pos"), "__cnt")


def rank_rows(df: DataFrame, order: Sequence, group: Sequence[str] = (),
              name: str = "rank", num_partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1-based position of each row in ``order`` (within ``group``).

    ``order`` must be a total order (end it with a unique key) for the
    result to be deterministic; ties otherwise get arbitrary distinct
    positions, like ``row_number``.
    """
    out = positions(df, order, group, num_partitions)
    return out.select(*df.columns, F.col("__pos").alias(name))


def exact_quantiles(df: DataFrame, value: str, qs: Sequence[float], names: Sequence[str] | None = None,
                    group: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Exact quantiles with linear interpolation (the definition of pandas
    ``quantile`` and SQL ``quantile_cont``), one row per group, computed by
    distributed ranking; nulls are ignored. Empty input gives nulls."""
    group = list(group)
    names = list(names or [f"q{int(q * 100)}" for q in qs])
    v = df.select(*group, F.col(value).cast("double").alias("__v")).where(F.col("__v").isNotNull())
    pos = positions(v, [F.col("__v")], group, num_partitions)
    aggs, wanted = [], None
    for q, nm in zip(qs, names):
        k = (F.col("__cnt") - 1) * F.lit(float(q))
        lo, hi = F.floor(k) + 1, F.ceil(k) + 1
        v_lo = F.max(F.when(F.col("__pos") == lo, F.col("__v")))
        v_hi = F.max(F.when(F.col("__pos") == hi, F.col("__v")))
        frac = F.max(F.when(F.col("__pos") == lo, k - F.floor(k)))
        aggs.append((v_lo + (v_hi - v_lo) * frac).alias(nm))
        c = (F.col("__pos") == lo) | (F.col("__pos") == hi)
        wanted = c if wanted is None else (wanted | c)
    # Only the (at most two per quantile) rows at the wanted positions
    # survive the filter, so the final aggregate is tiny.
    sel = pos.where(wanted)
    return sel.groupBy(*group).agg(*aggs) if group else sel.agg(*aggs)


def approx_quantiles(df: DataFrame, value: str, qs: Sequence[float], names: Sequence[str] | None = None,
                     group: Sequence[str] = (), accuracy: int = 10_000) -> DataFrame:
    """Sketch-based quantiles (``percentile_approx``): one aggregate with a
    bounded buffer per group, relative rank error 1 / accuracy. For cohorts
    where the exact ranking pass is not worth its shuffle."""
    names = list(names or [f"q{int(q * 100)}" for q in qs])
    v = F.col(value).cast("double")
    aggs = [F.percentile_approx(v, float(q), accuracy).alias(n) for q, n in zip(qs, names)]
    return df.groupBy(*group).agg(*aggs) if group else df.agg(*aggs)


def exact_median(df: DataFrame, value: str, name: str = "median") -> DataFrame:
    return exact_quantiles(df, value, [0.5], [name])
