"""Small relational building blocks shared by the analytics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortlens.functions.numeric import exact_sum
from cohortlens.operators.scalar import attach_row



def share_of_total(df: DataFrame, value: str, group: Sequence[str] = (), name: str = "share") -> DataFrame:
    """value / sum(value) over the group, as aggregate + join (no single-task
    window). The total does not depend on row order."""
    group = list(group)
    total = exact_sum(value).alias("__tot")
    tot = df.groupBy(*group).agg(total) if group else df.agg(total)
    j = df.join(tot, group, "left") if group else attach_row(df, tot)
    return j.withColumn(name, F.try_divide(F.col(value), F.col("__tot"))).drop("__tot")


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner",
                   right_keys: Sequence[str] | None = None) -> DataFrame:
    """Equi-join where null matches null (pandas merge semantics)."""
    right_keys = list(right_keys or keys)
    r = right.select(*[F.col(c).alias(f"__r_{c}") if c in right_keys else F.col(c) for c in right.columns])
    cond = [left[lk].eqNullSafe(r[f"__r_{rk}"]) for lk, rk in zip(keys, right_keys)]
    return left.join(r, cond, how).drop(*[f"__r_{rk}" for rk in right_keys])


def islands(df: DataFrame, key: Sequence[str], day: str, name: str = "island") -> DataFrame:
    """Gaps-and-islands on one-row-per-(key, day) input: rows of consecutive
    calendar days share ``name`` (= day - row_number)."""
    w = Window.partitionBy(*key).orderBy(day)
    return df.withColumn(name, F.date_sub(F.col(day), F.row_number().over(w).cast("int")))


def keep_last(df: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """One row per key, the one with the largest ``order`` value.

    Written as ``max_by`` over a struct of the row: an aggregate with a
    map-side partial step, so a key holding a large share of the rows is
    reduced on every partition before the shuffle (a window would sort that
    key's rows in one task). ``order`` should be unique within a key; a null
    order value comes before all others.
    """
    rest = [c for c in df.columns if c not in keys]
    # A struct is never null, so rows with a null order value count too.
    by = F.struct(F.col(order).isNotNull().alias("set"), F.col(order).alias("value"))
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), by).alias("__row"))
    return agg.select(*keys, *[F.col(f"__row.{c}").alias(c) for c in rest])


def scoped_view(dim: DataFrame, column: str, value) -> DataFrame:
    """the rows of ``dim`` whose ``column`` equals ``value``; all rows when
    none does (the sign-in fallback). The match count is a one-row aggregate,
    broadcast to every row."""
    hit = dim.agg(F.count_if(F.col(column) == F.lit(value)).alias("__hits"))
    j = attach_row(dim, hit)
    return j.where((F.col("__hits") == 0) | (F.col(column) == F.lit(value))).drop("__hits")
