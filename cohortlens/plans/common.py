"""Shared pieces of the analytics plans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortlens.functions.numeric import exact_sum
from cohortlens.operators.materialize import materialize
from cohortlens.sources.bindings import Gold

# Course short names and activity labels of the source sheets.
COURSE_SHORT = {
    "Basic Python Programming": "Python",
    "Basic SQL": "SQL",
    "Data Processing using NumPy & Pandas": "NumPy/Pandas",
    "Data Processing using Pyspark": "PySpark",
}
# The status spellings found in the sheets.
STATUS_VALUES = ("Completed", "In Progress", "In progress", "Not started", "Not Started")
IN_PROGRESS = ("In Progress", "In progress")
NOT_STARTED = ("Not started", "Not Started")


@dataclass(frozen=True)
class Params:
    """Run parameters shared by the mentor / intern views."""

    start: str | None = None        # inclusive date range on activity (F05)
    end: str | None = None
    outlier_hours: float = 12.0     # a day above this many hours is an outlier (A03)


def activity(g: Gold, p: Params | None = None) -> DataFrame:
    """fact_activity restricted to the date range; the filter reaches the scan."""
    fa = g.fact_activity
    if p is not None and p.start:
        fa = fa.where(F.col("date") >= F.lit(p.start).cast("date"))
    if p is not None and p.end:
        fa = fa.where(F.col("date") <= F.lit(p.end).cast("date"))
    return fa


def max_date(fa: DataFrame) -> Column:
    """Global last activity date as a scalar subquery (run once, inlined)."""
    return fa.agg(F.max("date")).scalar()


def hours_sum(c="hours") -> Column:
    """Exact, order-independent sum of hours, as double."""
    return exact_sum(c)


# Dimensions of at most so many rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 100_000


def small_side(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and marked for broadcast if it has at most
    BROADCAST_ROWS rows (counted, not estimated); else it is joined by shuffle."""
    df = materialize(df, name)
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def course_dim(g: Gold) -> DataFrame:
    """The course dimension for joins to facts, measured once per Gold."""
    if getattr(g, "_course_dim", None) is None:
        g._course_dim = small_side(g.dim_course, "dim_course")
    return g._course_dim
