"""Attaching a one-row result (a global aggregate) to every row."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def attach_row(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Add the columns of ``one_row`` to every row of ``df``.

    ``one_row`` must be a global aggregate (``df.agg(...)`` without grouping
    keys), which has exactly one row whatever the input size; it is
    broadcast, so the join is a nested loop over a single build row and no
    shuffle of ``df`` happens. Use it for several statistics of one
    aggregate at once; a single value can also be a scalar subquery
    (``DataFrame.scalar()``) placed in one projection.
    """
    return df.crossJoin(F.broadcast(one_row))
