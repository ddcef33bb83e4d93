"""Display formatting (C17, D6) and CASE bucketing.

Python's '%.0f' rounds half to even while Java's ``format_string`` rounds
half up, so every value is rounded with ``round_half_even`` to the printed
number of digits first. A null value gives a null label (``format_string``
alone would print the text 'null').
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.functions.common import col_of
from cohortlens.functions.numeric import round_half_even


def _guard(c: Column, out: Column) -> Column:
    return F.when(c.isNotNull(), out)


def fmt_num(c, digits: int = 0, suffix: str = "", prefix: str = "") -> Column:
    c = col_of(c)
    return _guard(c, F.format_string(f"{prefix}%.{digits}f{suffix}", round_half_even(c, digits)))


def fmt_pct0(c) -> Column:
    return fmt_num(c, 0, "%%")


def fmt_score(c) -> Column:
    return fmt_num(c, 1, "/100")


def fmt_hours(c, digits: int = 0) -> Column:
    return fmt_num(c, digits, " hrs")


def fmt_rank(rank, total) -> Column:
    return F.when(col_of(rank).isNull(), F.lit("N/A")).otherwise(
        F.format_string("#%d of %d", col_of(rank), col_of(total)))


def fmt_ratio(a, b) -> Column:
    return _guard(col_of(a), F.format_string("%d/%d", col_of(a), col_of(b)))


def dash_if_nonpositive(c, digits: int = 0, suffix: str = "%%") -> Column:
    """'—' for missing or non-positive values, else the rounded number."""
    c = col_of(c)
    return F.when(c.isNull() | (c <= 0), F.lit("—")).otherwise(
        F.format_string(f"%.{digits}f{suffix}", round_half_even(c, digits)))


def signed_delta(c) -> Column:
    c = col_of(c)
    return _guard(c, F.format_string("%+.1f", round_half_even(c, 1)))


def risk_level(score) -> Column:
    s = col_of(score)
    return F.when(s >= 50, "High").when(s >= 25, "Medium").otherwise("Low")


def progress_band(p) -> Column:
    p = col_of(p)
    return F.when(p >= 70, "good").when(p >= 40, "fair").otherwise("low")
