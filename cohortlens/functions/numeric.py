"""Numeric parsing and arithmetic guards.

ANSI mode stays on: every parse goes through ``try_cast`` so bad input
becomes null instead of failing the job, and ``NaN`` text becomes null too.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.functions.common import col_of



def to_double(c) -> Column:
    """Lenient string -> double: junk and 'nan' give null."""
    d = F.trim(col_of(c).cast("string")).try_cast("double")
    return F.nanvl(d, F.lit(None).cast("double"))


def parse_percent(c) -> Column:
    """C05 / D11: '50%' -> 50.0; all trailing '%' removed; junk -> null."""
    return to_double(F.regexp_replace(F.trim(col_of(c).cast("string")), "%+$", ""))


def fraction_part(c, idx: int, default: float | int, as_int: bool = False) -> Column:
    """Part ``idx`` (0-based) of an 'a / b' fraction, with a default.

    Missing parts, junk and nulls give the default; with ``as_int`` the
    value is truncated toward zero (so '3.7' gives 3).
    """
    parts = F.split(col_of(c).cast("string"), "/")
    v = F.coalesce(to_double(F.try_element_at(parts, F.lit(idx + 1))), F.lit(float(default)))
    return v.cast("int") if as_int else v


def zero_to_one(c) -> Column:
    """Denominator guard, exactly 0 becomes 1 (negatives pass)."""
    c = col_of(c)
    return F.when(c == 0, F.lit(1)).otherwise(c)


def at_least_one(c) -> Column:
    """Denominator guard, clip below at 1."""
    return F.greatest(col_of(c), F.lit(1))


def round_half_even(c, digits: int = 1) -> Column:
    """Decimal half-even rounding of a double.

    The value is first fixed to 9 decimals so that binary noise
    (34.45 is stored as 34.4500000000000028...) does not decide the tie.
    """
    return F.bround(col_of(c).cast("decimal(38,9)"), digits).cast("double")


def pct(scored, total, digits: int = 1) -> Column:
    """round(scored / guard(total) * 100, 1)."""
    return round_half_even(col_of(scored) / zero_to_one(total) * 100, digits)


def clip(c, lower=None, upper=None) -> Column:
    """Clip below / above (``greatest`` / ``least``)."""
    c = col_of(c)
    if lower is not None:
        c = F.greatest(c, F.lit(lower))
    if upper is not None:
        c = F.least(c, F.lit(upper))
    return c


def exact_units(c, decimals: int = 2) -> Column:
    """A value with ``decimals`` decimals as an exact integer count of units."""
    return F.rint(col_of(c) * float(10 ** decimals)).cast("bigint")


SUM_DECIMALS = 7
_MAX_PART = 9.0e15


def finite(c) -> Column:
    """The value, null if it is NaN or too large in size for an exact sum."""
    c = col_of(c).cast("double")
    return F.when(F.abs(c) <= _MAX_PART, c)  # comparing NaN: it is larger than any number


def unsummable(c) -> Column:
    """How many values ``exact_sum`` leaves out: NaN, infinite or beyond 9e15."""
    c = col_of(c).cast("double")
    return F.count_if(c.isNotNull() & finite(c).isNull())


def exact_sum(c) -> Column:
    """Order-independent sum as double. Whole parts and fractions (in units of
    1e-7, over a trillion rows per group) are added as integers on the fast
    aggregation path; only the two totals are joined as decimals. Null
    without a summable value; see ``unsummable`` for those left out."""
    whole, part = sum_parts(c)
    return join_parts(F.sum(whole), F.sum(part))


def sum_parts(c) -> tuple[Column, Column]:
    """Whole part and fraction (units of 1e-7) as integers, whose sums can be
    stored and added further before ``join_parts``."""
    v = finite(c)
    whole = F.floor(v)
    return whole.cast("bigint"), F.rint((v - whole) * float(10 ** SUM_DECIMALS)).cast("bigint")


def join_parts(whole: Column, part: Column) -> Column:
    """The double of two sums of ``sum_parts``."""
    units = (whole.cast("decimal(20,0)") * F.lit(10 ** SUM_DECIMALS).cast("decimal(9,0)")
             + part.cast("decimal(20,0)"))
    return (units.cast("decimal(31,0)") * F.lit("0.0000001").cast("decimal(7,7)")).cast("double")
