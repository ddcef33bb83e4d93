"""Date parsing and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.functions.common import col_of

# Accepted input layouts, day first, each with the shape test
# that selects it.
DATE_FORMATS = (
    (r"^\d{1,2}/\d{1,2}/\d{4}$", "d/M/yyyy"),
    (r"^\d{4}-\d{1,2}-\d{1,2}", "yyyy-M-d"),
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
)


def parse_date(c, formats=DATE_FORMATS) -> Column:
    """Day-first date parse over several layouts; unparseable -> null.

    A regex picks the layout so that only one parse is attempted per row
    (a failed ``try_to_date`` costs an exception inside the JVM).
    """
    s = F.trim(col_of(c).cast("string"))
    out = None
    for shape, fmt in formats:
        if fmt.startswith("yyyy"):
            parsed = F.try_to_date(F.substring(s, 1, 10), fmt)
        else:
            parsed = F.try_to_date(s, fmt)
        out = F.when(s.rlike(shape), parsed) if out is None else out.when(s.rlike(shape), parsed)
    return out


def utc_date(ts) -> Column:
    """Calendar date of a wall-clock (TIMESTAMP_NTZ) timestamp; independent of
    the session time zone."""
    return F.to_date(col_of(ts))


def iso_week(c) -> Column:
    """ISO week number (2027-01-01 is week 53)."""
    return F.weekofyear(col_of(c))


def iso_year(c) -> Column:
    """The ISO week-numbering year, to key weeks across years."""
    return F.extract(F.lit("YEAROFWEEK"), col_of(c))


def weekday0(c) -> Column:
    """Day of week with Monday = 0."""
    return F.weekday(col_of(c))


def inclusive_days(start, end) -> Column:
    """Inclusive span in days, (end - start) + 1."""
    return F.datediff(col_of(end), col_of(start)) + 1
