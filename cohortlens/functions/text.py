"""String cleaning expressions (names, labels, lookups)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.functions.common import col_of


def title_case(c) -> Column:
    """Capitalise the first letter after any non-letter, lower the rest.

    ``initcap`` only capitalises after whitespace ("Mary-jane O'neil");
    the source data expects "Mary-Jane O'Neil" and "3Rd". Splitting into
    runs of letters / non-letters and capitalising each run gives that
    without a UDF.
    """
    c = col_of(c)
    runs = F.regexp_extract_all(F.lower(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.initcap(x)), "")


def clean_name(c) -> Column:
    """Trim and title-case a person name; null stays null (never 'Nan')."""
    c = F.trim(col_of(c))
    return F.when(c == "", F.lit(None).cast("string")).otherwise(title_case(c))


def full_name(first, last) -> Column:
    """C04: 'First Last' from two columns; null only when both parts are null."""
    f, l_ = F.trim(col_of(first)), F.trim(col_of(last))
    joined = F.concat_ws(" ", f, l_)
    return F.when(f.isNull() & l_.isNull(), F.lit(None).cast("string")).otherwise(title_case(joined))


def first_token(c) -> Column:
    """First whitespace-separated word."""
    return F.split_part(F.trim(col_of(c)), F.lit(" "), F.lit(1))


def initials(c, n: int = 2) -> Column:
    """Upper-case initials of the first ``n`` words."""
    words = F.split(F.trim(col_of(c)), r"\s+")
    return F.array_join(F.transform(F.slice(words, 1, n), lambda w: F.upper(F.left(w, F.lit(1)))), "")


def lookup(c, mapping: dict, default=None) -> Column:
    """Dictionary lookup with a fallback (the key itself when ``default`` is None)."""
    c = col_of(c)
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    return F.coalesce(F.try_element_at(m, c), c if default is None else F.lit(default))


def mentor_list(c, sep: str = ", ") -> Column:
    """Comma-separated mentor string -> distinct array of trimmed names."""
    parts = F.split(col_of(c), sep)
    return F.array_distinct(F.filter(F.transform(parts, lambda x: F.trim(x)), lambda x: x != ""))


def short_label(c, n: int = 18) -> Column:
    """Prefix of ``n`` characters."""
    return F.substring(col_of(c), 1, n)


def contains_regex(c, pattern: str) -> Column:
    """Unanchored regex match, null -> false."""
    return F.coalesce(col_of(c).rlike(pattern), F.lit(False))
