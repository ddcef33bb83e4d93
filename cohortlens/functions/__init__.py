"""Column expressions used across the library (all JVM-side built-ins)."""

from cohortlens.functions.common import col_of  # noqa: F401
from cohortlens.functions.dates import (  # noqa: F401
    inclusive_days, iso_week, iso_year, parse_date, utc_date, weekday0)
from cohortlens.functions.fmt import (  # noqa: F401
    dash_if_nonpositive, fmt_hours, fmt_num, fmt_pct0, fmt_rank, fmt_ratio, fmt_score,
    progress_band, risk_level, signed_delta)
from cohortlens.functions.numeric import (  # noqa: F401
    at_least_one, clip, exact_sum, fraction_part, parse_percent, pct,
    round_half_even, to_double, zero_to_one)
from cohortlens.functions.text import (  # noqa: F401
    clean_name, contains_regex, first_token, full_name, initials, lookup,
    mentor_list, short_label, title_case)
