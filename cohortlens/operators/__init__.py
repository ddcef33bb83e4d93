"""Reusable relational operators."""

from cohortlens.operators.materialize import materialize  # noqa: F401
from cohortlens.operators.ranking import approx_quantiles, exact_median, exact_quantiles, rank_rows  # noqa: F401
from cohortlens.operators.relational import (  # noqa: F401
    islands, keep_last, null_safe_join, scoped_view, share_of_total)
