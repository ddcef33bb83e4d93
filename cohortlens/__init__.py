"""cohortlens: set-based Spark analytics for training-cohort data.

Layers
------
functions/  column expressions for cleaning and formatting (no UDFs)
sources/    bronze readers, role bindings of the shared parquet tables, sinks
operators/  reusable relational building blocks (distributed rank, exact
            quantile, spines, explicit pivots, gaps-and-islands, ...)
plans/      the analytics themselves, each a lazy DataFrame for all
            interns / mentors / courses at once
streaming/  incremental landing of new files with Structured Streaming
"""

from cohortlens.session import get_session, checkpoint_dir  # noqa: F401

__version__ = "0.1.0"
