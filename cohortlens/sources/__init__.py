"""Sources and sinks."""

from cohortlens.sources.bindings import Gold, gold  # noqa: F401
from cohortlens.sources.tables import read_table  # noqa: F401
