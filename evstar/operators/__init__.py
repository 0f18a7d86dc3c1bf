"""DataFrame-level operators."""

from .dedup import first_delivery, keep_first, latest_version, merge_latest
from .joins import lookup, missing_parents
from .partitioning import ensure_parallelism
from .profiling import (
    key_affinity,
    key_summary,
    lake_files,
    lake_summary,
    latest_files,
    partition_counts,
    rows_per_file,
    rows_per_type,
    schema_report,
)
from .routing import accepted, parse_messages, quarantined, stamp
from .quality import (
    Violations,
    accepted_range,
    accepted_values,
    not_null,
    relationships,
    singular,
    total_mismatch,
    unique,
)

__all__ = [
    "Violations",
    "accepted",
    "parse_messages",
    "quarantined",
    "stamp",
    "accepted_range",
    "accepted_values",
    "ensure_parallelism",
    "first_delivery",
    "keep_first",
    "key_affinity",
    "key_summary",
    "lake_files",
    "lake_summary",
    "latest_files",
    "latest_version",
    "lookup",
    "merge_latest",
    "missing_parents",
    "not_null",
    "partition_counts",
    "relationships",
    "rows_per_file",
    "rows_per_type",
    "schema_report",
    "singular",
    "total_mismatch",
    "unique",
]
