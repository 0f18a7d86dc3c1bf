"""Readers and writers: given tables, the Parquet lake, catalog snapshots, the topic."""

from .catalogs import CATALOG_SCHEMAS, read_snapshots, write_snapshot, write_snapshots
from .lake import LAKE_SCHEMA, RAW_EVENTS_SCHEMA, read_lake
from .tables import TABLES, read_table
from .topic import publish_frame, read_topic, topic_options

__all__ = [
    "CATALOG_SCHEMAS",
    "LAKE_SCHEMA",
    "RAW_EVENTS_SCHEMA",
    "TABLES",
    "publish_frame",
    "read_lake",
    "read_snapshots",
    "read_table",
    "read_topic",
    "topic_options",
    "write_snapshot",
    "write_snapshots",
]
