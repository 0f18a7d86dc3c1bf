"""The lake profile kept up to date: only hours whose files changed are read.

Row counts are kept per hour and event type, and replaced as a whole for an
hour that changed; the distinct event ids lie in a bucketed table, into which
the ids of changed hours are merged (a lake is only added to, so an id never
leaves). The sums over both are the profile of the whole lake (A1-A3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.lake import LAKE_PARTITIONS
from ..storage import Folders
from .compact import HOURS, changed_hours, hour_signatures, rows_of_hours
from .keyed import BUCKETS, KeyedTable

IDS_SCHEMA = T.StructType([T.StructField("event_id", T.StringType())])
_COUNTS = "ingest_date string, ingest_hour string, event_type string, n_rows long, n_ids long"


class LakeProfile:
    """The profile of the lake under ``lake_root``, as of the last refresh."""

    def __init__(self, spark: SparkSession, lake_root: str, state_root: str, buckets: int = BUCKETS) -> None:
        self.spark, self.lake, self.root = spark, lake_root, state_root.rstrip("/")
        self.folders = Folders(spark)
        self.ids = KeyedTable(spark, f"{self.root}/ids", IDS_SCHEMA, "event_id", [F.col("event_id")], buckets)

    def _state(self) -> int:
        found = [int(n.partition("=")[2]) for n in self.folders.names(f"{self.root}/hours") if n.startswith("state=")]
        return max((n for n in found if self.folders.exists(f"{self.root}/hours/state={n}/_SUCCESS")), default=0)

    def _read(self, name: str, schema: str) -> DataFrame:
        state = self._state()
        return self.spark.read.schema(schema).parquet(f"{self.root}/{name}/state={state}") if state else self.spark.createDataFrame([], schema)

    def refresh(self) -> int:
        """Take in what was added to the lake; the number of hours read. The
        listing is noted last, so a refresh that broke off is done again, and
        merging ids again changes nothing."""
        listing = hour_signatures(self.spark, self.lake).persist()
        try:
            hours = changed_hours(listing, self._read("hours", HOURS))
            if not hours:
                return 0
            rows, state = rows_of_hours(self.spark, self.lake, hours), self._state()
            new = rows.groupBy(*LAKE_PARTITIONS, "event_type").agg(F.count(F.lit(1)).alias("n_rows"), F.count("event_id").alias("n_ids"))
            read = self.spark.createDataFrame([(h[0], h[1]) for h in hours], "ingest_date string, ingest_hour string")
            kept = self._read("counts", _COUNTS).join(read, list(LAKE_PARTITIONS), "left_anti")
            kept.unionByName(new).write.mode("overwrite").parquet(f"{self.root}/counts/state={state + 1}")
            self.ids.merge(rows.select("event_id"))
            listing.write.mode("overwrite").parquet(f"{self.root}/hours/state={state + 1}")
            for name in ("counts", "hours"):
                self.folders.remove(f"{self.root}/{name}/state={state - 1}")
            return len(hours)
        finally:
            listing.unpersist()

    def summary(self) -> DataFrame:
        """``total_rows, distinct_event_ids, duplicate_rows`` (a missing id
        counts as one id)."""
        total = self._read("counts", _COUNTS).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total_rows"))
        distinct = self.ids.read().agg(F.count(F.lit(1)).alias("distinct_event_ids"))
        both = total.join(F.broadcast(distinct))  # one row each
        return both.select("total_rows", "distinct_event_ids", (F.col("total_rows") - F.col("distinct_event_ids")).alias("duplicate_rows"))

    def per_type(self) -> DataFrame:
        """``event_type, n_events``: events with an id."""
        return self._read("counts", _COUNTS).groupBy("event_type").agg(F.sum("n_ids").alias("n_events"))
