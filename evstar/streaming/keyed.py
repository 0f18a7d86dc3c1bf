"""A keyed table in hash buckets whose merges rewrite only the buckets that
new rows fall into.

``{root}/data/version=V/bucket=B`` holds bucket ``B`` as of version ``V``;
``{root}/states/state=V`` names, for every bucket, the version that holds it.
A version counts once its state is written whole. Readers follow the last
state, so they see whole versions only, and a merge that broke off leaves
folders that nothing names. What a merge reads and writes follows the buckets
it touches, not the table. States before the last few are removed, with the
buckets that only they name.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import keep_first
from ..storage import Folders

BUCKETS = 64
#: States that stay, for readers that began on an older one.
KEPT_STATES = 4
BUCKET = "bucket"
_STATE = "bucket int, version int, buckets int"
_DONE = "_SUCCESS"


class KeyedTable:
    """Rows of ``schema``, one per ``key`` (a null key is a key): the first by
    ``order``. ``buckets`` counts when the table is made; later merges keep
    to the number it was made with."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        schema: T.StructType,
        key: str,
        order: Sequence[Column] = (),
        buckets: int = BUCKETS,
        keep: int = KEPT_STATES,
    ) -> None:
        self.spark, self.root, self.schema, self.key = spark, root.rstrip("/"), schema, key
        self.order, self.keep, self.folders = list(order), keep, Folders(spark)
        rows = self._state(self.version())
        self.buckets = rows[0]["buckets"] if rows else buckets

    def _states(self) -> list[int]:
        found = [int(n.partition("=")[2]) for n in self.folders.names(f"{self.root}/states") if n.startswith("state=")]
        return sorted(v for v in found if self.folders.exists(f"{self.root}/states/state={v}/{_DONE}"))

    def _state(self, version: int) -> list:
        if not version:
            return []
        return self.spark.read.schema(_STATE).parquet(f"{self.root}/states/state={version}").collect()  # a row per bucket

    def version(self) -> int:
        """The last version that counts, 0 before the first."""
        return max(self._states(), default=0)

    def current(self) -> dict[int, int]:
        """The version that holds each bucket that has rows."""
        return {r["bucket"]: r["version"] for r in self._state(self.version())}

    def with_bucket(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn(BUCKET, F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int"))

    def _data(self, version: int, bucket: int | None = None) -> str:
        return f"{self.root}/data/version={version}" + ("" if bucket is None else f"/{BUCKET}={bucket}")

    def read(self, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows, with their bucket; of some buckets only, no other is opened."""
        schema = T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])
        wanted = None if buckets is None else set(buckets)
        paths = [self._data(v, b) for b, v in sorted(self.current().items()) if wanted is None or b in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/data").parquet(*paths)
        return rows.select(*schema.fieldNames())

    def rewrite(self, rows: DataFrame, buckets: Sequence[int]) -> int:
        """Make ``rows`` (with their bucket) the whole content of ``buckets``;
        the version they are in."""
        last = self.version()
        if not buckets:
            return last
        version = last + 1
        parts = min(len(buckets), int(self.spark.conf.get("spark.sql.shuffle.partitions")))
        own = rows.select(*self.schema.fieldNames(), BUCKET).repartition(parts, BUCKET)
        own.write.mode("overwrite").partitionBy(BUCKET).parquet(self._data(version))
        self._count(version, buckets)
        return version

    def _count(self, version: int, buckets: Sequence[int]) -> None:
        now = self.current()
        for b in buckets:
            now.pop(b, None)
            if self.folders.exists(self._data(version, b)):
                now[b] = version
        entries = [(b, v, self.buckets) for b, v in sorted(now.items())]
        state = self.spark.createDataFrame(entries, _STATE).coalesce(1)
        state.write.mode("overwrite").parquet(f"{self.root}/states/state={version}")
        self.prune(self.keep)

    def merge(self, rows: DataFrame) -> int:
        """Merge ``rows``; the version they are in. Merging rows again changes
        nothing, so a replayed batch is harmless."""
        new = self.with_bucket(keep_first(rows.select(*self.schema.fieldNames()), [self.key], self.order))
        new = new.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            touched = sorted(r[BUCKET] for r in new.select(BUCKET).distinct().collect())
            both = self.read(touched).unionByName(new)
            if not touched:
                return self.version()
            # one exchange: rows of a key are in one bucket, so in one task
            parts = min(len(touched), int(self.spark.conf.get("spark.sql.shuffle.partitions")))
            kept = keep_first(both.repartition(parts, BUCKET), [BUCKET, self.key], self.order)
            version = self.version() + 1
            kept.write.mode("overwrite").partitionBy(BUCKET).parquet(self._data(version))
            self._count(version, touched)
            return version
        finally:
            new.unpersist()

    def touched_since(self, version: int) -> list[int]:
        """Buckets rewritten after ``version``."""
        return sorted(b for b, v in self.current().items() if v > version)

    def prune(self, keep: int) -> None:
        """Remove all states but the last ``keep``, and the buckets that only
        removed ones name."""
        states = self._states()
        if len(states) <= keep:
            return
        named = [{(r["version"], r["bucket"]) for r in self._state(v)} for v in states]
        for version, bucket in set().union(*named[:-keep]) - set().union(*named[-keep:]):
            self.folders.remove(self._data(version, bucket))
        for v in states[:-keep]:
            self.folders.remove(f"{self.root}/states/state={v}")


__all__ = ["BUCKET", "BUCKETS", "KeyedTable"]
