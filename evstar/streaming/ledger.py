"""Loading by offsets: what is in the raw table is known as intervals of
topic offsets, so lake files may be merged, copied or delivered late.

- An interval set ``(kafka_partition, first_offset, last_offset)`` holds what
  was loaded: gaps and islands over offsets, first within runs of
  ``CHUNK`` offsets (so that no window spans a whole topic partition), then
  over the few intervals that reach its border.
- A load looks at the hours of the lake whose listing changed, reads the two
  offset columns there, and takes the rows that no interval covers: an
  anti-join on (partition, chunk) with the interval as a condition.
- Load ``N`` writes its intervals, its rows, and last the hours' signatures,
  which make it count; readers of the raw table see the loads that count, and
  one that broke off is done again under its number.

The driver holds one signature per hour and no file name or interval.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import keep_first
from ..sources.lake import RAW_EVENTS_SCHEMA
from ..storage import Folders
from .compact import HOURS, changed_hours, hour_signatures, rows_of_hours
from .load import load_projection

#: Offsets of one topic partition that are handled together.
CHUNK = 1 << 20
OFFSET = ["kafka_partition", "kafka_offset"]
INTERVALS = "kafka_partition int, first_offset long, last_offset long"
#: Loads whose intervals stay apart before they are merged into one set.
LOADS_PER_SET = 16


def offset_intervals(offsets: DataFrame) -> DataFrame:
    """``kafka_partition, first_offset, last_offset`` of the runs of
    consecutive offsets; repeats count once."""
    one = F.col("kafka_offset")
    return merged_intervals(offsets.select(*OFFSET).distinct().select("kafka_partition", one.alias("first_offset"), one.alias("last_offset")))


def _joined(intervals: DataFrame, *of: str) -> DataFrame:
    """Intervals that touch or overlap, joined within ``of``."""
    by_start = Window.partitionBy(*of).orderBy("first_offset", "last_offset")
    so_far = F.max("last_offset").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.coalesce((F.col("first_offset") > so_far + 1).cast("long"), F.lit(1))
    numbered = intervals.select(*of, "first_offset", "last_offset", starts.alias("starts"))
    island = F.sum("starts").over(by_start.rowsBetween(Window.unboundedPreceding, 0))
    ends = (F.min("first_offset").alias("first_offset"), F.max("last_offset").alias("last_offset"))
    return numbered.withColumn("island", island).groupBy(*of, "island").agg(*ends).drop("island")


def merged_intervals(intervals: DataFrame) -> DataFrame:
    """The same offsets in as few intervals as possible: joined within each
    chunk first; then those that reach a chunk's border, at most two a chunk,
    over the whole topic partition."""
    chunks = F.sequence(F.expr(f"first_offset div {CHUNK}"), F.expr(f"last_offset div {CHUNK}"))
    cut = intervals.select("kafka_partition", "first_offset", "last_offset", F.explode(chunks).alias("chunk")).select(
        "kafka_partition",
        "chunk",
        F.greatest("first_offset", F.col("chunk") * CHUNK).alias("first_offset"),
        F.least("last_offset", (F.col("chunk") + 1) * CHUNK - 1).alias("last_offset"),
    )
    within = _joined(cut, "kafka_partition", "chunk").withColumn(
        "border", (F.col("first_offset") % CHUNK == 0) | (F.col("last_offset") % CHUNK == CHUNK - 1)
    )
    inner = within.filter("not border").select("kafka_partition", "first_offset", "last_offset")
    return inner.unionByName(_joined(within.filter("border"), "kafka_partition"))


def _words(intervals: DataFrame) -> DataFrame:
    """``of_partition, word, bits``: every stretch of 64 offsets that an
    interval reaches, once, with a bit for each offset that one covers."""
    words = F.sequence(F.shiftright("first_offset", 6), F.shiftright("last_offset", 6))
    cut = intervals.select("kafka_partition", "first_offset", "last_offset", F.explode(words).alias("word"))
    first = F.greatest(F.col("first_offset") - F.col("word") * 64, F.lit(0)).cast("int")
    last = F.least(F.col("last_offset") - F.col("word") * 64, F.lit(63)).cast("int")
    every = F.lit(-1).cast("long")
    from_first, to_last = F.call_function("shiftleft", every, first), F.call_function("shiftrightunsigned", every, 63 - last)
    bits = F.bit_or(from_first.bitwiseAND(to_last))
    return cut.groupBy(F.col("kafka_partition").alias("of_partition"), "word").agg(bits.alias("bits"))


def not_covered(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    """The rows whose offset is in no interval. A row meets one word at most,
    however many intervals there are; only chunks with rows are cut into words."""
    chunks = F.sequence(F.expr(f"first_offset div {CHUNK}"), F.expr(f"last_offset div {CHUNK}"))
    held = intervals.select("kafka_partition", "first_offset", "last_offset", F.explode(chunks).alias("chunk"))
    wanted = rows.select("kafka_partition", F.expr(f"kafka_offset div {CHUNK}").alias("chunk")).distinct()
    cut = held.join(wanted, ["kafka_partition", "chunk"], "left_semi").select(
        "kafka_partition",
        F.greatest("first_offset", F.col("chunk") * CHUNK).alias("first_offset"),
        F.least("last_offset", (F.col("chunk") + 1) * CHUNK - 1).alias("last_offset"),
    )
    same = (F.col("kafka_partition") == F.col("of_partition")) & (F.shiftright("kafka_offset", 6) == F.col("word"))
    covered = F.getbit("bits", F.pmod("kafka_offset", F.lit(64)).cast("int")) == 1
    return rows.join(_words(cut), same & covered, "left_anti")


class Ledger:
    """What the raw table under ``table_root`` holds of the lake."""

    def __init__(self, spark: SparkSession, lake_root: str, table_root: str, ledger_root: str) -> None:
        self.spark, self.lake, self.table, self.root = spark, lake_root, table_root.rstrip("/"), ledger_root.rstrip("/")
        self.folders = Folders(spark)

    def _numbers(self, name: str) -> list[int]:
        found = [int(n.partition("=")[2]) for n in self.folders.names(f"{self.root}/{name}") if n.startswith("load=")]
        return sorted(n for n in found if self.folders.exists(f"{self.root}/{name}/load={n}/_SUCCESS"))

    def last_load(self) -> int:
        """The last load that counts; all before it do. 0 before the first."""
        return max(self._numbers("hours"), default=0)

    def intervals(self) -> DataFrame:
        """What is loaded: the last merged set and the loads since. An
        interval may be in both for a moment, never in neither."""
        last = self.last_load()
        paths = [f"{self.root}/intervals/load={n}" for n in self._numbers("intervals") if n <= last]
        paths += [f"{self.root}/sets/load={n}" for n in self._numbers("sets")[-1:]]
        return self.spark.read.schema(INTERVALS).parquet(*paths) if paths else self.spark.createDataFrame([], INTERVALS)

    def _seen(self) -> DataFrame:
        """The listing that the last load saw."""
        last = self.last_load()
        return self.spark.read.schema(HOURS).parquet(f"{self.root}/hours/load={last}") if last else self.spark.createDataFrame([], HOURS)

    def load(self) -> int:
        """Load the lake rows whose offsets are not loaded; how many. Every
        offset comes once: of copies (a batch the ingest wrote twice) the
        earliest. A row without partition or offset stops the load."""
        listing = hour_signatures(self.spark, self.lake).persist()
        try:
            hours = changed_hours(listing, self._seen())
            if not hours:
                return 0
            number = self.last_load() + 1
            rows, held = rows_of_hours(self.spark, self.lake, hours), self.intervals()
            rows = rows.select("*", F.col("_metadata.file_path").alias("lake_file"))
            nameless = F.col("kafka_partition").isNull() | F.col("kafka_offset").isNull()
            stop = F.when(nameless, F.raise_error(F.lit("lake row without topic offset"))).otherwise(F.lit(True))
            target = f"{self.root}/intervals/load={number}"
            offset_intervals(not_covered(rows.filter(stop).select(*OFFSET), held)).write.mode("overwrite").parquet(target)
            span = F.sum(F.col("last_offset") - F.col("first_offset") + 1)
            wanted = self.spark.read.schema(INTERVALS).parquet(target).agg(span).first()[0] or 0
            if wanted:
                fresh = not_covered(rows, held)
                if fresh.count() > wanted:  # some offsets come more than once
                    fresh = keep_first(fresh, OFFSET, [F.col("ingested_at").asc_nulls_last(), F.col("lake_file")])
                load_projection(fresh, F.col("lake_file")).write.mode("overwrite").parquet(f"{self.table}/load={number}")
            listing.write.mode("overwrite").parquet(f"{self.root}/hours/load={number}")
            self._fold(number)
            return wanted
        finally:
            listing.unpersist()

    def _fold(self, number: int) -> None:
        """Merge the intervals of many loads into one set, and drop what
        nothing reads any more."""
        apart = self._numbers("intervals")
        if len(apart) >= LOADS_PER_SET:
            merged_intervals(self.intervals()).write.mode("overwrite").parquet(f"{self.root}/sets/load={number}")
            for n in apart:
                self.folders.remove(f"{self.root}/intervals/load={n}")
        for name in ("hours", "sets"):
            for n in self._numbers(name)[:-2]:
                self.folders.remove(f"{self.root}/{name}/load={n}")

    def read(self) -> DataFrame:
        """The raw table, with the number of the load that brought a row."""
        schema = T.StructType([*RAW_EVENTS_SCHEMA.fields, T.StructField("load", T.IntegerType())])
        last = self.last_load()
        if not last or not self.folders.exists(self.table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.table).filter(F.col("load") <= last)  # prunes folders
