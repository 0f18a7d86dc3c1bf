"""Merging the small files of the lake.

Files below half the wanted size are packed, hour by hour in listing order,
into bins of that size, and each bin with two files or more becomes one file.
A run writes its plan, then the merged files beside the lake, moves these in,
removes the files they replace, and notes that it is done. Until then readers
may see a row twice, never not at all; the load takes every offset once
(:mod:`evstar.streaming.ledger`). A run that broke off is finished, or
dropped where its files are not whole, by the next one.

File names stay in tables: moves and removals run in tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..sources.lake import LAKE_PARTITIONS, LAKE_SCHEMA
from ..storage import Folders

TARGET_BYTES = 128 << 20
_LISTING = "path string, length long, ingest_date string, ingest_hour string"


def lake_files(spark: SparkSession, root: str) -> DataFrame:
    """``path, length, ingest_date, ingest_hour`` of the files under a lake
    folder, from the listing alone."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(root)
    except AnalysisException:  # no such folder yet
        return spark.createDataFrame([], _LISTING)
    hour = [F.regexp_extract("path", rf"/{c}=([^/]+)/", 1).alias(c) for c in LAKE_PARTITIONS]
    return files.select("path", "length", *hour)


HOURS = "ingest_date string, ingest_hour string, signature string"


def hour_signatures(spark: SparkSession, root: str) -> DataFrame:
    """Each hour of a lake with a signature of its files' names and sizes,
    from the listing alone."""
    one = F.xxhash64("path", "length")
    by_hour = lake_files(spark, root).groupBy(*LAKE_PARTITIONS).agg(
        F.count(F.lit(1)).alias("n"), F.bit_xor(one).alias("x"), F.sum(F.pmod(one, F.lit(1 << 31))).alias("s")
    )
    return by_hour.select(*LAKE_PARTITIONS, F.concat_ws(":", "n", "x", "s").alias("signature"))


def changed_hours(listing: DataFrame, seen: DataFrame) -> list:
    """Hours of ``listing`` whose signature is not the one ``seen`` (at most
    the hours of the lake)."""
    return listing.join(seen, [*LAKE_PARTITIONS, "signature"], "left_anti").select(*LAKE_PARTITIONS).collect()


def rows_of_hours(spark: SparkSession, root: str, hours: list) -> DataFrame:
    """The lake's rows of some hours; no other folder is opened."""
    by_day: dict[str, list[str]] = {}
    for h in hours:
        by_day.setdefault(h["ingest_date"], []).append(h["ingest_hour"])
    wanted: Column = F.lit(False)
    for day, of_day in sorted(by_day.items()):
        wanted = wanted | ((F.col("ingest_date") == day) & F.col("ingest_hour").isin(of_day))
    return spark.read.schema(LAKE_SCHEMA).parquet(root).filter(wanted)


def packed(files: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """``path, ingest_date, ingest_hour, bin`` of the files to merge. A bin
    holds files of one hour, of up to the wanted size together and one more."""
    small = files.filter(F.col("length") * 2 < target_bytes)
    in_order = Window.partitionBy(*LAKE_PARTITIONS).orderBy("path")
    before = F.coalesce(F.sum("length").over(in_order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = small.withColumn("n", F.floor(before / target_bytes))
    together = Window.partitionBy(*LAKE_PARTITIONS, "n")
    merged = numbered.withColumn("files", F.count(F.lit(1)).over(together)).filter("files > 1")
    return merged.select("path", *LAKE_PARTITIONS, F.concat_ws("/", *LAKE_PARTITIONS, "n").alias("bin"))


def open_place(uri: str) -> tuple[fs.FileSystem, str]:
    """The storage that holds a file or folder, and its path there."""
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[len("file:") :]
    return fs.FileSystem.from_uri(uri)


def _each(paths: DataFrame, act: Callable[[fs.FileSystem, str], None]) -> int:
    """Act on every file of ``paths`` (one string column) that is still
    there, in tasks; how many there were."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for batch in batches:
            for uri in batch.column(0).to_pylist():
                store, path = open_place(uri)
                if store.get_file_info(path).type == fs.FileType.File:
                    act(store, path)
                    done += 1
        yield pa.record_batch([pa.array([done], pa.int64())], names=["done"])

    return paths.mapInArrow(run, "done long").agg(F.sum("done")).first()[0] or 0


def _finish(spark: SparkSession, lake: str, run: str) -> tuple[int, int]:
    """Move a run's files in and remove the ones they replace; both numbers."""

    def move(store: fs.FileSystem, path: str) -> None:
        day, hour, name = path.split("/")[-3:]
        target = f"{open_place(lake)[1].rstrip('/')}/{day}/{hour}/{name}"
        store.move(path, target)

    def remove(store: fs.FileSystem, path: str) -> None:
        store.delete_file(path)

    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    moved = _each(lake_files(spark, f"{run}/files").select("path").repartition(spread, "path"), move)
    plan = spark.read.schema("path string").parquet(f"{run}/plan")
    removed = _each(plan.repartition(spread, "path"), remove)
    spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{run}/done")
    return removed, moved


def compact_lake(
    spark: SparkSession, lake: str, journal: str, target_bytes: int = TARGET_BYTES, before: tuple[str, str] | None = None
) -> tuple[int, int]:
    """Merge small files; ``(files removed, files added)``. With ``before`` (a
    day and an hour) only hours before that, so that the hour being written
    is left alone."""
    folders = Folders(spark)
    runs = sorted(int(n.partition("=")[2]) for n in folders.names(journal) if n.startswith("run="))
    for n in runs:
        run = f"{journal}/run={n}"
        if not folders.exists(f"{run}/done/_SUCCESS"):
            if folders.exists(f"{run}/files/_SUCCESS"):
                _finish(spark, lake, run)
            else:
                folders.remove(run)
    for n in runs[:-1]:
        folders.remove(f"{journal}/run={n}")
    run = f"{journal}/run={max(runs, default=0) + 1}"
    files = lake_files(spark, lake)
    if before:
        files = files.filter(F.concat_ws("/", *LAKE_PARTITIONS) < "/".join(before))
    packed(files, target_bytes).write.parquet(f"{run}/plan")
    plan = spark.read.parquet(f"{run}/plan")
    bins = plan.agg(F.count_distinct("bin")).first()[0]
    if not bins:
        folders.remove(run)
        return 0, 0
    hours = plan.select(*LAKE_PARTITIONS).distinct().collect()  # at most the hours of the lake
    days, of_day = sorted({h[0] for h in hours}), sorted({h[1] for h in hours})
    rows = spark.read.schema(LAKE_SCHEMA).parquet(lake).filter(F.col("ingest_date").isin(days) & F.col("ingest_hour").isin(of_day))
    rows = rows.select("*", F.col("_metadata.file_path").alias("of_file"))
    of = plan.select(F.col("path").alias("plan_path"), "bin")
    # both name a file in the same way up to the slashes after the scheme
    same = F.regexp_replace("of_file", "^file:/+", "/") == F.regexp_replace("plan_path", "^file:/+", "/")
    merged = rows.join(of, same).repartitionByRange(bins, "bin").drop("of_file", "plan_path", "bin")
    merged.write.partitionBy(*LAKE_PARTITIONS).parquet(f"{run}/files")
    return _finish(spark, lake, run)
