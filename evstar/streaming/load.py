"""Incremental load of new lake files into the raw events table (M9: S8, S10, F7, K12).

A file-source stream over the lake: the checkpoint's file log remembers
every file already loaded, so each file is loaded exactly once and a second
run with no new file appends nothing. A file counts as new by its path
alone, however old its time stamp is. ``parse_json`` raises on bad payload
text, which fails the batch before any output is committed (abort on
error). ``trigger(availableNow=True)`` drains what is there and stops.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.lake import LAKE_SCHEMA
from .progress import RowCounter

#: File sources pass over files this much older than the newest one they have
#: seen; their default is a week, and a lake may get older files later.
MAX_FILE_AGE = "36500d"


def load_projection(lake_rows: DataFrame, source_file: Column | None = None) -> DataFrame:
    """Typed raw-table row from a lake row (F7): timestamps parsed, payload
    as VARIANT, lineage column ``source_file`` (S10)."""
    if source_file is None:
        source_file = F.col("_metadata.file_path")
    return lake_rows.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("event_type").cast("string").alias("event_type"),
        F.col("event_timestamp").cast("timestamp").alias("event_timestamp"),
        F.parse_json(F.col("payload")).alias("payload"),
        F.col("kafka_partition").cast("int").alias("kafka_partition"),
        F.col("kafka_offset").cast("long").alias("kafka_offset"),
        F.col("ingested_at").cast("timestamp").alias("ingested_at"),
        source_file.cast("string").alias("source_file"),
    )


def load_raw(
    spark: SparkSession,
    lake_root: str,
    table_root: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    loaded_at: bool = False,
) -> int:
    """Append lake files not loaded before into ``table_root`` (Parquet).

    Returns the number of rows appended by this run, over all its batches.
    ``loaded_at=True`` adds a load-time column (K12).
    """
    reader = spark.readStream.schema(LAKE_SCHEMA).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = load_projection(reader.parquet(lake_root))
    if loaded_at:
        rows = rows.withColumn("loaded_at", F.localtimestamp())
    counter = RowCounter()
    spark.streams.addListener(counter)
    try:
        query = (
            rows.writeStream.format("parquet")
            .option("path", table_root)
            .option("checkpointLocation", checkpoint)
            .outputMode("append")
            .trigger(availableNow=True)
            .start()
        )
        return counter.drained(query)
    finally:
        spark.streams.removeListener(counter)


def read_raw_events(spark: SparkSession, table_root: str) -> DataFrame:
    """The raw table. Reading through the sink's metadata log, only files of
    committed batches are visible."""
    return spark.read.parquet(table_root)
