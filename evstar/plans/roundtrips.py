"""Write-then-read jobs: run the streaming ingest, the incremental raw load,
the catalog snapshot writer, the per-type channel, the incremental staging
and the whole pipeline against fresh folders, and return what a reader sees
afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import profiling
from ..sources import testdata as td
from ..sources.catalogs import read_snapshots, write_snapshot, write_snapshots
from ..sources.lake import read_dead_letters, read_lake
from ..streaming.ingest import ingest
from ..streaming.buffers import ROCKSDB, drain_buffers
from ..streaming.compact import compact_lake, lake_files
from ..streaming.ledger import Ledger
from ..streaming.legacy import (
    LEGACY_TABLES,
    RAW_JSON,
    TYPE_PARTITION,
    legacy_ingest,
    legacy_ingest_buffered,
    legacy_load,
    read_legacy_table,
)
from ..streaming.load import MAX_FILE_AGE, load_projection, load_raw
from ..streaming.profile_state import LakeProfile
from ..streaming.stage import stage_orders
from . import staging
from .catalog_state import refresh_latest
from .fact_state import read_fact, refresh_fact
from .pipeline import Layout, run_pipeline


#: Micro-batches the staging job's raw files are staged in.
STAGED_BATCHES = 3
#: Messages of a file of the landed topic, and files of one micro-batch: they
#: bound what a batch holds, however long the backlog is.
MESSAGES_PER_FILE = 100_000
FILES_PER_BATCH = 256
#: Micro-batches that the ledger job's messages come in, so that the lake has
#: small files to merge.
LEDGER_BATCHES = 3
#: Age limit of a buffer in the per-type job.
BUFFER_AGE_MS = 1000
_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def _land_topic(messages: DataFrame, root: str) -> str:
    """Store messages as a broker log stand-in; every input task writes its
    own files."""
    path = f"{root}/topic"
    messages.write.option("maxRecordsPerFile", MESSAGES_PER_FILE).parquet(path)
    return path


def _topic_stream(spark: SparkSession, messages: DataFrame, root: str, files_per_batch: int = FILES_PER_BATCH) -> DataFrame:
    """The landed messages as a stream of bounded micro-batches."""
    topic = _land_topic(messages, root)
    reader = spark.readStream.schema(messages.schema).option("maxFileAge", MAX_FILE_AGE)
    return reader.option("maxFilesPerTrigger", files_per_batch).parquet(topic)


def run_ingest(spark: SparkSession, messages: DataFrame, root: str, files_per_batch: int = FILES_PER_BATCH) -> tuple[str, str]:
    """Drain the landed topic through the streaming ingest in bounded
    micro-batches; returns the lake and dead-letter folders."""
    stream = _topic_stream(spark, messages, root, files_per_batch)
    lake, dead = f"{root}/lake", f"{root}/dead_letter"
    query = ingest(stream, lake, dead, f"{root}/_checkpoints/ingest", available_now=True)
    query.awaitTermination()
    return lake, dead


def ingest_roundtrip(spark: SparkSession, messages: DataFrame, root: str) -> DataFrame:
    """Lake rows and dead letters after ingest, one row per message."""
    lake, dead = run_ingest(spark, messages, root)
    good = read_lake(spark, lake).select(
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.lit("accepted").alias("status"),
        F.lit(None).cast("string").alias("error"),
        "event_id",
        "event_type",
        "event_timestamp",
        "payload",
        F.lit(None).cast("string").alias("raw_value"),
    )
    bad = read_dead_letters(spark, dead).select(
        "partition",
        "offset",
        F.lit("quarantined").alias("status"),
        "error",
        F.lit(None).cast("string").alias("event_id"),
        F.lit(None).cast("string").alias("event_type"),
        F.lit(None).cast("string").alias("event_timestamp"),
        F.lit(None).cast("string").alias("payload"),
        "raw_value",
    )
    return good.unionByName(bad)


def raw_load_roundtrip(spark: SparkSession, messages: DataFrame, root: str) -> DataFrame:
    """Raw table after ingest and two loads; the second must add nothing."""
    lake, _ = run_ingest(spark, messages, root)
    table, checkpoint = f"{root}/raw_events", f"{root}/_checkpoints/load"
    load_raw(spark, lake, table, checkpoint)
    again = load_raw(spark, lake, table, checkpoint)
    if again:
        raise RuntimeError(f"second load appended {again} rows; files must load once")
    raw = spark.read.parquet(table)
    return raw.select(
        "event_id",
        "event_type",
        "event_timestamp",
        "kafka_partition",
        "kafka_offset",
        F.try_variant_get("payload", "$.customer_id", "string").alias("customer_id"),
        F.try_variant_get("payload", "$.product_id", "string").alias("product_id"),
        F.regexp_extract(F.schema_of_variant("payload"), "^[A-Z]+", 0).alias("payload_type"),
        F.col("source_file").isNotNull().alias("has_source_file"),
    )


def catalog_roundtrip(spark: SparkSession, part: DataFrame, root: str) -> DataFrame:
    """Write two dated product snapshots, re-run the latest day, read the
    catalog back and stage it (latest version per product)."""
    snaps = td.product_snapshots(part)
    for day in (td.PREVIOUS_SNAPSHOT, td.CURRENT_SNAPSHOT, td.CURRENT_SNAPSHOT):
        one_day = snaps.filter(F.col("snapshot_date") == F.lit(day)).drop("snapshot_date")
        write_snapshot(one_day, root, "products", day)
    return staging.stg_products(read_snapshots(spark, root, "products"))


def legacy_roundtrip(spark: SparkSession, messages: DataFrame, root: str) -> DataFrame:
    """Per-type channel: ingest by key into type folders, load each folder
    into its raw table twice (the second adds nothing), read the rows back;
    with them the messages of types without a table, as they lie in the lake,
    and the quarantined ones. One row per message."""
    stream = _topic_stream(spark, messages, root)
    lake, dead = f"{root}/lake", f"{root}/dead_letter"
    legacy_ingest(stream, lake, dead, f"{root}/_checkpoints/ingest", available_now=True).awaitTermination()
    tables, state = f"{root}/raw", f"{root}/_load"
    legacy_load(spark, lake, tables, state)
    again = legacy_load(spark, lake, tables, state)
    if any(again.values()):
        raise RuntimeError(f"second load appended rows: {again}; files must load once")
    none = F.lit(None).cast("string")
    frames = [
        read_legacy_table(spark, tables, state, table).select(
            F.lit(table).alias("table_name"),
            F.variant_get("raw_data", "$.event_id", "string").alias("event_id"),
            F.variant_get("raw_data", "$.event_type", "string").alias("event_type"),
            F.variant_get("raw_data", "$.product_id", "string").alias("product_id"),
            F.col("loaded_at").isNotNull().alias("has_loaded_at"),
            none.alias("error"),
        )
        for table in LEGACY_TABLES
    ]
    parsed = F.parse_json(F.col(RAW_JSON))
    other = spark.read.parquet(lake).filter(~F.col(TYPE_PARTITION).isin(list(LEGACY_TABLES.values())))
    frames.append(
        other.select(
            F.lit("lake only").alias("table_name"),
            F.variant_get(parsed, "$.event_id", "string").alias("event_id"),
            F.col(TYPE_PARTITION).cast("string").alias("event_type"),
            F.variant_get(parsed, "$.product_id", "string").alias("product_id"),
            F.lit(False).alias("has_loaded_at"),
            none.alias("error"),
        )
    )
    frames.append(
        read_dead_letters(spark, dead).select(
            F.lit("quarantine").alias("table_name"),
            F.col("offset").cast("string").alias("event_id"),
            none.alias("event_type"),
            none.alias("product_id"),
            F.lit(False).alias("has_loaded_at"),
            "error",
        )
    )
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def staging_roundtrip(spark: SparkSession, lake_rows: DataFrame, root: str) -> DataFrame:
    """Store raw rows, then stage their orders incrementally in several
    batches; the staged table must equal the full rebuild, although copies
    of one event differ and lie in any batch. The raw files are dealt by the
    message's offset, so copies of an event come in different files."""
    raw, files = f"{root}/raw_events", int(spark.conf.get("spark.sql.shuffle.partitions"))
    load_projection(lake_rows, F.lit(None)).repartition(files, "kafka_offset").write.parquet(raw)
    per_batch = max(files // STAGED_BATCHES, 1)
    return stage_orders(spark, raw, f"{root}/stg_orders", f"{root}/_checkpoints/stage", max_files_per_trigger=per_batch)


def catalog_refresh_roundtrip(spark: SparkSession, part: DataFrame, root: str) -> DataFrame:
    """Incremental latest-per-product table over snapshots that arrive out of
    order: the newer day is merged first, then the older one is backfilled,
    then a refresh finds nothing new."""
    snaps = td.product_snapshots(part)
    for day in (td.CURRENT_SNAPSHOT, td.PREVIOUS_SNAPSHOT):
        # the newer day lacks some products, which only the backfill brings
        some = F.lit(True) if day == td.PREVIOUS_SNAPSHOT else F.col("product_id").cast("long") % 10 != 0
        one_day = snaps.filter((F.col("snapshot_date") == F.lit(day)) & some).drop("snapshot_date")
        write_snapshot(one_day, f"{root}/catalogs", "products", day)
        refresh_latest(spark, f"{root}/catalogs", "products", f"{root}/latest", "product_id")
    latest = refresh_latest(spark, f"{root}/catalogs", "products", f"{root}/latest", "product_id")
    return staging.stg_products(latest)


def lake_files_roundtrip(spark: SparkSession, messages: DataFrame, root: str) -> DataFrame:
    """Ingest, then the lake's file report from the rows themselves: every
    row knows its file (A9), the last files by path (O1), and the counts
    after a load (A8), as facts that do not depend on how files are cut."""
    lake, _ = run_ingest(spark, messages, root)
    rows = read_lake(spark, lake).select("event_type", "_metadata.file_path", "_metadata.file_size")
    per_file = profiling.rows_per_file(rows)
    listed = profiling.lake_files(spark, lake)
    last = [r["file_path"] for r in profiling.latest_files(listed).collect()]
    same = listed.filter(F.col("file_path") >= min(last, default="")).count() == len(last)
    loaded = load_raw(spark, lake, f"{root}/raw_events", f"{root}/_checkpoints/load")
    facts = per_file.agg(
        F.sum("n_rows").cast("long").alias("total_rows"),
        (F.count(F.lit(1)) > 0).alias("has_files"),
        (F.min("file_size") > 0).alias("sizes_known"),
        F.max("n_sizes").cast("long").alias("sizes_per_file"),
    ).first()
    schema = (
        "total_rows long, has_files boolean, sizes_known boolean, sizes_per_file long, "
        "loaded_rows long, last_files_are_last boolean"
    )
    return spark.createDataFrame([(*facts, loaded, same)], schema)


def pipeline_roundtrip(
    spark: SparkSession, messages: DataFrame, products: DataFrame, customers: DataFrame, root: str
) -> DataFrame:
    """The whole chain on one deployment folder: catalog snapshots, then
    ingest -> load -> build with every check, reported (not stopping) as
    ``(check, failures)`` rows. The calendar is sized to the orders."""
    layout = Layout(root)
    write_snapshots(products, layout.catalogs, "products")
    write_snapshots(customers, layout.catalogs, "customers")
    stream = _topic_stream(spark, messages, root)
    result = run_pipeline(spark, stream, layout, calendar=None, fail_fast=False)
    return spark.createDataFrame(result.results, "check string, failures long")


def _drain(spark: SparkSession, messages: DataFrame, root: str, name: str, batches: int) -> None:
    """Ingest messages, landed in a folder of their own, into the lake under
    ``root`` in some micro-batches."""
    files = max(int(spark.conf.get("spark.sql.shuffle.partitions")), batches)
    stream = _topic_stream(spark, messages.repartition(files), f"{root}/{name}", -(-files // batches))
    ingest(stream, f"{root}/lake", f"{root}/dead_letter", f"{root}/_checkpoints/{name}", available_now=True).awaitTermination()


def ledger_roundtrip(spark: SparkSession, messages: DataFrame, root: str) -> DataFrame:
    """Loading by offsets: load, merge the lake's small files, load again
    (nothing new), deliver the offsets that were held back and the last
    messages once more, load these. Raw rows with the number of their load."""
    held_back = td.held_back()
    _drain(spark, messages.filter(~held_back), root, "first", LEDGER_BATCHES)
    ledger = Ledger(spark, f"{root}/lake", f"{root}/raw_events", f"{root}/_ledger")
    ledger.load()
    before = lake_files(spark, f"{root}/lake").count()
    removed, added = compact_lake(spark, f"{root}/lake", f"{root}/_compact")
    after = lake_files(spark, f"{root}/lake").count()
    if before > 1 and (after >= before or before - removed + added != after):
        raise RuntimeError(f"{before} files became {after}: {removed} removed, {added} added")
    if again := ledger.load():
        raise RuntimeError(f"{again} rows loaded again after the files were merged")
    _drain(spark, messages.filter(held_back | td.sent_again()), root, "backfill", 1)
    ledger.load()
    if again := ledger.load():
        raise RuntimeError(f"{again} rows loaded twice")
    raw = ledger.read()
    return raw.select(
        "event_id",
        "event_type",
        "kafka_partition",
        "kafka_offset",
        F.regexp_extract(F.schema_of_variant("payload"), "^[A-Z]+", 0).alias("payload_type"),
        F.col("source_file").isNotNull().alias("has_source_file"),
        F.when(F.col("load") > 1, "backfill").otherwise("first").alias("load"),
    )


def land_days(rows: DataFrame, path: str) -> DataFrame:
    """Raw rows stored by the day they come on, 0 or 1, so that one pass over
    the input makes both days; rows without an offset come on neither."""
    dated = rows.withColumn("day", (F.expr("kafka_offset div 64") % 2).cast("int")).filter("day IN (0, 1)")
    files = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dated.repartition(files, "kafka_offset").write.partitionBy("day").parquet(path)
    return rows.sparkSession.read.schema(dated.schema).parquet(path)  # a day's rows lie in its own folder


def fact_roundtrip(spark: SparkSession, lake_rows: DataFrame, dim_customers: DataFrame, dim_products: DataFrame, root: str) -> DataFrame:
    """The incremental fact: orders come in two days, some customers and
    products only after them; each refresh builds the buckets that changed."""
    raw, staged, state = f"{root}/raw_events", f"{root}/stg_orders", f"{root}/fact"
    some_customers = dim_customers.filter(F.crc32("customer_id") % 7 != 0)
    some_products = dim_products.filter(F.crc32("product_id") % 11 != 0)
    landed = land_days(load_projection(lake_rows, F.lit(None)), f"{root}/landed")
    for day in (0, 1):
        landed.filter(F.col("day") == day).drop("day").write.mode("append").parquet(raw)
        stage_orders(spark, raw, staged, f"{root}/_checkpoints/stage")
        refresh_fact(spark, staged, state, some_customers, some_products)
    refresh_fact(spark, staged, state, dim_customers, dim_products)
    if built := refresh_fact(spark, staged, state, dim_customers, dim_products):
        raise RuntimeError(f"nothing changed, yet {len(built)} buckets were built")
    return read_fact(spark, state)


def buffered_roundtrip(spark: SparkSession, messages: DataFrame, root: str) -> DataFrame:
    """The per-type channel with a buffer per type: messages of each type in
    the lake, and files that hold more than a flush; the quarantined ones."""
    before = spark.conf.get(_STATE_STORE)
    spark.conf.set(_STATE_STORE, ROCKSDB)
    lake, dead = f"{root}/lake", f"{root}/dead_letter"
    try:
        stream = _topic_stream(spark, messages, root)
        query = legacy_ingest_buffered(stream, lake, dead, f"{root}/_checkpoints/buffers", max_age_ms=BUFFER_AGE_MS, trigger_interval="500 milliseconds")
        drain_buffers(query, BUFFER_AGE_MS)
    finally:
        spark.conf.set(_STATE_STORE, before)
    landed = spark.read.parquet(lake).select(TYPE_PARTITION, F.col("_metadata.file_path").alias("file"))
    per_file = landed.groupBy(TYPE_PARTITION, "file").agg(F.count(F.lit(1)).alias("n"))
    types = per_file.groupBy(TYPE_PARTITION).agg(F.sum("n").alias("n_messages"), F.count_if(F.col("n") > 500).alias("files_over_limit"))
    bad = read_dead_letters(spark, dead).agg(F.count(F.lit(1)).alias("n_messages"))
    quarantined = bad.select(F.lit("quarantine").alias(TYPE_PARTITION), "n_messages", F.lit(0).cast("long").alias("files_over_limit"))
    return types.select(F.col(TYPE_PARTITION).cast("string").alias(TYPE_PARTITION), "n_messages", "files_over_limit").unionByName(quarantined)


def profile_roundtrip(spark: SparkSession, messages: DataFrame, root: str) -> DataFrame:
    """The incremental lake profile: land a part, profile, land the rest,
    profile again; one row for the whole lake and one per event type."""
    later = F.expr("offset div 8") % 3 == 0
    profile = LakeProfile(spark, f"{root}/lake", f"{root}/_profile")
    for name, part in (("first", messages.filter(~later)), ("second", messages.filter(later))):
        _drain(spark, part, root, name, 1)
        profile.refresh()
    if hours := profile.refresh():
        raise RuntimeError(f"{hours} hours read again, though nothing was added")
    whole = profile.summary().select(F.lit("all").alias("event_type"), "total_rows", "distinct_event_ids", "duplicate_rows")
    none = F.lit(None).cast("long")
    return whole.unionByName(
        profile.per_type().select("event_type", F.col("n_events").alias("total_rows"), none.alias("distinct_event_ids"), none.alias("duplicate_rows"))
    )
