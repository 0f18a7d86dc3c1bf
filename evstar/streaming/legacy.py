"""The older per-event-type path (v1): messages keyed by event type, flat
JSON values, one lake folder per type and one raw table for each of three
types (K2, K9, K12, S2, S9, T-2, T-3, F19, A8).

Ingest: every message with a key and a JSON value lands as its text under
``event_type=<key>/dt=/hr=``, whatever the key; the others go to the
quarantine with a reason. Nothing is dropped.

Load: each file once, by a manifest of loaded files. A file that cannot be
read, or a row that is not JSON, is skipped and recorded in the table's error
log; unreadable files stay out of the manifest, so the next run tries them
again.
"""

from __future__ import annotations

from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.envelope import ERR_EMPTY, ERR_JSON, ERR_UTF8, message_text, parse_envelope, quarantine_value
from .buffers import LANES, MAX_AGE_MS, ROWS_PER_FLUSH, buffered
from .compact import open_place

S = T.StringType()
D = T.DoubleType()
I = T.IntegerType()

# The flat event shapes of each type.
LEGACY_SCHEMAS: dict[str, T.StructType] = {
    "page_view": T.StructType(
        [T.StructField(n, S) for n in ("event_id", "event_type", "event_timestamp", "customer_id",
                                        "product_id", "session_id", "device", "referrer")]
    ),
    "purchase": T.StructType(
        [T.StructField(n, S) for n in ("event_id", "event_type", "event_timestamp", "order_id",
                                        "customer_id", "customer_email", "product_id", "product_name",
                                        "category")]
        + [T.StructField("unit_price", D), T.StructField("quantity", I), T.StructField("total_amount", D)]
        + [T.StructField(n, S) for n in ("payment_method", "shipping_country")]
    ),
    "inventory_update": T.StructType(
        [T.StructField(n, S) for n in ("event_id", "event_type", "event_timestamp", "product_id",
                                        "product_name", "warehouse_id")]
        + [T.StructField("quantity_change", I), T.StructField("reason", S)]
    ),
}
# Raw table fed by each type's lake folder.
LEGACY_TABLES = {
    "purchase_events": "purchase",
    "page_view_events": "page_view",
    "inventory_events": "inventory_update",
}
TYPE_PARTITION = "event_type"
LEGACY_PARTITIONS = [TYPE_PARTITION, "dt", "hr"]
# the original message text
RAW_JSON = "raw_json"
ERR_NO_TYPE = "message without an event type"


def legacy_publish_frame(events: DataFrame, type_col: str = "event_type") -> DataFrame:
    """``(key, value)`` for the v1 topic: key = event type, value = the flat row as JSON (K9)."""
    return events.select(
        F.col(type_col).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in events.columns])).alias("value"),
    )


def legacy_error(key: Column, value: Column) -> Column:
    """Why a v1 message cannot be landed, or NULL (F19): it needs a key,
    which is its event type, and a value that is one JSON text."""
    text = message_text(value)
    return (
        F.when(F.coalesce(key.cast("string"), F.lit("")) == "", F.lit(ERR_NO_TYPE))
        .when(value.isNull(), F.lit(ERR_EMPTY))
        .when(~F.is_valid_utf8(text), F.lit(ERR_UTF8))
        .when(parse_envelope(value).isNull(), F.lit(ERR_JSON))
    )


def legacy_rows(lake_rows: DataFrame, event_type: str) -> DataFrame:
    """Typed rows of one event type from lake rows, next to ``raw_json`` (a
    value that does not fit its typed column is NULL there but kept in the
    text)."""
    picked = lake_rows.filter(F.col(TYPE_PARTITION) == F.lit(event_type))
    return picked.select(F.from_json(RAW_JSON, LEGACY_SCHEMAS[event_type]).alias("r"), RAW_JSON).select("r.*", RAW_JSON)


def write_legacy_batch(
    batch: DataFrame, batch_id: int, lake_root: str, dead_letter_root: str, rows_per_file: int = 0
) -> None:
    """Append every message under ``{lake}/event_type=/dt=/hr=`` (K2, T-3),
    or to the quarantine; ``rows_per_file`` bounds the files' rows."""
    now = F.current_timestamp()
    routed = batch.select(
        F.col("key").cast("string").alias(TYPE_PARTITION),
        message_text("value").alias(RAW_JSON),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        legacy_error(F.col("key"), F.col("value")).alias("error"),
        F.date_format(now, "yyyy-MM-dd").alias("dt"),
        F.date_format(now, "HH").alias("hr"),
    ).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        good = routed.filter(F.col("error").isNull()).select(RAW_JSON, *LEGACY_PARTITIONS)
        good.write.mode("append").partitionBy(*LEGACY_PARTITIONS).option("compression", "snappy").option(
            "maxRecordsPerFile", rows_per_file
        ).parquet(lake_root)
        bad = routed.filter(F.col("error").isNotNull())
        bad.select("partition", "offset", "error", quarantine_value(F.col(RAW_JSON)).alias("raw_value")).write.mode(
            "append"
        ).json(dead_letter_root)
    finally:
        routed.unpersist()


def legacy_ingest(
    messages: DataFrame,
    lake_root: str,
    dead_letter_root: str,
    checkpoint: str,
    available_now: bool = False,
    trigger_interval: str = "60 seconds",
) -> StreamingQuery:
    """v1 consumer: a micro-batch every ``trigger_interval``, split by key.

    The trigger is the age limit, and one batch writes all types; for the rule
    of so many rows of a type or so long (T-2) see
    :func:`legacy_ingest_buffered`.

    With a topic source, start from ``latest`` (S2); progress is kept in the
    checkpoint, so unlike auto-commit no buffered row is lost on a crash.
    """
    writer = messages.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        lambda df, batch_id: write_legacy_batch(df, batch_id, lake_root, dead_letter_root)
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger_interval)
    return writer.start()


def legacy_ingest_buffered(
    messages: DataFrame,
    lake_root: str,
    dead_letter_root: str,
    checkpoint: str,
    rows: int = ROWS_PER_FLUSH,
    max_age_ms: int = MAX_AGE_MS,
    lanes: int = LANES,
    trigger_interval: str = "1 second",
) -> StreamingQuery:
    """v1 consumer with a buffer per event type that is written at ``rows``
    rows or ``max_age_ms`` after its first one (T-2). No file has more than
    ``rows`` rows. Buffers are state, so nothing waiting is lost in a crash;
    :func:`evstar.streaming.buffers.drain_buffers` ends a bounded run. Needs
    the RocksDB state store."""

    def write(batch: DataFrame, batch_id: int) -> None:
        flushes = batch.repartition("key", "lane", "flush").sortWithinPartitions("key", "lane", "flush")
        write_legacy_batch(flushes.drop("lane", "flush"), batch_id, lake_root, dead_letter_root, rows)

    return (
        buffered(messages, rows, max_age_ms, lanes)
        .writeStream.option("checkpointLocation", checkpoint)
        .outputMode("append")
        .foreachBatch(write)
        .trigger(processingTime=trigger_interval)
        .start()
    )


_LOADED = "file_path string, load_id int"
_ERRORS = "file_path string, error string, raw_json string, load_id int"


def _log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log folder, empty before its first entry."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)


def _new_files(spark: SparkSession, folder: str, loaded: DataFrame) -> DataFrame:
    """``file_path`` of the files of a type folder that the manifest does not
    hold (metadata only)."""
    try:
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", "true").load(folder)
    except AnalysisException:  # no message of this type so far
        return spark.createDataFrame([], "file_path string")
    return files.select(F.col("path").alias("file_path")).join(loaded.select("file_path").distinct(), "file_path", "left_anti")


def _same_file(path: str) -> Column:
    """A file's path, however many slashes come after the scheme."""
    return F.regexp_replace(path, "^file:/+", "/")


def _misfit(found: pa.Schema, wanted: T.StructType) -> str | None:
    """A column whose type in a file cannot be read as the wanted one."""
    for f in wanted:
        if f.name in found.names:
            kind = found.field(f.name).type
            fits = {
                S: pa.types.is_string(kind) or pa.types.is_large_string(kind),
                D: pa.types.is_float64(kind) or pa.types.is_float32(kind),
                I: pa.types.is_int32(kind) or pa.types.is_int16(kind) or pa.types.is_int8(kind),
            }
            if not fits[f.dataType]:
                return f"column {f.name} is {kind}, wanted {f.dataType.simpleString()}"
    return None


def _probe(files: DataFrame, schema: T.StructType) -> DataFrame:
    """``file_path, rows, error``: every file read to its end in tasks; the
    error is NULL where that works and the columns have the wanted types.
    All bad files are found in one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, rows, errors = batch.column(0).to_pylist(), [], []
            for path in paths:
                n, said = 0, None
                try:
                    store, place = open_place(path)
                    with store.open_input_file(place) as source:
                        file = pq.ParquetFile(source)
                        said = _misfit(file.schema_arrow, schema)
                        n = sum(b.num_rows for b in file.iter_batches(1024))
                except Exception as error:  # whatever is wrong with it, it goes to the error log
                    said = str(error).split("\n", 1)[0][:500] or type(error).__name__
                rows.append(n)
                errors.append(said)
            yield pa.record_batch(
                [pa.array(paths, pa.string()), pa.array(rows, pa.int64()), pa.array(errors, pa.string())], names=["file_path", "rows", "error"]
            )

    spread = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.repartition(spread, "file_path").mapInArrow(run, "file_path string, rows long, error string")


def _load_table(spark: SparkSession, folder: str, table_root: str, state_root: str, schema: T.StructType) -> int:
    """Load the new files of one type in one pass. File names stay in tables:
    the driver sees the folders that hold new files (at most the hours). A
    load that misses rows of a whole file fails and does not count."""
    loaded = _log(spark, f"{state_root}/manifest", _LOADED)
    load_id = (loaded.agg(F.max("load_id")).first()[0] or 0) + 1
    named = f"load-{load_id:06d}"
    _probe(_new_files(spark, folder, loaded), schema).write.mode("overwrite").parquet(f"{state_root}/probed/{named}")
    probed = spark.read.parquet(f"{state_root}/probed/{named}")
    good_files = probed.filter("error is null").select("file_path")
    bad_files = probed.filter("error is not null").select(
        "file_path", "error", F.lit(None).cast("string").alias(RAW_JSON), F.lit(load_id).alias("load_id")
    )
    whole = F.col("error").isNull()
    found = probed.agg(
        F.count_if(whole).alias("good"), F.count("error").alias("bad"), F.sum(F.when(whole, F.col("rows"))).alias("rows")
    ).first()
    if found["bad"]:
        bad_files.write.mode("append").parquet(f"{state_root}/file_errors")
    if not found["good"]:
        return 0
    folders = [r[0] for r in good_files.select(F.regexp_extract("file_path", "^(.*)/[^/]*$", 1)).distinct().collect()]
    # Files put aside, and old ones of the same hours, are left by the join.
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").option("ignoreCorruptFiles", "true").parquet(*folders)
    rows = rows.select("*", F.col("_metadata.file_path").alias("of_file"))
    wanted = good_files.select(_same_file("file_path").alias("wanted"))
    rows = rows.join(wanted, _same_file("of_file") == F.col("wanted"), "left_semi")
    typed = F.to_variant_object(F.struct(*[F.col(f.name) for f in schema.fields if f.name != RAW_JSON]))
    parsed = F.try_parse_json(F.col(RAW_JSON))
    target = f"{table_root}/{named}"
    good = rows.filter(F.col(RAW_JSON).isNull() | parsed.isNotNull())
    bad = rows.filter(F.col(RAW_JSON).isNotNull() & parsed.isNull())
    good.select(F.coalesce(parsed, typed).alias("raw_data"), F.localtimestamp().alias("loaded_at")).write.mode("overwrite").parquet(target)
    bad.select(F.col("of_file").alias("file_path"), F.lit(ERR_JSON).alias("error"), RAW_JSON, F.lit(load_id).alias("load_id")).write.mode(
        "overwrite"
    ).parquet(f"{state_root}/row_errors/{named}")
    loaded_rows, skipped = spark.read.parquet(target).count(), spark.read.parquet(f"{state_root}/row_errors/{named}").count()
    if loaded_rows + skipped != found["rows"]:
        raise RuntimeError(f"{found['rows']} rows in the files, {loaded_rows + skipped} read: nothing is counted as loaded")
    good_files.select("file_path", F.lit(load_id).alias("load_id")).write.mode("append").parquet(f"{state_root}/manifest")
    return loaded_rows


def legacy_load(spark: SparkSession, lake_root: str, tables_root: str, state_root: str) -> dict[str, int]:
    """Load new files of each known type's folder into its raw table.

    ``raw_data`` is the whole row as a VARIANT: the original message text
    when the file carries it, else the typed columns as an object;
    ``loaded_at`` is the load time. What cannot be read or parsed is skipped
    and recorded (:func:`load_errors`). A load writes a folder of its own and
    counts once the manifest names it, so a load that broke off is done
    anew. Returns the rows appended per table.
    """
    lake, tables, state = lake_root.rstrip("/"), tables_root.rstrip("/"), state_root.rstrip("/")

    def load(item: tuple[str, str]) -> tuple[str, int]:
        table, event_type = item
        schema = T.StructType(LEGACY_SCHEMAS[event_type].fields + [T.StructField(RAW_JSON, S)])
        folder = f"{lake}/{TYPE_PARTITION}={event_type}"
        return table, _load_table(spark, folder, f"{tables}/{table}", f"{state}/{table}", schema)

    with ThreadPoolExecutor(len(LEGACY_TABLES)) as together:  # the tables do not depend on each other
        return dict(together.map(load, LEGACY_TABLES.items()))


def read_legacy_table(spark: SparkSession, tables_root: str, state_root: str, table: str) -> DataFrame:
    """A raw table: the rows of all loads that the manifest names."""
    loads = _log(spark, f"{state_root.rstrip('/')}/{table}/manifest", _LOADED).select("load_id").distinct().collect()
    if not loads:
        return spark.createDataFrame([], "raw_data variant, loaded_at timestamp_ntz")
    return spark.read.parquet(*[f"{tables_root.rstrip('/')}/{table}/load-{r[0]:06d}" for r in loads])


def load_errors(spark: SparkSession, state_root: str, table: str) -> DataFrame:
    """What loads skipped: ``file_path, error, raw_json, load_id`` (a NULL
    text for a whole file, which the next load tries again)."""
    root = f"{state_root.rstrip('/')}/{table}"
    try:
        rows = spark.read.schema(_ERRORS).option("recursiveFileLookup", "true").parquet(f"{root}/row_errors")
    except AnalysisException:
        rows = spark.createDataFrame([], _ERRORS)
    return rows.unionByName(_log(spark, f"{root}/file_errors", _ERRORS))


def legacy_row_count(spark: SparkSession, tables_root: str, state_root: str, table: str) -> int:
    """Post-load sanity count of one raw table."""
    return read_legacy_table(spark, tables_root, state_root, table).count()
