"""Incremental order staging: only raw rows loaded since the last run are
parsed and typed, and only the buckets they fall into are rewritten.

A file-source stream over the raw table (it reads the table's commit log,
so only committed files) feeds micro-batches. Each batch is merged into a
table in hash buckets of the event id (:mod:`evstar.streaming.keyed`), which
keeps the first delivery of every event (W1: ingest time, then offset),
whatever order the copies came in; NULL ids form one event: the same as
``stg_orders`` over the whole raw table. A batch costs its own rows and the
buckets it touches, and reading costs a plain scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.staging import BAD_FIELD, checked_orders, typed_orders
from ..sources.lake import RAW_EVENTS_SCHEMA
from .keyed import BUCKETS, KeyedTable
from .load import MAX_FILE_AGE

TYPED_ORDERS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("quantity", T.DecimalType(38, 0)),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("total_amount", T.DecimalType(10, 2)),
        T.StructField("payment_method", T.StringType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("ordered_at", T.TimestampType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField(BAD_FIELD, T.StringType()),
    ]
)


def staged_table(spark: SparkSession, staged_root: str, buckets: int = BUCKETS) -> KeyedTable:
    """The kept copy of every order event, typed."""
    order = [F.col("ingested_at").asc_nulls_last(), F.col("kafka_offset").asc_nulls_last()]
    return KeyedTable(spark, staged_root, TYPED_ORDERS_SCHEMA, "event_id", order, buckets)


def read_staged_orders(spark: SparkSession, staged_root: str) -> DataFrame:
    """The staged orders, one row per event."""
    return checked_orders(staged_table(spark, staged_root).read())


def stage_batch(batch: DataFrame, batch_id: int, staged_root: str, order_type: str = "order", buckets: int = BUCKETS) -> None:
    """Merge the typed orders of one batch of raw rows. A batch that is
    replayed, under whatever number, changes nothing."""
    staged_table(batch.sparkSession, staged_root, buckets).merge(typed_orders(batch, order_type))


def stage_orders(
    spark: SparkSession,
    raw_root: str,
    staged_root: str,
    checkpoint: str,
    order_type: str = "order",
    max_files_per_trigger: int | None = None,
    buckets: int = BUCKETS,
) -> DataFrame:
    """Bring the staged orders up to date with the raw table and return them."""
    reader = spark.readStream.schema(RAW_EVENTS_SCHEMA).option("maxFileAge", MAX_FILE_AGE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    query = (
        reader.parquet(raw_root)
        .writeStream.option("checkpointLocation", checkpoint)
        .foreachBatch(lambda df, batch_id: stage_batch(df, batch_id, staged_root, order_type, buckets))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return read_staged_orders(spark, staged_root)
