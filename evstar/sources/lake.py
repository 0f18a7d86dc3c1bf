"""The append-only event lake (S6, A4 of FIXTURES) and the raw table schema.

Lake layout: ``{root}/ingest_date=YYYY-MM-DD/ingest_hour=HH/part-*.parquet``.
Readers pass the schema explicitly so partition values stay STRING (no
inference turning ``03`` into 3) and no file footer is sampled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

LAKE_DATA_FIELDS = [
    T.StructField("event_id", T.StringType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("event_timestamp", T.StringType()),
    T.StructField("payload", T.StringType()),
    T.StructField("kafka_partition", T.IntegerType()),
    T.StructField("kafka_offset", T.LongType()),
    T.StructField("ingested_at", T.StringType()),
]
PARTITION_FIELDS = [
    T.StructField("ingest_date", T.StringType()),
    T.StructField("ingest_hour", T.StringType()),
]
LAKE_SCHEMA = T.StructType(LAKE_DATA_FIELDS + PARTITION_FIELDS)
LAKE_PARTITIONS = ["ingest_date", "ingest_hour"]

RAW_EVENTS_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("event_timestamp", T.TimestampType()),
        T.StructField("payload", T.VariantType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("ingested_at", T.TimestampType()),
        T.StructField("source_file", T.StringType()),
    ]
)

DEAD_LETTER_SCHEMA = T.StructType(
    [
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("error", T.StringType()),
        T.StructField("raw_value", T.StringType()),
    ]
)


def read_lake(spark: SparkSession, root: str) -> DataFrame:
    """Batch scan of the whole lake; filters on ingest_date/ingest_hour prune
    folders before any file is opened."""
    return spark.read.schema(LAKE_SCHEMA).parquet(root)


def read_dead_letters(spark: SparkSession, root: str, one_per_message: bool = False) -> DataFrame:
    """Quarantined messages (JSON lines). A replayed batch can repeat a
    record; ``one_per_message=True`` keeps one row per (partition, offset)
    (a shuffle on that key, partially deduplicated in every map task)."""
    df = spark.read.schema(DEAD_LETTER_SCHEMA).json(root)
    return df.dropDuplicates(["partition", "offset"]) if one_per_message else df
