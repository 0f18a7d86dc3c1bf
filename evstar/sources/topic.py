"""The event topic: subscribe options (S1, S2, S5) and publishing (K8, K9).

The Kafka connector is a deployment dependency: every function here builds
the reader/writer through ``format("kafka")`` and needs the
``spark-sql-kafka`` package on the cluster. Jobs in :mod:`evstar.streaming`
take the resulting DataFrame as an argument, so they run on any source
with Kafka's columns (``key, value, partition, offset, timestamp``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.envelope import envelope_json
from ..functions.keys import message_key, stable_uuid

# The topic name, and the batch rule (a micro-batch closes at
# this many messages or this age).
TOPIC = "ecommerce-events"
FLUSH_ROWS = 200
FLUSH_DELAY = "30s"


def topic_options(
    bootstrap_servers: str,
    topic: str = TOPIC,
    starting_offsets: str = "earliest",
    flush_rows: int | None = None,
    flush_delay: str | None = None,
    min_partitions: int | None = None,
    max_rows_per_batch: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options for a topic source. Progress lives in the query checkpoint,
    so nothing is committed to the broker.

    ``flush_rows``/``flush_delay`` give the "N messages or T seconds,
    whichever first" batch rule (T-1), e.g. ``FLUSH_ROWS``/``FLUSH_DELAY``.
    ``min_partitions`` splits large topic partitions over more tasks, so a
    topic with few partitions still parses on every core.
    ``max_rows_per_batch`` caps a micro-batch, so draining a large backlog
    (also with ``availableNow``) runs as several bounded batches.
    """
    opts = {
        "kafka.bootstrap.servers": bootstrap_servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
        "failOnDataLoss": "true",
    }
    if flush_rows:
        opts["minOffsetsPerTrigger"] = str(flush_rows)
    if flush_delay:
        opts["maxTriggerDelay"] = flush_delay
    if min_partitions:
        opts["minPartitions"] = str(min_partitions)
    if max_rows_per_batch:
        opts["maxOffsetsPerTrigger"] = str(max_rows_per_batch)
    opts.update(extra)
    return opts


def read_topic(
    spark: SparkSession,
    bootstrap_servers: str,
    topic: str = TOPIC,
    streaming: bool = True,
    starting_offsets: str = "earliest",
    flush_rows: int | None = None,
    flush_delay: str | None = None,
    min_partitions: int | None = None,
    max_rows_per_batch: int | None = None,
    **extra: str,
) -> DataFrame:
    """Topic as a streaming DataFrame (ingest) or a bounded batch read of
    earliest..latest (profiling, S5)."""
    opts = topic_options(
        bootstrap_servers, topic, starting_offsets, flush_rows, flush_delay, min_partitions, max_rows_per_batch, **extra
    )
    if streaming:
        return spark.readStream.format("kafka").options(**opts).load()
    opts.setdefault("endingOffsets", "latest")
    return spark.read.format("kafka").options(**opts).load()


def publish_frame(events: DataFrame, key: Column | None = None) -> DataFrame:
    """``(key, value)`` rows for the topic from an events table.

    ``events`` has ``event_type, event_timestamp`` and a struct ``payload``;
    without an ``event_id`` column one is derived from the row (C23). The
    default key is the customer, else the product.
    """
    if "event_id" not in events.columns:
        events = events.withColumn("event_id", stable_uuid(*[F.col(c) for c in events.columns]))
    if key is None:
        key = message_key(F.col("payload.customer_id"), F.col("payload.product_id"))
    value = envelope_json(F.col("event_id"), F.col("event_type"), F.col("event_timestamp"), F.col("payload"))
    return events.select(key.cast("string").alias("key"), value.alias("value"))


def publish(frame: DataFrame, bootstrap_servers: str, topic: str = TOPIC) -> None:
    """Write ``(key, value)`` rows to the topic; all replicas acknowledge and
    the producer is idempotent (K8)."""
    (
        frame.write.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap_servers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.linger.ms", "50")
        .option("topic", topic)
        .save()
    )
