"""Parse, validate and route topic messages (F1-F5, F8, T-3).

Pure DataFrame functions shared by the streaming ingest job and by batch
re-processing of landed messages. Input columns follow Kafka's source:
``key, value, partition, offset`` (``value`` BINARY or STRING).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.envelope import envelope_columns, message_error, parse_fields, quarantine_value

_FIELDS = "__evstar_fields"

# The lake's text formats for the ingest stamp (UTC).
ISO_UTC_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"
DATE_FORMAT = "yyyy-MM-dd"
HOUR_FORMAT = "HH"


def parse_messages(messages: DataFrame, value: str = "value") -> DataFrame:
    """Add ``error`` (NULL when valid) and the envelope fields to each message.

    A bad message never fails the batch; it just gets a reason. The decoded
    fields are held in one struct column first, so the text is decoded once.
    """
    decoded = messages.select(
        "*",
        message_error(F.col(value)).alias("error"),
        parse_fields(F.col(value)).alias(_FIELDS),
    )
    return decoded.select(
        *[c for c in decoded.columns if c != _FIELDS],
        *envelope_columns(F.col(value), F.col(_FIELDS)),
    )


def accepted(parsed: DataFrame) -> DataFrame:
    """Valid events as lake rows without the ingest stamp (F1)."""
    return parsed.filter(F.col("error").isNull()).select(
        "event_id",
        "event_type",
        "event_timestamp",
        "payload",
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
    )


def quarantined(parsed: DataFrame, value: str = "value") -> DataFrame:
    """Dead-letter records ``partition, offset, error, raw_value``."""
    return parsed.filter(F.col("error").isNotNull()).select(
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        "error",
        quarantine_value(F.col(value)).alias("raw_value"),
    )


def stamp(rows: DataFrame, at: Column | dt.datetime | None = None) -> DataFrame:
    """Add ``ingested_at`` (ISO-8601 UTC text) and the ``ingest_date`` /
    ``ingest_hour`` partition values (F8).

    ``at`` defaults to ``current_timestamp()``, which Spark fixes once per
    query, so one micro-batch shares one stamp.
    """
    if at is None:
        ts = F.current_timestamp()
    elif isinstance(at, dt.datetime):
        ts = F.lit(at)
    else:
        ts = at
    return rows.withColumns(
        {
            "ingested_at": F.date_format(ts, ISO_UTC_FORMAT),
            "ingest_date": F.date_format(ts, DATE_FORMAT),
            "ingest_hour": F.date_format(ts, HOUR_FORMAT),
        }
    )
