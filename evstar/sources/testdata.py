"""Stand-in inputs derived from the driver's generic tables.

The pipeline consumes topic messages and catalog snapshots; the test
corpus holds ``events``, ``customer``, ``part``, ``nation`` and ``orders``
tables instead. These functions turn every row of those tables into the
shapes the pipeline reads, so each query's work grows with the tables.
All rules are row-wise expressions (no shuffle, no sampling): an event's
product number ``k`` (from ``props``) decides its faults, which spreads
them evenly over the data.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.keys import message_key
from ..operators.partitioning import ensure_parallelism
from ..operators.routing import parse_messages, stamp
from ..streaming.load import load_projection

# Payment methods in the producer's order.
PAYMENT_METHODS = ["card", "upi", "paypal", "cash_on_delivery"]

# Stand-in rules (product number k of the event, 0..99).
TOMBSTONE_K = 79  # message value is NULL
TRUNCATED_K = 97  # message cut after 40 characters -> invalid JSON
ARRAY_K = 83  # message wrapped in a JSON array -> not an object
NO_PAYLOAD_K = 89  # envelope without payload -> missing fields
TRAILING_K = 71  # more text after the message -> invalid JSON
REDELIVERED_K = 42  # published twice; the copy differs and may be ingested first
NULL_ID_K = 61  # event id is JSON null
GUEST_K = 13  # order by a guest: customer id unknown to the catalog
NO_CUSTOMER_K = 17  # customer id is the empty text
# Payloads of other than orders that are no objects.
SCALAR_PAYLOADS = {23: '"hello"', 29: '"123"', 31: "42", 37: "[1, 2]", 41: "null", 43: '"null"'}
CANCEL_EVERY = 20  # k divisible by this -> cancelled order
TRUNCATE_AT = 40
TOPIC_PARTITIONS = 3
RUN = 1000  # events in a row in one partition, where offsets are dense
INGEST_DELAY_SECONDS = 30
REDELIVERY_DELAY_SECONDS = 10  # of the copy, when it overtakes the first delivery
LATE_DELIVERY_SECONDS = 90  # of the copy, when it does not
CURRENT_SNAPSHOT = dt.date(2024, 1, 1)
PREVIOUS_SNAPSHOT = dt.date(2023, 12, 1)
CITIES = 50
FIRST_SIGNUP = dt.date(2020, 1, 1)
SIGNUP_DAYS = 1000

ISO_TEXT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def _q(c: Column) -> Column:
    """JSON string literal of a text column (values here need no escaping)."""
    return F.concat(F.lit('"'), c, F.lit('"'))


def topic_messages(events: DataFrame) -> DataFrame:
    """Kafka-shaped messages ``key, value, partition, offset, timestamp``
    from the ``events`` table (purchase -> order events with a payload)."""
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    e = ensure_parallelism(events).select("event_id", "ts", "user_id", "event_type", "value", k.alias("k"))

    etype = F.when(F.col("event_type") == "purchase", F.lit("order")).otherwise(F.col("event_type"))
    is_order = F.col("event_type") == "purchase"
    cid = (
        F.when(F.col("event_type") == "error", F.lit(None).cast("string"))
        .when(is_order & (F.col("k") == GUEST_K), F.concat(F.lit("G"), F.col("user_id").cast("string")))
        .when(F.col("k") == NO_CUSTOMER_K, F.lit(""))
        .otherwise(F.col("user_id").cast("string"))
    )
    qty = (F.col("k") % 3 + 1).cast("int")
    price = F.col("value").cast("decimal(10,2)")
    pay = F.element_at(F.array(*[F.lit(m) for m in PAYMENT_METHODS]), (F.col("user_id") % 4 + 1).cast("int"))
    # Per-event parts, computed once each (the projection shares them).
    parts = e.select(
        "event_id",
        "k",
        F.col("ts").cast("timestamp").alias("timestamp"),
        (F.col("user_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        etype.alias("etype"),
        cid.alias("cid"),
        F.col("k").cast("string").alias("pid"),
        qty.alias("qty"),
        price.alias("price"),
        pay.alias("pay"),
        F.date_format(F.col("ts"), ISO_TEXT).alias("ts_text"),
    )
    fee = F.when((F.col("pay") == "cash_on_delivery") & (F.col("qty") > 1), F.lit(0.02)).otherwise(F.lit(0.0))
    total = (F.col("price") * F.col("qty") + fee.cast("decimal(3,2)")).cast("decimal(12,2)")
    status = F.when(F.col("k") % CANCEL_EVERY == 0, F.lit("cancelled")).otherwise(F.lit("completed"))

    order_payload = F.concat(
        F.lit('{"order_id": '), _q(F.concat(F.lit("O"), F.col("event_id").cast("string"))),
        F.lit(', "customer_id": '), _q(F.col("cid")),
        F.lit(', "product_id": '), _q(F.col("pid")),
        F.lit(', "quantity": '), F.col("qty").cast("string"),
        F.lit(', "unit_price": '), F.col("price").cast("string"),
        F.lit(', "total_amount": '), total.cast("string"),
        F.lit(', "payment_method": '), _q(F.col("pay")),
        F.lit(', "order_status": '), _q(status),
        F.lit("}"),
    )
    other_payload = F.when(
        F.col("cid").isNull(), F.concat(F.lit('{"product_id": '), _q(F.col("pid")), F.lit("}"))
    ).otherwise(F.concat(F.lit('{"customer_id": '), _q(F.col("cid")), F.lit(', "product_id": '), _q(F.col("pid")), F.lit("}")))
    scalar = F.element_at(
        F.create_map(*[F.lit(x) for kv in SCALAR_PAYLOADS.items() for x in kv]), F.col("k")
    )
    payload = F.when(F.col("etype") == "order", order_payload).otherwise(F.coalesce(scalar, other_payload))
    event_id = F.when(F.col("k") == NULL_ID_K, F.lit("null")).otherwise(_q(F.col("event_id").cast("string")))
    head = F.concat(
        F.lit('{"event_id": '), event_id,
        F.lit(', "event_type": '), _q(F.col("etype")),
        F.lit(', "event_timestamp": '), _q(F.col("ts_text")),
    )
    envelope = F.concat(head, F.lit(', "payload": '), payload, F.lit("}"))
    text = (
        F.when(F.col("k") == TOMBSTONE_K, F.lit(None).cast("string"))
        .when(F.col("k") == TRUNCATED_K, F.substring(envelope, 1, TRUNCATE_AT))
        .when(F.col("k") == ARRAY_K, F.concat(F.lit("["), envelope, F.lit("]")))
        .when(F.col("k") == NO_PAYLOAD_K, F.concat(head, F.lit("}")))
        .when(F.col("k") == TRAILING_K, F.concat(envelope, F.when(F.col("event_id") % 2 == 0, F.lit(" x")).otherwise(envelope)))
        .otherwise(envelope)
    )
    copies = F.when(F.col("k") == REDELIVERED_K, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # The message text is produced by a generator: later filters on the
    # parsed message stop at the generator instead of inlining this
    # text-building expression into every parse call.
    generated = parts.select(
        message_key(F.col("cid"), F.col("pid")).alias("key"),
        "partition",
        "timestamp",
        "event_id",
        copies.alias("copies"),
        F.inline(F.array(F.struct(text.alias("text")))),
    )
    delivered = generated.select(
        "key", "text", "partition", "timestamp", "event_id", F.explode("copies").alias("copy")
    )
    # The copy of a redelivered order has another status.
    changed = F.replace(F.col("text"), F.lit('"completed"'), F.lit('"cancelled"'))
    return delivered.select(
        "key",
        F.when(F.col("copy") == 1, changed).otherwise(F.col("text")).cast("binary").alias("value"),
        "partition",
        (F.col("event_id") * 2 + F.col("copy")).cast("long").alias("offset"),
        "timestamp",
    )


def dense_offsets(messages: DataFrame) -> DataFrame:
    """The messages with offsets that follow each other, as a topic's do: runs
    of ``RUN`` events go to one of the partitions in turn, redelivered copies
    to one more."""
    event, copy = F.expr("offset div 2"), F.col("offset") % 2 == 1
    run = F.expr(f"offset div 2 div {RUN}")
    dense = F.expr(f"offset div 2 div {RUN * TOPIC_PARTITIONS}") * RUN + event % RUN
    return messages.select(
        "key",
        "value",
        F.when(copy, TOPIC_PARTITIONS).otherwise(run % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.when(copy, event).otherwise(dense).cast("long").alias("offset"),
        "timestamp",
    )


def held_back() -> Column:
    """Dense offsets that come late: every seventh run of a hundred."""
    return F.expr("offset div 100") % 7 == 3


def sent_again() -> Column:
    """Dense offsets that come a second time with the late ones."""
    return F.expr("offset div 100") % 7 == 4


def lake_rows(messages: DataFrame) -> DataFrame:
    """Valid messages as lake rows, stamped some seconds after the message
    time (a deterministic stand-in for the batch clock). A redelivered copy
    (odd offset) is ingested before or after the first delivery, by its id."""
    parsed = parse_messages(messages)
    copy, overtakes = F.col("offset") % 2 == 1, F.col("offset") % 4 == 1
    delay = (
        F.when(copy & overtakes, REDELIVERY_DELAY_SECONDS).when(copy, LATE_DELIVERY_SECONDS).otherwise(INGEST_DELAY_SECONDS)
    )
    good = parsed.filter(F.col("error").isNull()).withColumn("__at", F.col("timestamp") + F.make_dt_interval(secs=delay))
    return _stamped(good)


def _stamped(good: DataFrame) -> DataFrame:
    rows = good.select(
        "event_id",
        "event_type",
        "event_timestamp",
        "payload",
        F.col("partition").cast("int").alias("kafka_partition"),
        F.col("offset").cast("long").alias("kafka_offset"),
        "__at",
    )
    return stamp(rows, F.col("__at")).drop("__at")


def raw_events(events: DataFrame) -> DataFrame:
    """The raw events table as the loader would produce it from the lake."""
    return load_projection(lake_rows(topic_messages(events)), source_file=F.lit(None).cast("string"))


def product_snapshots(part: DataFrame) -> DataFrame:
    """Two catalog snapshots of every part: the current price on
    ``CURRENT_SNAPSHOT`` and one dollar more on ``PREVIOUS_SNAPSHOT``."""
    price = F.col("p_retailprice").cast("decimal(10,2)")
    base = part.select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        price.alias("unit_price"),
    )
    current = base.withColumn("snapshot_date", F.lit(CURRENT_SNAPSHOT))
    previous = base.withColumns(
        {"unit_price": (F.col("unit_price") + F.lit(1)).cast("decimal(10,2)"), "snapshot_date": F.lit(PREVIOUS_SNAPSHOT)}
    )
    return current.unionByName(previous)


def customer_snapshots(customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Two catalog snapshots of every customer, country from its nation; in
    the older one every customer lives in another city, and customers whose
    number divides by 10 are only in that one."""
    joined = customer.join(nation, customer["c_nationkey"] == nation["n_nationkey"], "left")
    number = F.col("c_custkey")
    base = joined.select(
        number.cast("string").alias("customer_id"),
        F.col("c_name").alias("full_name"),
        F.concat(F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("."))), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("City "), (number % CITIES).cast("string")).alias("city"),
        F.col("n_name").alias("country"),
        F.date_add(F.lit(FIRST_SIGNUP), (number % SIGNUP_DAYS).cast("int")).alias("signup_date"),
        F.explode(F.when(number % 10 == 0, F.array(F.lit(PREVIOUS_SNAPSHOT))).otherwise(F.array(F.lit(PREVIOUS_SNAPSHOT), F.lit(CURRENT_SNAPSHOT)))).alias("snapshot_date"),
    )
    older = F.col("snapshot_date") == F.lit(PREVIOUS_SNAPSHOT)
    return base.withColumn("city", F.when(older, F.concat(F.lit("Old "), F.col("city"))).otherwise(F.col("city")))


# Stand-in rules for the older per-type channel: event type -> v1 type.
LEGACY_TYPE_OF = {"view": "page_view", "click": "page_view", "purchase": "purchase"}
LEGACY_OTHER_TYPE = "inventory_update"
LEGACY_REFUND_K = 53  # purchases of this product come under a type no table is loaded from
LEGACY_NO_KEY_K = 59  # message without a key
LEGACY_BROKEN_K = 67  # value cut short


def legacy_messages(events: DataFrame) -> DataFrame:
    """v1-shaped messages (key = v1 event type, flat JSON value) from every
    ``events`` row: views and clicks are page views, purchases purchases,
    everything else an inventory update; some have an unknown type, no key,
    or a value that is not JSON."""
    k = F.get_json_object(F.col("props"), "$.k").cast("int")
    known_type = F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for kv in LEGACY_TYPE_OF.items() for x in kv]), F.col("event_type")),
        F.lit(LEGACY_OTHER_TYPE),
    )
    v1_type = F.when((known_type == "purchase") & (k == LEGACY_REFUND_K), F.lit("refund")).otherwise(known_type)
    e = ensure_parallelism(events).select(
        F.col("event_id").cast("string").alias("event_id"),
        v1_type.alias("event_type"),
        F.date_format(F.col("ts"), ISO_TEXT).alias("event_timestamp"),
        F.col("user_id").cast("string").alias("customer_id"),
        k.cast("string").alias("product_id"),
        (k % 3 + 1).cast("int").alias("quantity"),
        F.col("user_id").alias("user_id"),
        k.alias("k"),
        F.col("ts").cast("timestamp").alias("timestamp"),
    )
    record = F.when(
        F.col("event_type") == "inventory_update",
        F.struct("event_id", "event_type", "event_timestamp", "product_id", (-F.col("quantity")).alias("quantity_change")),
    )
    flat = F.when(F.col("event_type").isin("purchase", "refund"), F.to_json(F.struct("event_id", "event_type", "event_timestamp", "customer_id", "product_id", "quantity"))).when(
        F.col("event_type") == "page_view", F.to_json(F.struct("event_id", "event_type", "event_timestamp", "customer_id", "product_id"))
    ).otherwise(F.to_json(record))
    text = F.when(F.col("k") == LEGACY_BROKEN_K, F.substring(flat, 1, TRUNCATE_AT)).otherwise(flat)
    return e.select(
        F.when(F.col("k") == LEGACY_NO_KEY_K, F.lit(None).cast("string")).otherwise(F.col("event_type")).alias("key"),
        text.cast("binary").alias("value"),
        (F.col("user_id") % TOPIC_PARTITIONS).cast("int").alias("partition"),
        F.col("event_id").cast("long").alias("offset"),
        "timestamp",
    )
