import datetime as dt
import json

from pyspark.sql import types as T

MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
    ]
)

TS = "2026-09-01T10:00:00.000000+00:00"


def event(eid, etype="order", ts=TS, **payload):
    return json.dumps({"event_id": eid, "event_type": etype, "event_timestamp": ts, "payload": payload})


def order(eid, oid, customer="C1", product="P1", qty=1, price=10.0, total=None, status="completed", ts=TS):
    total = round(qty * price, 2) if total is None else total
    return event(
        eid,
        "order",
        ts,
        order_id=oid,
        customer_id=customer,
        product_id=product,
        quantity=qty,
        unit_price=price,
        total_amount=total,
        payment_method="card",
        order_status=status,
    )


def message_rows(values, start_offset=0, partition=0, key=None):
    now = dt.datetime(2026, 9, 1, 10, 0)
    return [
        (key, None if v is None else v.encode(), partition, start_offset + i, now) for i, v in enumerate(values)
    ]


def land(spark, rows, path):
    """Append messages as one parquet file into a landed-topic folder."""
    spark.createDataFrame(rows, MESSAGE_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path):
    return spark.readStream.schema(MESSAGE_SCHEMA).parquet(path)
