import os

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from evstar.plans import stg_orders
from evstar.sources.lake import LAKE_SCHEMA, read_dead_letters, read_lake
from evstar.streaming import ingest, load_raw
from evstar.streaming.load import read_raw_events
from helpers import land, message_rows, order, stream


def run_ingest(spark, topic, root, checkpoint="ingest"):
    q = ingest(stream(spark, topic), f"{root}/lake", f"{root}/dlq", f"{root}/_ck/{checkpoint}")
    q.awaitTermination()


def test_ingest_load_dedup_and_replay(spark, tmp):
    topic = f"{tmp}/topic"
    first = [order("e1", "O1"), order("e2", "O2"), "oops", None, order("e3", "O3")]
    land(spark, message_rows(first), topic)
    run_ingest(spark, topic, tmp)

    lake = read_lake(spark, f"{tmp}/lake")
    assert lake.count() == 3
    parts = [d for d in os.listdir(f"{tmp}/lake") if d.startswith("ingest_date=")]
    assert len(parts) == 1 and len(parts[0]) == len("ingest_date=2026-09-01")
    assert dict(lake.dtypes)["ingest_hour"] == "string"
    dlq = read_dead_letters(spark, f"{tmp}/dlq").orderBy("offset").collect()
    assert [(r.offset, r.error) for r in dlq] == [(2, "invalid JSON"), (3, "empty message")]

    # new file: one new order and a re-delivery of e1 at the next offset
    land(spark, message_rows([order("e4", "O4"), order("e1", "O1")], start_offset=5), topic)
    run_ingest(spark, topic, tmp)
    assert read_lake(spark, f"{tmp}/lake").count() == 5

    table, ck = f"{tmp}/raw", f"{tmp}/_ck/load"
    assert load_raw(spark, f"{tmp}/lake", table, ck) == 5
    assert load_raw(spark, f"{tmp}/lake", table, ck) == 0
    raw = read_raw_events(spark, table)
    assert dict(raw.dtypes)["payload"] == "variant"
    assert raw.filter(F.col("source_file").contains("ingest_date=")).count() == 5

    stg = stg_orders(raw)
    before = sorted((r.event_id, r.order_id, str(r.ingested_at)) for r in stg.collect())
    assert [b[0] for b in before] == ["e1", "e2", "e3", "e4"]
    e1 = stg.filter("event_id = 'e1'").first()
    assert e1 is not None

    # crash replay: the whole topic is consumed again from a lost checkpoint
    run_ingest(spark, topic, tmp, checkpoint="ingest-replayed")
    assert load_raw(spark, f"{tmp}/lake", table, ck) == 5
    after = sorted((r.event_id, r.order_id, str(r.ingested_at)) for r in stg_orders(read_raw_events(spark, table)).collect())
    assert after == before
    assert read_dead_letters(spark, f"{tmp}/dlq").count() == 4
    assert read_dead_letters(spark, f"{tmp}/dlq", one_per_message=True).count() == 2


def test_load_aborts_on_bad_payload(spark, tmp):
    lake = f"{tmp}/lake"
    rows = [("e1", "order", "2026-09-01T10:00:00+00:00", "{not json", 0, 1, "2026-09-01T10:00:01+00:00", "2026-09-01", "10")]
    spark.createDataFrame(rows, LAKE_SCHEMA).write.partitionBy("ingest_date", "ingest_hour").parquet(lake)
    with pytest.raises(StreamingQueryException):
        load_raw(spark, lake, f"{tmp}/raw", f"{tmp}/_ck/load")
    assert not os.path.exists(f"{tmp}/raw/_spark_metadata/0")


def test_stg_orders_casts(spark, tmp):
    topic = f"{tmp}/topic"
    msgs = [
        order("e1", "O1", qty=2.5, price=2.675, total=6.69),
        order("e2", "O2", qty=2.7, price=1, total=3),
        '{"event_id": "e3", "event_type": "order", "event_timestamp": "2026-09-01T23:30:00-05:00", "payload": {"order_id": "O3"}}',
        '{"event_id": "e4", "event_type": "click", "event_timestamp": "2026-09-01T10:00:00+00:00", "payload": {}}',
    ]
    land(spark, message_rows(msgs), topic)
    run_ingest(spark, topic, tmp)
    load_raw(spark, f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/_ck/load")
    rows = {r.event_id: r for r in stg_orders(read_raw_events(spark, f"{tmp}/raw")).collect()}
    assert set(rows) == {"e1", "e2", "e3"}
    assert rows["e1"].quantity == 3 and str(rows["e1"].unit_price) == "2.68"
    assert rows["e2"].quantity == 3
    assert rows["e3"].customer_id is None and rows["e3"].quantity is None
    assert str(rows["e3"].ordered_at) == "2026-09-02 04:30:00"


def test_files_per_batch_bounds_lake_files(spark, tmp):
    import glob

    topic = f"{tmp}/topic"
    rows = message_rows([order(f"e{i}", f"O{i}") for i in range(40)])
    spark.createDataFrame(rows, "key string, value binary, partition int, offset long, timestamp timestamp").repartition(
        6
    ).write.parquet(topic)
    q = ingest(stream(spark, topic), f"{tmp}/lake", f"{tmp}/dlq", f"{tmp}/_ck/i", files_per_batch=1)
    q.awaitTermination()
    files = glob.glob(f"{tmp}/lake/ingest_date=*/ingest_hour=*/*.parquet")
    assert len(files) == 1 and read_lake(spark, f"{tmp}/lake").count() == 40
