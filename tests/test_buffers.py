"""A buffer per event type: 500 rows or an age (T-2); the per-type load."""

import json
import os

import pytest
from pyspark.sql import functions as F

from evstar.sources.lake import read_dead_letters
from evstar.streaming.buffers import ROCKSDB, drain_buffers
from evstar.streaming.legacy import legacy_ingest_buffered, legacy_load, load_errors
from helpers import land, stream

STORE = "spark.sql.streaming.stateStore.providerClass"


@pytest.fixture()
def rocksdb(spark):
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKSDB)
    yield
    spark.conf.set(STORE, before)


def message(kind, i, partition=0):
    return (kind, json.dumps({"event_id": f"{kind}-{i}"}).encode(), partition, i, None)


def run(spark, tmp, rows, lanes=2, age=800):
    query = legacy_ingest_buffered(
        stream(spark, f"{tmp}/topic").filter("offset >= 0"), f"{tmp}/lake", f"{tmp}/dlq", f"{tmp}/ck", rows, age, lanes, "200 milliseconds"
    )
    drain_buffers(query, age)


def landed(spark, tmp):
    df = spark.read.parquet(f"{tmp}/lake").select("event_type", "raw_json", F.col("_metadata.file_path").alias("file"))
    return df.collect()


def test_full_buffers_and_tails_are_written(spark, tmp, rocksdb):
    rows = [message("page_view", i, i % 3) for i in range(47)] + [message("purchase", i) for i in range(10)] + [message(None, 0), ("purchase", b"{", 0, 99, None)]
    land(spark, rows[:30], f"{tmp}/topic")
    land(spark, rows[30:], f"{tmp}/topic")
    run(spark, tmp, 10)
    got = landed(spark, tmp)
    assert sorted((r.event_type, json.loads(r.raw_json)["event_id"]) for r in got) == sorted([("page_view", f"page_view-{i}") for i in range(47)] + [("purchase", f"purchase-{i}") for i in range(10)])
    sizes = {}
    for r in got:
        sizes.setdefault(r.file, []).append(r.event_type)
    assert max(map(len, sizes.values())) <= 10 and all(len(set(v)) == 1 for v in sizes.values())
    assert any(len(v) == 10 for v in sizes.values())
    assert sorted(r.offset for r in read_dead_letters(spark, f"{tmp}/dlq").collect()) == [0, 99]


def test_what_waits_survives_a_restart(spark, tmp, rocksdb):
    land(spark, [message("purchase", i) for i in range(3)], f"{tmp}/topic")
    query = legacy_ingest_buffered(stream(spark, f"{tmp}/topic"), f"{tmp}/lake", f"{tmp}/dlq", f"{tmp}/ck", 100, 600_000, 1, "200 milliseconds")
    while not any(p.numInputRows for p in query.recentProgress):
        assert query.exception() is None
        query.awaitTermination(0.2)
    query.stop()
    assert not os.path.exists(f"{tmp}/lake") or "event_type=purchase" not in os.listdir(f"{tmp}/lake")
    land(spark, [message("purchase", i) for i in range(3, 100)], f"{tmp}/topic")
    query = legacy_ingest_buffered(stream(spark, f"{tmp}/topic"), f"{tmp}/lake", f"{tmp}/dlq", f"{tmp}/ck", 100, 600_000, 1, "200 milliseconds")
    while not any(p.numInputRows for p in query.recentProgress):
        assert query.exception() is None
        query.awaitTermination(0.2)
    query.stop()
    got = landed(spark, tmp)
    assert len(got) == 100 and len({r.file for r in got}) == 1  # the hundredth row flushed them all


def test_several_bad_files_are_put_aside_in_one_load(spark, tmp):
    folder = f"{tmp}/lake/event_type=purchase/dt=d/hr=1"
    for k in range(4):
        rows = [(json.dumps({"event_id": f"{k}-{i}"}),) for i in range(50)]
        spark.createDataFrame(rows, "raw_json string").coalesce(1).write.mode("append").parquet(folder)
    good = sorted(n for n in os.listdir(folder) if n.endswith(".parquet"))
    with open(f"{folder}/{good[0]}", "r+b") as f:  # the footer is whole, a page is not
        f.seek(30)
        f.write(b"\xff" * 60)
    for n in ("junk1.parquet", "junk2.parquet"):
        with open(f"{folder}/{n}", "wb") as f:
            f.write(b"not parquet")
    for n in os.listdir(folder):
        if n.endswith(".crc"):
            os.remove(f"{folder}/{n}")
    load = lambda: legacy_load(spark, f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/_load")["purchase_events"]
    assert load() == 150
    names = sorted(r.file_path.rsplit("/", 1)[-1] for r in load_errors(spark, f"{tmp}/_load", "purchase_events").collect())
    assert names == sorted([good[0], "junk1.parquet", "junk2.parquet"])
    # a new file in an hour that is loaded already: only its rows come
    spark.createDataFrame([('{"event_id": "new"}',)], "raw_json string").coalesce(1).write.mode("append").parquet(folder)
    assert load() == 1
