"""The bucketed staging table and the incremental fact against full rebuilds."""

import datetime as dt
import json
import os
import random

from pyspark.sql import functions as F

from evstar.plans import stg_orders
from evstar.plans.fact_state import FACT_COLUMNS, read_fact, refresh_fact, waiting_table
from evstar.plans.marts import fact_orders
from evstar.plans.roundtrips import fact_roundtrip
from evstar.functions.keys import surrogate_key
from evstar.sources.lake import RAW_EVENTS_SCHEMA
from evstar.streaming.keyed import BUCKET
from evstar.streaming.stage import read_staged_orders, stage_batch, staged_table

PLAIN = RAW_EVENTS_SCHEMA.simpleString().replace("variant", "string")


def raw(spark, rows):
    return spark.createDataFrame(rows, PLAIN).withColumn("payload", F.parse_json("payload"))


def raw_row(event_id, offset, minute=0, customer="C1", product="P1", status="completed"):
    at = dt.datetime(2026, 9, 1, 10, minute)
    payload = {"order_id": f"O{event_id}", "customer_id": customer, "product_id": product, "quantity": 1, "unit_price": 1.5, "order_status": status}
    return (event_id, "order", at, json.dumps(payload), 0, offset, at, None)


def rows(df):
    return sorted(tuple(str(v) for v in r) for r in df.collect())


def dims(spark, customers, products):
    c = spark.createDataFrame([(x,) for x in customers], "customer_id string").select(surrogate_key("customer_id").alias("customer_key"), "customer_id")
    p = spark.createDataFrame([(x,) for x in products], "product_id string").select(surrogate_key("product_id").alias("product_key"), "product_id")
    return c, p


def test_a_late_batch_rewrites_its_buckets_only(spark, tmp):
    first = raw(spark, [raw_row(f"e{i}", i, 5) for i in range(200)])
    stage_batch(first, 0, f"{tmp}/stg", buckets=16)
    table = staged_table(spark, f"{tmp}/stg")
    assert table.buckets == 16 and set(table.current().values()) == {1}
    late = [raw_row("e7", 900, 1, status="cancelled"), raw_row("new", 901, 9)]
    touched = {r[0] for r in table.with_bucket(raw(spark, late).select("event_id")).select(BUCKET).collect()}
    before = {d: os.path.getmtime(f"{tmp}/stg/data/version=1/{d}") for d in os.listdir(f"{tmp}/stg/data/version=1") if "=" in d}
    stage_batch(raw(spark, late), 0, f"{tmp}/stg")
    now = staged_table(spark, f"{tmp}/stg")
    assert {b for b, v in now.current().items() if v == 2} == touched and len(touched) <= 2
    assert {int(d.partition("=")[2]) for d in os.listdir(f"{tmp}/stg/data/version=2") if "=" in d} == touched
    assert all(os.path.getmtime(f"{tmp}/stg/data/version=1/{d}") == at for d, at in before.items())
    whole = first.unionByName(raw(spark, late))
    assert rows(read_staged_orders(spark, f"{tmp}/stg")) == rows(stg_orders(whole))
    assert now.read(touched).select(BUCKET).distinct().count() == len(touched)


def test_random_batches_in_any_order_equal_the_full_view(spark, tmp):
    rng = random.Random(4)
    batches = [[raw_row(rng.choice([None, *(f"e{i}" for i in range(25))]), 100 * b + k, rng.randrange(4), status=rng.choice("xyz")) for k in range(30)] for b in range(4)]
    for n, b in enumerate([*batches, batches[1]]):  # one comes again
        stage_batch(raw(spark, b).repartition(3), n, f"{tmp}/stg", buckets=8)
    assert rows(read_staged_orders(spark, f"{tmp}/stg")) == rows(stg_orders(raw(spark, sum(batches, []))))


def test_reading_needs_no_exchange(spark, tmp):
    stage_batch(raw(spark, [raw_row(f"e{i}", i) for i in range(20)]), 0, f"{tmp}/stg", buckets=4)
    plan = read_staged_orders(spark, f"{tmp}/stg")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan


def test_old_states_are_removed_and_half_written_ones_ignored(spark, tmp):
    for n in range(7):
        stage_batch(raw(spark, [raw_row("same", n, 50 - n), raw_row(f"e{n}", 100 + n)]), n, f"{tmp}/stg", buckets=4)
    table = staged_table(spark, f"{tmp}/stg")
    states = sorted(int(d.partition("=")[2]) for d in os.listdir(f"{tmp}/stg/states") if "=" in d)
    assert states == [4, 5, 6, 7] and table.version() == 7 and table.read().count() == 8
    os.makedirs(f"{tmp}/stg/states/state=8")  # broke off before it counted
    assert staged_table(spark, f"{tmp}/stg").version() == 7
    stage_batch(raw(spark, [raw_row("last", 999)]), 0, f"{tmp}/stg")
    assert staged_table(spark, f"{tmp}/stg").version() == 8 and staged_table(spark, f"{tmp}/stg").read().count() == 9


def full_fact(spark, raw_rows, customers, products):
    return fact_orders(stg_orders(raw(spark, raw_rows)), *dims(spark, customers, products))


def test_a_customer_that_comes_a_day_later(spark, tmp):
    staged, state = f"{tmp}/stg", f"{tmp}/fact"
    day1 = [raw_row(f"e{i}", i, customer=f"C{i % 10}", product=f"P{i % 4}") for i in range(80)]
    day1 += [raw_row("guest", 500, customer="nobody"), raw_row("none", 501, customer=None, product=None)]
    stage_batch(raw(spark, day1), 0, staged, buckets=8)
    some = dims(spark, [f"C{i}" for i in range(9)], ["P0", "P1", "P3"])
    assert refresh_fact(spark, staged, state, *some) == list(staged_table(spark, staged).current())
    assert rows(read_fact(spark, state)) == rows(full_fact(spark, day1, [f"C{i}" for i in range(9)], ["P0", "P1", "P3"]))
    waiting = {(r.dimension, r.natural_id) for r in waiting_table(spark, state, 8).read().collect()}
    assert waiting == {("customer", "C9"), ("customer", "nobody"), ("product", "P2")}
    assert refresh_fact(spark, staged, state, *some) == []

    # the customer and the product arrive; one more order and a better copy, too
    everyone, products = [f"C{i}" for i in range(10)], ["P0", "P1", "P2", "P3"]
    day2 = [raw_row("x", 600, customer="C3"), raw_row("e5", 601, -0, customer="C5", status="cancelled")]
    stage_batch(raw(spark, day2), 1, staged)
    refresh_fact(spark, staged, state, *dims(spark, everyone, products))
    got = read_fact(spark, state)
    assert got.columns == FACT_COLUMNS and rows(got) == rows(full_fact(spark, day1 + day2, everyone, products))
    assert {r.natural_id for r in waiting_table(spark, state, 8).read().collect()} == {"nobody"}
    assert refresh_fact(spark, staged, state, *dims(spark, everyone, products)) == []


def test_only_buckets_with_a_waiting_order_are_built(spark, tmp):
    staged, state = f"{tmp}/stg", f"{tmp}/fact"
    orders = [raw_row(f"e{i}", i) for i in range(100)] + [raw_row("late", 500, customer="C2")]
    stage_batch(raw(spark, orders), 0, staged, buckets=16)
    refresh_fact(spark, staged, state, *dims(spark, ["C1"], ["P1"]))
    bucket = staged_table(spark, staged).with_bucket(raw(spark, orders[-1:]).select("event_id")).first()[BUCKET]
    assert refresh_fact(spark, staged, state, *dims(spark, ["C1", "C2"], ["P1"])) == [bucket]
    assert rows(read_fact(spark, state)) == rows(full_fact(spark, orders, ["C1", "C2"], ["P1"]))


def test_a_refresh_that_broke_off_after_the_fact(spark, tmp, monkeypatch):
    import evstar.plans.fact_state as fact_state

    staged, state = f"{tmp}/stg", f"{tmp}/fact"
    stage_batch(raw(spark, [raw_row("e1", 1, customer="C9")]), 0, staged, buckets=4)
    real = fact_state.waiting_table

    class Broken:
        def __init__(self, table):
            self.table, self.read = table, table.read

        def rewrite(self, *_):
            raise RuntimeError("lost")

    monkeypatch.setattr(fact_state, "waiting_table", lambda *a: Broken(real(*a)))
    try:
        refresh_fact(spark, staged, state, *dims(spark, [], ["P1"]))
    except RuntimeError:
        pass
    monkeypatch.undo()
    refresh_fact(spark, staged, state, *dims(spark, ["C9"], ["P1"]))
    assert rows(read_fact(spark, state)) == rows(full_fact(spark, [raw_row("e1", 1, customer="C9")], ["C9"], ["P1"]))


def test_empty_inputs(spark, tmp):
    stage_batch(raw(spark, []), 0, f"{tmp}/stg")
    assert read_staged_orders(spark, f"{tmp}/stg").count() == 0
    assert refresh_fact(spark, f"{tmp}/stg", f"{tmp}/fact", *dims(spark, ["C1"], [])) == []
    assert read_fact(spark, f"{tmp}/fact").count() == 0


def test_both_days_are_made_in_one_pass_over_the_input(spark, tmp):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            made.add(batch.num_rows)
            yield batch

    orders = [raw_row(f"e{i}", i, i % 3, customer=f"C{i % 9}", product=f"P{i % 13}") for i in range(300)]
    orders += [raw_row("e7", 400, 1, status="cancelled"), raw_row("e8", 401, 9, status="cancelled")]
    texts = spark.createDataFrame(orders, PLAIN).select(
        "event_id", "event_type", F.col("event_timestamp").cast("string"), "payload", "kafka_partition", "kafka_offset", F.col("ingested_at").cast("string")
    )
    everyone = dims(spark, [f"C{i}" for i in range(9)], [f"P{i}" for i in range(13)])
    fact = fact_roundtrip(spark, texts.mapInArrow(counted, texts.schema), *everyone, tmp)
    assert made.value == len(orders)
    assert rows(fact) == rows(fact_orders(stg_orders(raw(spark, orders)), *everyone))


def test_a_day_without_orders(spark, tmp):
    orders = [raw_row(f"e{i}", i) for i in range(5)]  # all on the first day
    texts = spark.createDataFrame(orders, PLAIN).drop("source_file").withColumns({c: F.col(c).cast("string") for c in ("event_timestamp", "ingested_at")})
    assert fact_roundtrip(spark, texts, *dims(spark, ["C1"], ["P1"]), tmp).count() == 5
