import datetime as dt
import decimal
import json

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from evstar.plans.queries import QUERIES
from evstar.sources.tables import TABLES
from evstar.sources.topic import publish_frame


def test_entry_flagship(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "country", "n_orders", "revenue"]
    assert df.count() > 0


def test_every_query_of_the_library_has_an_oracle():
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert set(QUERIES) <= set(o)


def _norm(v):
    if isinstance(v, (float, decimal.Decimal)):
        return round(float(v), 6)
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return v


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted(json.dumps([_norm(r[i]) for i in order], default=str) for r in rows)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, duck, name):
    df = entry.queries()[name](spark, SF_SMALL)
    res = duck.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in res.description]
    assert sorted(df.columns) == sorted(ocols)
    assert _rows(df.columns, df.collect()) == _rows(ocols, res.fetchall())


def test_publish_frame_envelope(spark):
    df = spark.createDataFrame(
        [("e1", "order", "2026-09-01T10:00:00+00:00", ("C1", "P1")), ("e2", "inventory_update", "t", (None, "P2"))],
        "event_id string, event_type string, event_timestamp string, payload struct<customer_id:string, product_id:string>",
    )
    rows = publish_frame(df).collect()
    assert [r.key for r in rows] == ["C1", "P2"]
    assert json.loads(rows[0].value) == {
        "event_id": "e1", "event_type": "order", "event_timestamp": "2026-09-01T10:00:00+00:00",
        "payload": {"customer_id": "C1", "product_id": "P1"},
    }


def test_topic_options_flush_rule():
    from evstar.sources.topic import FLUSH_DELAY, FLUSH_ROWS, topic_options

    opts = topic_options("b:9092", flush_rows=FLUSH_ROWS, flush_delay=FLUSH_DELAY, max_rows_per_batch=10**7)
    assert opts["maxOffsetsPerTrigger"] == "10000000"
    assert opts["minOffsetsPerTrigger"] == "200" and opts["maxTriggerDelay"] == "30s"
    assert opts["startingOffsets"] == "earliest" and opts["subscribe"] == "ecommerce-events"


def test_publish_frame_derives_missing_ids(spark):
    df = spark.createDataFrame(
        [("order", "2026-09-01T10:00:00+00:00", ("C1", "P1"))],
        "event_type string, event_timestamp string, payload struct<customer_id:string, product_id:string>",
    )
    first = json.loads(publish_frame(df).first().value)["event_id"]
    again = json.loads(publish_frame(df).first().value)["event_id"]
    assert first == again and len(first) == 36
