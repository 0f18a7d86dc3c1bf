import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from evstar.operators import not_null, unique
from evstar.plans import (
    dim_customers,
    dim_products,
    fact_orders,
    my_first_model,
    my_second_model,
    stg_customers,
    stg_orders,
    stg_products,
)
from evstar.sources.catalogs import CATALOG_SCHEMAS
from evstar.sources.lake import RAW_EVENTS_SCHEMA

T0 = dt.datetime(2026, 9, 1, 10, 0)


def raw_events(spark, events):
    rows = [
        (eid, etype, ts, json.dumps(payload), 0, off, ing, "f")
        for eid, etype, ts, payload, off, ing in events
    ]
    schema = "event_id string, event_type string, event_timestamp timestamp, payload string, kafka_partition int, kafka_offset long, ingested_at timestamp, source_file string"
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("payload", F.parse_json("payload")).select(*[f.name for f in RAW_EVENTS_SCHEMA.fields])


def catalog(spark, name, rows):
    schema = T.StructType(CATALOG_SCHEMAS[name].fields + [T.StructField("snapshot_date", T.DateType())])
    return spark.createDataFrame(rows, schema)


@pytest.fixture()
def star(spark):
    ev = raw_events(
        spark,
        [
            ("e1", "order", T0, {"order_id": "O1", "customer_id": "C1", "product_id": "P1", "quantity": 2,
                                  "unit_price": 5.0, "total_amount": 10.0, "order_status": "completed"}, 1, T0),
            ("e2", "order", T0, {"order_id": "O2", "customer_id": "C9", "product_id": "P1", "quantity": 1,
                                  "unit_price": 5.0, "total_amount": 5.0, "order_status": "cancelled"}, 2, T0),
            ("e1", "order", T0, {"order_id": "O1", "customer_id": "C1", "product_id": "P1", "quantity": 2,
                                  "unit_price": 5.0, "total_amount": 10.0, "order_status": "completed"}, 3, T0),
            ("e3", "click", T0, {"customer_id": "C1"}, 4, T0),
        ],
    )
    products = catalog(
        spark,
        "products",
        [
            ("P1", "Lamp", "Home", Decimal("4.00"), dt.date(2026, 8, 1)),
            ("P1", "Lamp", "Home", Decimal("5.00"), dt.date(2026, 9, 1)),
        ],
    )
    customers = catalog(
        spark, "customers", [("C1", "Ann", "ann@x.org", "Oslo", "Norway", dt.date(2025, 1, 2), dt.date(2026, 9, 1))]
    )
    so, sp, sc = stg_orders(ev), stg_products(products), stg_customers(customers)
    dc, dp = dim_customers(sc), dim_products(sp)
    return so, sp, sc, dc, dp, fact_orders(so, dc, dp)


def test_staging_and_dims(star):
    so, sp, sc, dc, dp, _ = star
    assert sorted(r.event_id for r in so.collect()) == ["e1", "e2"]
    p = sp.first()
    assert p.unit_price == Decimal("5.00") and p.snapshot_date == dt.date(2026, 9, 1)
    assert dp.first().list_price == Decimal("5.00")
    assert dp.columns == ["product_key", "product_id", "product_name", "category", "list_price"]
    assert dc.columns == ["customer_key", "customer_id", "full_name", "email", "city", "country", "signup_date"]


def test_product_key_stable_across_snapshots(spark, star):
    _, _, _, _, dp, _ = star
    old = dim_products(stg_products(catalog(spark, "products", [("P1", "Lamp", "Home", Decimal("4.00"), dt.date(2026, 8, 1))])))
    assert old.first().product_key == dp.first().product_key
    assert old.first().list_price != dp.first().list_price


def test_fact_orders_unknown_customer_gets_null_key(star):
    *_, fact = star
    rows = {r.order_id: r for r in fact.collect()}
    assert set(rows) == {"O1", "O2"}
    assert rows["O1"].customer_key is not None and rows["O2"].customer_key is None
    assert rows["O1"].order_date_key == 20260901
    assert rows["O2"].order_status == "cancelled"
    assert fact.columns == [
        "order_id", "customer_key", "product_key", "order_date_key", "ordered_at",
        "quantity", "unit_price", "total_amount", "payment_method", "order_status",
    ]


def test_starter_models(spark):
    first = my_first_model(spark)
    assert sorted(first.collect(), key=lambda r: r.id is None) == [(1,), (None,)]
    assert unique(first, "id").failures() == 0
    assert not_null(first, "id").failures() == 1  # fails by design
    second = my_second_model(first)
    assert second.collect() == [(1,)]
    assert not_null(second, "id").failures() == 0 and unique(second, "id").failures() == 0


def test_cast_failure_only_counts_for_the_kept_copy(spark):
    from pyspark.errors import PySparkException

    good = {"order_id": "O1", "quantity": 2}
    bad = {"order_id": "O1", "quantity": "many"}
    later = dt.datetime(2026, 9, 1, 11, 0)
    dropped_bad = raw_events(spark, [("e1", "order", T0, good, 1, T0), ("e1", "order", T0, bad, 2, later)])
    rows = stg_orders(dropped_bad).collect()
    assert [(r.event_id, r.quantity) for r in rows] == [("e1", 2)]
    kept_bad = raw_events(spark, [("e1", "order", T0, bad, 1, T0), ("e1", "order", T0, good, 2, later)])
    with pytest.raises(PySparkException, match="payload field cannot be cast: quantity of event e1"):
        stg_orders(kept_bad).collect()
    # a string holding a number casts, JSON null and a missing field give NULL
    ok = raw_events(spark, [("e2", "order", T0, {"quantity": "3", "unit_price": None}, 1, T0)])
    r = stg_orders(ok).first()
    assert (r.quantity, r.unit_price, r.total_amount) == (3, None, None)
