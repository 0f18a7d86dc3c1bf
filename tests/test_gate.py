"""Build gate on fault cases (FIXTURES part C) with in-memory raw tables."""

import datetime as dt
from decimal import Decimal

import pytest

from evstar.plans.build import BuildFailed, build, published_build, read_mart
from test_models import catalog, raw_events

T0 = dt.datetime(2026, 9, 1, 10, 0)


def payload(oid, cust="C1", prod="P1", status="completed"):
    return {"order_id": oid, "customer_id": cust, "product_id": prod, "quantity": 1,
            "unit_price": 5.0, "total_amount": 5.0, "order_status": status}


@pytest.fixture()
def catalogs(spark):
    products = catalog(spark, "products", [("P1", "Lamp", "Home", Decimal("5.00"), dt.date(2026, 9, 1))])
    customers = catalog(spark, "customers", [("C1", "Ann", "a@x.org", "Oslo", "Norway", None, dt.date(2026, 9, 1))])
    return products, customers


def failures(result):
    return {name: n for name, n in result.results if n}


def test_clean_build_passes(spark, tmp, catalogs):
    raw = raw_events(spark, [("e1", "order", T0, payload("O1"), 1, T0)])
    result = build(spark, raw, *catalogs, f"{tmp}/wh")
    assert failures(result) == {} and len(result.results) == 36


def test_fault_cases_are_reported(spark, tmp, catalogs):
    late = dt.datetime(2030, 1, 1, 12, 0)
    raw = raw_events(
        spark,
        [
            ("e1", "order", T0, payload("O1"), 1, T0),
            ("e2", "order", T0, payload("O1"), 2, T0),  # same order id under a second event
            ("e3", "order", late, payload("O3"), 3, T0),  # after the calendar's end
            ("e4", "order", T0, payload("O4", status="pending"), 4, T0),
            ("e5", "order", T0, {**payload("O5"), "customer_id": None}, 5, T0),
        ],
    )
    result = build(spark, raw, *catalogs, f"{tmp}/wh", fail_fast=False)
    assert failures(result) == {
        "unique:stg_orders.order_id": 1,
        "not_null:stg_orders.customer_id": 1,
        "accepted_values:stg_orders.order_status": 1,
        "not_null:fact_orders.customer_key": 1,
        "relationships:fact_orders.order_date_key": 1,
        "unique:fact_orders.order_id": 1,
    }


def test_fail_fast_stops_before_marts(spark, tmp, catalogs):
    raw = raw_events(spark, [("e1", "order", T0, payload("O1", status="pending"), 1, T0)])
    with pytest.raises(BuildFailed, match="model stg_orders: accepted_values:stg_orders.order_status"):
        build(spark, raw, *catalogs, f"{tmp}/wh")
    assert published_build(spark, f"{tmp}/wh") is None


def test_readers_keep_the_last_whole_build(spark, tmp, catalogs):
    first = build(spark, raw_events(spark, [("e1", "order", T0, payload("O1"), 1, T0)]), *catalogs, f"{tmp}/wh")
    before = read_mart(spark, f"{tmp}/wh", "fact_orders")
    bad = raw_events(spark, [("e1", "order", T0, payload("O1"), 1, T0), ("e2", "order", T0, payload("O1"), 2, T0)])
    with pytest.raises(BuildFailed):
        build(spark, bad, *catalogs, f"{tmp}/wh")
    assert published_build(spark, f"{tmp}/wh") == first.build_id
    good = raw_events(spark, [("e1", "order", T0, payload("O1"), 1, T0), ("e2", "order", T0, payload("O2"), 2, T0)])
    build(spark, good, *catalogs, f"{tmp}/wh")
    assert read_mart(spark, f"{tmp}/wh", "fact_orders").count() == 2
    assert before.count() == 1  # a reader that began earlier is not disturbed
