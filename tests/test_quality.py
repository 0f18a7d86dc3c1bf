from decimal import Decimal

import pytest

from evstar.operators import (
    accepted_range,
    accepted_values,
    not_null,
    relationships,
    total_mismatch,
    unique,
)


@pytest.fixture()
def orders(spark):
    return spark.createDataFrame(
        [
            ("O1", "C1", 1, "completed"),
            ("O2", "C2", 2, "cancelled"),
            ("O3", None, 3, None),
        ],
        "order_id string, customer_id string, quantity int, order_status string",
    )


def test_unique_both_ways(spark, orders):
    assert unique(orders, "order_id").failures() == 0
    dup = orders.unionByName(orders.filter("order_id = 'O1'"))
    rows = unique(dup, "order_id").rows.collect()
    assert [(r.order_id, r.n_records) for r in rows] == [("O1", 2)]
    # NULL values are not duplicates
    nulls = spark.createDataFrame([(None,), (None,)], "k string")
    assert unique(nulls, "k").failures() == 0


def test_unique_composite(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (1, 2), (None, 2), (None, 2)], "a int, b int")
    assert unique(df, "a", "b").failures() == 1


def test_not_null_both_ways(orders):
    assert not_null(orders, "order_id").failures() == 0
    assert not_null(orders, "customer_id").failures() == 1


def test_relationships_both_ways(spark, orders):
    customers = spark.createDataFrame([("C1",), ("C2",)], "customer_id string")
    assert relationships(orders, "customer_id", customers, "customer_id").failures() == 0
    orphan = orders.unionByName(spark.createDataFrame([("O4", "C9", 1, "completed")] * 2, orders.schema))
    v = relationships(orphan, "customer_id", customers, "customer_id")
    assert v.failures() == 2
    assert [(r.customer_id, r.n_records) for r in v.rows.collect()] == [("C9", 2)]


def test_accepted_values_both_ways(spark, orders):
    allowed = ["completed", "cancelled"]
    assert accepted_values(orders, "order_status", allowed).failures() == 0
    pending = orders.unionByName(spark.createDataFrame([("O9", "C1", 1, "pending")], orders.schema))
    v = accepted_values(pending, "order_status", allowed)
    assert v.failures() == 1 and v.rows.first().order_status == "pending"


def test_accepted_range_both_ways(spark):
    df = spark.createDataFrame([(1, Decimal("0.00")), (None, None)], "quantity int, price decimal(10,2)")
    assert accepted_range(df, "quantity", min_value=1).failures() == 0
    assert accepted_range(df, "price", min_value=0).failures() == 0
    assert accepted_range(df, "price", min_value=0, inclusive=False).failures() == 1
    zero = spark.createDataFrame([(0, Decimal("1.00"))], df.schema)
    assert accepted_range(zero, "quantity", min_value=1).failures() == 1
    assert accepted_range(df, "quantity", min_value=0, max_value=0).failures() == 1
    with pytest.raises(ValueError):
        accepted_range(df, "quantity")


def test_total_mismatch_tolerance(spark):
    df = spark.createDataFrame(
        [
            ("ok", 2, Decimal("2.50"), Decimal("5.00")),
            ("off_by_001", 2, Decimal("2.50"), Decimal("5.01")),
            ("off_by_002", 2, Decimal("2.50"), Decimal("5.02")),
            ("null_total", 2, Decimal("2.50"), None),
        ],
        "order_id string, quantity int, unit_price decimal(10,2), total_amount decimal(10,2)",
    )
    assert [r.order_id for r in total_mismatch(df).collect()] == ["off_by_002"]


def test_failures_frame(spark, orders):
    row = not_null(orders, "customer_id", name="nn").failures_frame().first()
    assert (row.check, row.failures) == ("nn", 1)
