import datetime as dt
from decimal import Decimal

import pytest

from evstar.plans.build import read_mart
from evstar.plans.build import CHECKS, BuildFailed
from evstar.plans.pipeline import Layout, run_pipeline
from evstar.sources.catalogs import CATALOG_SCHEMAS, write_snapshot
from helpers import land, message_rows, order, stream


def write_catalogs(spark, layout, customers=("C1", "C2")):
    products = spark.createDataFrame(
        [("P1", "Lamp", "Home", Decimal("10.00")), ("P2", "Mug", "Home", Decimal("3.50"))], CATALOG_SCHEMAS["products"]
    )
    write_snapshot(products, layout.catalogs, "products", "2026-09-01")
    rows = [(c, f"Name {c}", f"{c.lower()}@x.org", "Oslo", "Norway", dt.date(2025, 1, 1)) for c in customers]
    write_snapshot(spark.createDataFrame(rows, CATALOG_SCHEMAS["customers"]), layout.catalogs, "customers", "2026-09-01")


def snapshot(spark, layout):
    out = {}
    for name in ("dim_customers", "dim_products", "dim_date", "fact_orders"):
        out[name] = sorted(tuple(r) for r in read_mart(spark, layout.warehouse, name).collect())
    return out


def test_pipeline_builds_and_reruns_identically(spark, tmp):
    layout = Layout(f"{tmp}/deploy")
    write_catalogs(spark, layout)
    topic = f"{tmp}/topic"
    msgs = [order("e1", "O1", "C1", "P1", 2, 10.0), order("e2", "O2", "C2", "P2", 1, 3.5), order("e1", "O1", "C1", "P1", 2, 10.0)]
    land(spark, message_rows(msgs), topic)

    result = run_pipeline(spark, stream(spark, topic), layout)
    assert len(result.results) == len(CHECKS)
    assert result.failed == []
    first = snapshot(spark, layout)
    assert len(first["fact_orders"]) == 2 and len(first["dim_date"]) == 1095

    again = run_pipeline(spark, stream(spark, topic), layout)
    assert again.failed == []
    assert snapshot(spark, layout) == first


def test_pipeline_gate_stops_on_failing_check(spark, tmp):
    layout = Layout(f"{tmp}/deploy")
    write_catalogs(spark, layout, customers=("C1",))
    topic = f"{tmp}/topic"
    land(spark, message_rows([order("e1", "O1", "C1"), order("e2", "O2", "C7")]), topic)
    with pytest.raises(BuildFailed, match="relationships:stg_orders.customer_id"):
        run_pipeline(spark, stream(spark, topic), layout)


def test_pipeline_calendar_from_orders(spark, tmp):
    layout = Layout(f"{tmp}/deploy")
    write_catalogs(spark, layout)
    topic = f"{tmp}/topic"
    msgs = [order("e1", "O1", ts="2030-05-01T01:00:00+00:00"), order("e2", "O2", ts="2030-05-03T01:00:00+00:00")]
    land(spark, message_rows(msgs), topic)
    result = run_pipeline(spark, stream(spark, topic), layout, calendar=None)
    assert result.failed == []
    assert read_mart(spark, layout.warehouse, "dim_date").count() == 3


def test_pipeline_incremental_staging_matches(spark, tmp):
    layout = Layout(f"{tmp}/deploy")
    write_catalogs(spark, layout)
    topic = f"{tmp}/topic"
    land(spark, message_rows([order("e1", "O1"), order("e1", "O1"), order("e2", "O2", "C2", "P2")]), topic)
    result = run_pipeline(spark, stream(spark, topic), layout, incremental_staging=True)
    assert result.failed == []
    fact = snapshot(spark, layout)["fact_orders"]
    assert [r[0] for r in fact] == ["O1", "O2"]


def test_pipeline_incremental_catalogs(spark, tmp):
    layout = Layout(f"{tmp}/deploy")
    write_catalogs(spark, layout)
    topic = f"{tmp}/topic"
    land(spark, message_rows([order("e1", "O1"), order("e2", "O2", "C2", "P2")]), topic)
    result = run_pipeline(spark, stream(spark, topic), layout, incremental_catalogs=True)
    assert result.failed == []
    assert len(snapshot(spark, layout)["dim_customers"]) == 2
