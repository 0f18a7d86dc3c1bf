"""Plan shape: the properties that matter at scale, checked on the physical plan."""

import pytest
from pyspark.sql import functions as F

from evstar.plans import dim_customers, dim_products, fact_orders, stg_customers, stg_orders, stg_products
from evstar.sources.catalogs import read_snapshots
from evstar.sources.lake import read_lake
from evstar.streaming import ingest, load_raw
from evstar.streaming.load import read_raw_events
from helpers import land, message_rows, order, stream
from test_pipeline import write_catalogs
from evstar.plans.pipeline import Layout


def plan(df, capsys):
    df.explain("formatted")
    return capsys.readouterr().out


@pytest.fixture(scope="module")
def deployed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("plans"))
    layout = Layout(root)
    write_catalogs(spark, layout)
    land(spark, message_rows([order("e1", "O1"), order("e2", "O2", "C2", "P2")]), f"{root}/topic")
    ingest(stream(spark, f"{root}/topic"), layout.lake, layout.dead_letter, layout.checkpoint("i")).awaitTermination()
    load_raw(spark, layout.lake, layout.raw_events, layout.checkpoint("l"))
    return layout


def test_stg_orders_pushes_type_filter_and_prunes_columns(spark, deployed, capsys):
    out = plan(stg_orders(read_raw_events(spark, deployed.raw_events)), capsys)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,order)]" in out
    read_schema = [line for line in out.splitlines() if line.startswith("ReadSchema")][0]
    assert "source_file" not in read_schema and "kafka_partition" not in read_schema
    # typed payload fields are requested from the (shredded) VARIANT, not the whole value
    assert "payload:struct<0:string" in read_schema
    assert out.count("WindowGroupLimit") >= 2  # partial top-1 before the shuffle, final after


def test_fact_orders_joins_are_left_outer_without_cartesian(spark, deployed, capsys):
    raw = read_raw_events(spark, deployed.raw_events)
    sp = stg_products(read_snapshots(spark, deployed.catalogs, "products"))
    sc = stg_customers(read_snapshots(spark, deployed.catalogs, "customers"))
    out = plan(fact_orders(stg_orders(raw), dim_customers(sc), dim_products(sp)), capsys)
    assert out.count("Join type: LeftOuter") == 2
    assert "Cartesian" not in out and "BroadcastNestedLoopJoin" not in out


def test_lake_partition_pruning(spark, deployed, capsys):
    df = read_lake(spark, deployed.lake).filter(F.col("ingest_date") == "2020-01-01")
    out = plan(df, capsys)
    assert "PartitionFilters: [isnotnull(ingest_date" in out
    assert df.count() == 0


def test_fact_orders_over_materialized_dims_broadcasts(spark, deployed, capsys, tmp_path):
    from evstar.plans.build import materialize

    raw = read_raw_events(spark, deployed.raw_events)
    dc = materialize(dim_customers(stg_customers(read_snapshots(spark, deployed.catalogs, "customers"))), f"{tmp_path}/dc")
    dp = materialize(dim_products(stg_products(read_snapshots(spark, deployed.catalogs, "products"))), f"{tmp_path}/dp")
    out = plan(fact_orders(stg_orders(raw), dc, dp), capsys)
    assert out.count("BroadcastHashJoin LeftOuter") == 2 and "SortMergeJoin" not in out


def test_flagship_aggregates_before_its_shuffle(spark, capsys):
    from conftest import SF_SMALL
    from evstar.plans.queries import q_revenue_by_date_nation

    out = plan(q_revenue_by_date_nation(spark, SF_SMALL), capsys)
    assert "partial_sum(total_amount" in out and "partial_count(1)" in out
    assert "Cartesian" not in out
