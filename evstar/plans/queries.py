"""Registered queries: each takes ``(spark, sf_dir)`` and returns a DataFrame
computed from the tables in ``sf_dir`` with the package's operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import date_spine, date_spine_covering
from ..functions.keys import stable_uuid
from ..operators import dedup, profiling, quality, routing
from ..session import scratch_dir
from . import build as gate
from . import marts
from .inputs import Inputs
from .reports import revenue_by_date_nation as _revenue
from ..sources import testdata as td
from ..sources.topic import publish_frame
from ..streaming.legacy import legacy_publish_frame
from .roundtrips import (
    buffered_roundtrip,
    catalog_refresh_roundtrip,
    catalog_roundtrip,
    fact_roundtrip,
    ingest_roundtrip,
    lake_files_roundtrip,
    ledger_roundtrip,
    legacy_roundtrip,
    pipeline_roundtrip,
    profile_roundtrip,
    raw_load_roundtrip,
    staging_roundtrip,
)

Query = Callable[[SparkSession, str], DataFrame]


def q_stg_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).stg_orders


def q_dedup_keep_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = Inputs(spark, sf_dir).raw_events
    return dedup.first_delivery(raw).select("event_id", "event_type", "kafka_partition", "kafka_offset", "ingested_at")


def q_latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Inputs(spark, sf_dir).table("orders")
    return dedup.latest_version(orders, "o_custkey", "o_orderdate", tiebreak=[F.col("o_orderkey").desc()])


def q_stg_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).stg_products


def q_stg_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).stg_customers


def route_view(parsed: DataFrame) -> DataFrame:
    """Accepted and quarantined messages side by side (one row per message)."""
    ok = F.col("error").isNull()
    return parsed.select(
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("long").alias("offset"),
        F.when(ok, F.lit("accepted")).otherwise(F.lit("quarantined")).alias("status"),
        "error",
        F.when(ok, F.col("event_id")).alias("event_id"),
        F.when(ok, F.col("event_type")).alias("event_type"),
        F.when(ok, F.col("event_timestamp")).alias("event_timestamp"),
        F.when(ok, F.col("payload")).alias("payload"),
        F.when(~ok, F.make_valid_utf8(F.col("value").cast("string"))).alias("raw_value"),
    )


def q_parse_and_route(spark: SparkSession, sf_dir: str) -> DataFrame:
    return route_view(routing.parse_messages(Inputs(spark, sf_dir).messages))


def q_message_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).messages.select("partition", "offset", "key")


def q_dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).dim_customers


def q_dim_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).dim_products


def q_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = Inputs(spark, sf_dir).table("orders")
    return marts.dim_date(spine=date_spine_covering(orders, "o_orderdate"))


def q_fact_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Inputs(spark, sf_dir).fact_orders


def q_revenue_by_date_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing is stored on the way: the customer dimension is read for both
    of its joins, which costs less than writing it."""
    i = Inputs(spark, sf_dir)
    return _revenue(i.fact_orders, i.dim_customers)


def q_dq_unique_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.unique(Inputs(spark, sf_dir).table("lineitem"), "l_orderkey", "l_linenumber").rows


def q_dq_not_null_customer_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.not_null(Inputs(spark, sf_dir).fact_orders, "customer_key").rows


def q_dq_relationships_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return quality.relationships(i.stg_orders, "customer_id", i.stg_customers, "customer_id").rows


def q_dq_relationships_lineitem_part(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return quality.relationships(i.table("lineitem"), "l_partkey", i.table("part"), "p_partkey").rows


def q_dq_relationships_orders_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with no line item: the parent side (lineitem) repeats its keys."""
    i = Inputs(spark, sf_dir)
    return quality.relationships(i.table("orders"), "o_orderkey", i.table("lineitem"), "l_orderkey").rows


def q_dq_accepted_values_orderstatus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_values(Inputs(spark, sf_dir).table("orders"), "o_orderstatus", ["F", "O"]).rows


def q_dq_accepted_range_tax(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = Inputs(spark, sf_dir).table("lineitem")
    rows = quality.accepted_range(li, "l_tax", min_value=0, inclusive=False).rows
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_tax")


def q_dq_total_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.total_mismatch(Inputs(spark, sf_dir).stg_orders)


def q_dq_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks over the models, one ``(check, failures)`` row each.

    The models are first written once, those that do not need each other at
    the same time, as Parquet tables in a fresh folder under the cluster's
    shared checkpoint folder, so the 36 checks scan stored columns instead of
    re-deriving the chain.
    """
    root, i = scratch_dir(spark, "dq-summary"), Inputs(spark, sf_dir)
    raw = {"raw_events": i.raw_events, "raw_products": i.raw_products, "raw_customers": i.raw_customers}
    declared = gate.declared_models(calendar_from_orders=True)
    return gate.failures_frame(gate.CHECKS, gate.build_models(spark, raw, declared, lambda m: f"{root}/{m.name}"))


def q_profile_lake(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.lake_summary(Inputs(spark, sf_dir).lake_rows)


def q_profile_lake_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.rows_per_type(Inputs(spark, sf_dir).lake_rows)


def q_topic_partition_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.partition_counts(Inputs(spark, sf_dir).messages)


def q_topic_key_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profiling.key_summary(Inputs(spark, sf_dir).messages)


def q_topic_key_affinity(spark: SparkSession, sf_dir: str) -> DataFrame:
    aff = profiling.key_affinity(Inputs(spark, sf_dir).messages)
    return aff.select("key", F.col("partitions").cast("string").alias("partitions"))


def q_lake_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lake_files_roundtrip(spark, Inputs(spark, sf_dir).messages, scratch_dir(spark, "lake-files"))


def q_publish_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Envelopes and keys for the topic from the ``events`` table."""
    events = Inputs(spark, sf_dir).table("events")
    k = F.get_json_object("props", "$.k")
    payload = F.struct(
        F.when(F.col("event_type") != "error", F.col("user_id").cast("string")).alias("customer_id"), k.alias("product_id")
    )
    stamped = events.select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.date_format("ts", td.ISO_TEXT).alias("event_timestamp"),
        payload.alias("payload"),
    )
    return publish_frame(stamped)


def q_legacy_publish_frame(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat rows keyed by event type for the older topic (K9)."""
    events = Inputs(spark, sf_dir).table("events")
    flat = events.select(
        F.col("event_id").cast("string").alias("event_id"), "event_type", F.get_json_object("props", "$.k").alias("product_id")
    )
    return legacy_publish_frame(flat)


def q_date_spine_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fixed-range date spine (start inclusive, end exclusive) with the
    number of orders of each day (S13)."""
    orders = Inputs(spark, sf_dir).table("orders")
    spine = date_spine(spark, "1996-01-01", "1998-12-31")
    per_day = orders.groupBy(F.col("o_orderdate").cast("date").alias("date_day")).agg(F.count(F.lit(1)).alias("n"))
    return spine.join(per_day, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).cast("long").alias("n_orders"))


def q_catalog_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog_refresh_roundtrip(spark, Inputs(spark, sf_dir).table("part"), scratch_dir(spark, "catalog-refresh"))


def q_ingest_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest_roundtrip(spark, Inputs(spark, sf_dir).messages, scratch_dir(spark, "ingest"))


def q_raw_load_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_load_roundtrip(spark, Inputs(spark, sf_dir).messages, scratch_dir(spark, "load"))


def q_catalog_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return catalog_roundtrip(spark, i.table("part"), scratch_dir(spark, "catalog"))


def q_legacy_load_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Inputs(spark, sf_dir).table("events")
    return legacy_roundtrip(spark, td.legacy_messages(events), scratch_dir(spark, "legacy"))


def q_staged_orders_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return staging_roundtrip(spark, Inputs(spark, sf_dir).lake_rows, scratch_dir(spark, "stage"))


def q_pipeline_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = Inputs(spark, sf_dir)
    return pipeline_roundtrip(spark, i.messages, i.raw_products, i.raw_customers, scratch_dir(spark, "pipeline"))


def q_ledger_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger_roundtrip(spark, td.dense_offsets(Inputs(spark, sf_dir).messages), scratch_dir(spark, "ledger"))


def q_incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, root = Inputs(spark, sf_dir), scratch_dir(spark, "fact")
    customers = gate.materialize(i.dim_customers, f"{root}/dim_customers")
    products = gate.materialize(i.dim_products, f"{root}/dim_products")
    return fact_roundtrip(spark, i.lake_rows, customers, products, root)


def q_legacy_buffered(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = Inputs(spark, sf_dir).table("events")
    return buffered_roundtrip(spark, td.legacy_messages(events), scratch_dir(spark, "buffered"))


def q_order_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids derived from the row (C23), and order totals rounded to cents."""
    lines = Inputs(spark, sf_dir).table("lineitem")
    decimal = F.col("l_extendedprice").cast("decimal(18,4)") * (1 - F.col("l_discount").cast("decimal(18,4)")).cast("decimal(18,4)")
    return lines.select(
        "l_orderkey", "l_linenumber", stable_uuid("l_orderkey", "l_linenumber").alias("line_id"), F.round(decimal, 2).cast("decimal(18,2)").alias("net")
    )


def q_lake_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lake's columns and types (A10), with how many rows have a value."""
    rows = Inputs(spark, sf_dir).lake_rows
    filled = rows.agg(*[F.count(F.col(c)).alias(c) for c in rows.columns])
    counts = filled.select(F.inline(F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).alias("n_values")) for c in rows.columns])))
    return profiling.schema_report(spark, rows).join(counts, "column_name")


def q_incremental_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile_roundtrip(spark, Inputs(spark, sf_dir).messages, scratch_dir(spark, "profile"))


QUERIES: dict[str, Query] = {
    "stg_orders": q_stg_orders,
    "dedup_keep_first": q_dedup_keep_first,
    "latest_snapshot": q_latest_snapshot,
    "stg_products": q_stg_products,
    "stg_customers": q_stg_customers,
    "parse_and_route": q_parse_and_route,
    "message_key": q_message_key,
    "dim_customers": q_dim_customers,
    "dim_products": q_dim_products,
    "dim_date": q_dim_date,
    "fact_orders": q_fact_orders,
    "revenue_by_date_nation": q_revenue_by_date_nation,
    "dq_unique_lineitem": q_dq_unique_lineitem,
    "dq_not_null_customer_key": q_dq_not_null_customer_key,
    "dq_relationships_customer": q_dq_relationships_customer,
    "dq_relationships_lineitem_part": q_dq_relationships_lineitem_part,
    "dq_relationships_orders_lineitem": q_dq_relationships_orders_lineitem,
    "dq_accepted_values_orderstatus": q_dq_accepted_values_orderstatus,
    "dq_accepted_range_tax": q_dq_accepted_range_tax,
    "dq_total_matches": q_dq_total_matches,
    "dq_summary": q_dq_summary,
    "profile_lake": q_profile_lake,
    "profile_lake_by_type": q_profile_lake_by_type,
    "topic_partition_counts": q_topic_partition_counts,
    "topic_key_summary": q_topic_key_summary,
    "topic_key_affinity": q_topic_key_affinity,
    "lake_files": q_lake_files,
    "publish_frame": q_publish_frame,
    "legacy_publish_frame": q_legacy_publish_frame,
    "date_spine_orders": q_date_spine_orders,
    "catalog_refresh": q_catalog_refresh,
    "ingest_roundtrip": q_ingest_roundtrip,
    "raw_load_roundtrip": q_raw_load_roundtrip,
    "catalog_snapshot": q_catalog_snapshot,
    "legacy_load_roundtrip": q_legacy_load_roundtrip,
    "staged_orders_roundtrip": q_staged_orders_roundtrip,
    "pipeline_roundtrip": q_pipeline_roundtrip,
    "ledger_roundtrip": q_ledger_roundtrip,
    "incremental_fact": q_incremental_fact,
    "legacy_buffered": q_legacy_buffered,
    "order_ids": q_order_ids,
    "lake_schema": q_lake_schema,
    "incremental_profile": q_incremental_profile,
}
