"""Staging models (M1-M3): lazy DataFrames over the raw tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.dedup import first_delivery, latest_version


# (name, JSON path in the payload, SQL type) of the typed order fields;
# quantity goes through DECIMAL(38,0) so fractional input rounds.
ORDER_FIELDS = [
    ("order_id", "order_id", "string"),
    ("customer_id", "customer_id", "string"),
    ("product_id", "product_id", "string"),
    ("quantity", "quantity", "decimal(38,0)"),
    ("unit_price", "unit_price", "decimal(10,2)"),
    ("total_amount", "total_amount", "decimal(10,2)"),
    ("payment_method", "payment_method", "string"),
    ("order_status", "order_status", "string"),
]
BAD_FIELD = "__evstar_bad_field"


def _typed(path: str, type_: str) -> Column:
    return F.try_variant_get(F.col("payload"), f"$.{path}", type_)


def _uncastable(path: str, type_: str) -> Column:
    """The field is there, not JSON null, and does not cast to ``type_``."""
    raw = F.try_variant_get(F.col("payload"), f"$.{path}", "variant")
    return _typed(path, type_).isNull() & raw.isNotNull() & ~F.is_variant_null(raw)


def typed_orders(raw_events: DataFrame, order_type: str = "order") -> DataFrame:
    """Every order event with its payload fields typed (F9, F6), before the
    dedup: a missing or JSON-null field gives NULL, and a row with a value
    that does not cast names that field in ``BAD_FIELD``."""
    orders = raw_events.filter(F.col("event_type") == F.lit(order_type))
    fields = [(name, _typed(path, t)) for name, path, t in ORDER_FIELDS]
    # Only a field that came back NULL can hold an uncastable value, so rows
    # with every field present skip the probe. One projection, so the scan
    # still requests only these paths of the payload.
    any_null = F.lit(False)
    for _, value in fields:
        any_null = any_null | value.isNull()
    bad = F.when(any_null, F.coalesce(*[F.when(_uncastable(path, t), F.lit(path)) for _, path, t in ORDER_FIELDS]))
    return orders.select(
        "event_id",
        *[value.alias(name) for name, value in fields],
        F.col("event_timestamp").alias("ordered_at"),
        "ingested_at",
        "kafka_offset",
        bad.alias(BAD_FIELD),
    )


def first_orders(typed: DataFrame) -> DataFrame:
    """One row per order event, the earliest delivered copy (W1); fails if
    that copy holds a value that does not cast."""
    return checked_orders(first_delivery(typed))


def checked_orders(kept: DataFrame) -> DataFrame:
    """The columns of the staged orders from one typed row per event; fails
    if one holds a value that does not cast."""
    event = F.coalesce(F.col("event_id"), F.lit("NULL"))
    checked = kept.filter(
        F.when(
            F.col(BAD_FIELD).isNotNull(),
            F.raise_error(F.concat(F.lit("payload field cannot be cast: "), F.col(BAD_FIELD), F.lit(" of event "), event)),
        ).otherwise(F.lit(True))
    )
    return checked.select(
        "event_id",
        "order_id",
        "customer_id",
        "product_id",
        F.col("quantity").cast("int").alias("quantity"),
        "unit_price",
        "total_amount",
        "payment_method",
        "order_status",
        "ordered_at",
        "ingested_at",
    )


def stg_orders(raw_events: DataFrame, order_type: str = "order") -> DataFrame:
    """One row per order event, the earliest delivered copy (M1).

    Filter on the event type first (F9), then dedup by event_id (W1), with
    the payload fields typed (F6). The fields are read before the dedup, so
    the scan of a shredded VARIANT payload reads only these fields and the
    shuffle carries typed columns; a cast failure is raised only for the
    copy the dedup keeps, exactly as if typing came after it.
    """
    return first_orders(typed_orders(raw_events, order_type))


def stg_products(raw_products: DataFrame, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Latest snapshot of each product."""
    latest = latest_version(raw_products, "product_id", "snapshot_date", tiebreak)
    return latest.select("product_id", "product_name", "category", "unit_price", "snapshot_date")


def stg_customers(raw_customers: DataFrame, tiebreak: Sequence[Column] = ()) -> DataFrame:
    """Latest snapshot of each customer."""
    latest = latest_version(raw_customers, "customer_id", "snapshot_date", tiebreak)
    return latest.select("customer_id", "full_name", "email", "city", "country", "signup_date", "snapshot_date")
