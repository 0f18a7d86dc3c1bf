"""Star-schema marts (M4-M7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.calendar import calendar_columns, date_key, date_spine
from ..functions.keys import surrogate_key
from ..operators.joins import lookup

# The calendar range of the date dimension (start inclusive,
# end exclusive).
DEFAULT_CALENDAR = ("2025-01-01", "2028-01-01")


def dim_customers(stg_customers: DataFrame) -> DataFrame:
    """Type-1 customer dimension with a hashed surrogate key (M4)."""
    return stg_customers.select(
        surrogate_key("customer_id").alias("customer_key"),
        "customer_id",
        "full_name",
        "email",
        "city",
        "country",
        "signup_date",
    )


def dim_products(stg_products: DataFrame) -> DataFrame:
    """Type-1 product dimension (M5); the catalog price becomes ``list_price``."""
    return stg_products.select(
        surrogate_key("product_id").alias("product_key"),
        "product_id",
        "product_name",
        "category",
        F.col("unit_price").alias("list_price"),
    )


def dim_date(
    spark: SparkSession | None = None,
    start: str | dt.date = DEFAULT_CALENDAR[0],
    end: str | dt.date = DEFAULT_CALENDAR[1],
    spine: DataFrame | None = None,
) -> DataFrame:
    """Calendar dimension, one row per day (M6).

    Either a fixed ``[start, end)`` range or a ready ``spine`` of
    ``date_day`` rows (e.g. :func:`evstar.functions.date_spine_covering`).
    """
    if spine is None:
        if spark is None:
            raise ValueError("dim_date needs a session or a spine")
        spine = date_spine(spark, start, end)
    return spine.select(*calendar_columns("date_day"))


def fact_orders(stg_orders: DataFrame, dim_customers: DataFrame, dim_products: DataFrame) -> DataFrame:
    """Order fact at one row per order (M7).

    Left joins keep orders whose customer or product is unknown, with a NULL
    key; cancelled orders stay in. The date key is computed, never joined.
    """
    with_customer = lookup(stg_orders, dim_customers, "customer_id", ["customer_key"])
    with_product = lookup(with_customer, dim_products, "product_id", ["product_key"])
    return with_product.select(
        "order_id",
        "customer_key",
        "product_key",
        date_key("ordered_at").alias("order_date_key"),
        "ordered_at",
        "quantity",
        "unit_price",
        "total_amount",
        "payment_method",
        "order_status",
    )
