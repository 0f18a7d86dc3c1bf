"""The order fact kept up to date: only buckets with new orders, or with
orders whose customer or product has come since, are built again.

The fact lies in the hash buckets of the staged orders
(:mod:`evstar.streaming.stage`), so the orders of a bucket make exactly that
bucket of the fact. Orders whose customer or product has no dimension row yet
have a NULL key and wait in a side table of their natural ids, bucketed
alike. A refresh joins the waiting ids with the dimensions: a match names a
bucket to build again, and the rest of the fact is not read. The result
equals ``fact_orders`` over all staged orders and the dimensions of today.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.calendar import date_key
from ..operators.joins import lookup
from ..storage import Folders
from ..streaming.keyed import BUCKET, KeyedTable
from ..streaming.stage import staged_table
from .staging import checked_orders

#: Columns of the fact as readers see it.
FACT_COLUMNS = [
    "order_id",
    "customer_key",
    "product_key",
    "order_date_key",
    "ordered_at",
    "quantity",
    "unit_price",
    "total_amount",
    "payment_method",
    "order_status",
]
FACT_SCHEMA = T.StructType(
    [
        T.StructField("event_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_key", T.StringType()),
        T.StructField("product_key", T.StringType()),
        T.StructField("order_date_key", T.IntegerType()),
        T.StructField("ordered_at", T.TimestampType()),
        T.StructField("quantity", T.IntegerType()),
        T.StructField("unit_price", T.DecimalType(10, 2)),
        T.StructField("total_amount", T.DecimalType(10, 2)),
        T.StructField("payment_method", T.StringType()),
        T.StructField("order_status", T.StringType()),
    ]
)
#: A dimension's name, the natural id, and the key it gives.
DIMENSIONS = [("customer", "customer_id", "customer_key"), ("product", "product_id", "product_key")]
WAITING_SCHEMA = T.StructType(
    [T.StructField("event_id", T.StringType()), T.StructField("dimension", T.StringType()), T.StructField("natural_id", T.StringType())]
)
_DONE = "staged_version int"


def fact_table(spark: SparkSession, root: str, buckets: int) -> KeyedTable:
    return KeyedTable(spark, f"{root}/fact", FACT_SCHEMA, "event_id", buckets=buckets)


def waiting_table(spark: SparkSession, root: str, buckets: int) -> KeyedTable:
    """Natural ids without a dimension row, one row per order and dimension."""
    return KeyedTable(spark, f"{root}/waiting", WAITING_SCHEMA, "event_id", buckets=buckets)


def _last_staged(spark: SparkSession, root: str) -> int:
    if not Folders(spark).exists(f"{root}/done/_SUCCESS"):
        return 0
    return spark.read.schema(_DONE).parquet(f"{root}/done").agg(F.max("staged_version")).first()[0] or 0


def buckets_to_build(
    staged: KeyedTable, waiting: KeyedTable, since: int, dim_customers: DataFrame, dim_products: DataFrame
) -> tuple[list[int], list[int]]:
    """Buckets with orders staged after version ``since``, and buckets with
    a waiting id that has a dimension row now."""
    found = []
    for (name, natural_id, _), dim in zip(DIMENSIONS, (dim_customers, dim_products)):
        ids = waiting.read().filter(F.col("dimension") == name).groupBy("natural_id", BUCKET).agg(F.count(F.lit(1)).alias("n"))
        found.append(ids.join(dim.select(F.col(natural_id).alias("natural_id")), "natural_id", "left_semi").select(BUCKET))
    arrived = {r[BUCKET] for r in found[0].union(found[1]).distinct().collect()}  # at most all buckets
    return staged.touched_since(since), sorted(arrived)


def refresh_fact(
    spark: SparkSession, staged_root: str, root: str, dim_customers: DataFrame, dim_products: DataFrame
) -> list[int]:
    """Bring the fact up to date with the staged orders and the dimensions;
    the buckets that were built.

    Breaking off at any point is harmless: the side table is rewritten after
    the fact, and the staged version is noted last, so the next refresh
    finds the same buckets again.
    """
    staged = staged_table(spark, staged_root)
    fact, waiting = fact_table(spark, root, staged.buckets), waiting_table(spark, root, staged.buckets)
    if fact.buckets != staged.buckets:
        raise ValueError("the fact was built over another number of buckets")
    version = staged.version()
    new, arrived = buckets_to_build(staged, waiting, _last_staged(spark, root), dim_customers, dim_products)
    buckets = sorted(set(new) | set(arrived))
    if buckets:
        orders = staged.with_bucket(checked_orders(staged.read(buckets)))
        joined = lookup(lookup(orders, dim_customers, "customer_id", ["customer_key"]), dim_products, "product_id", ["product_key"])
        built = joined.withColumn("order_date_key", date_key("ordered_at"))
        fact.rewrite(built, buckets)
        ids = F.array(
            *[
                F.when(F.col(key).isNull() & F.col(natural).isNotNull(), F.struct(F.lit(name).alias("dimension"), F.col(natural).alias("natural_id")))
                for name, natural, key in DIMENSIONS
            ]
        )
        waiting.rewrite(fact.read(buckets).select("event_id", BUCKET, F.inline(F.array_compact(ids))), buckets)
    if version:
        spark.createDataFrame([(version,)], _DONE).coalesce(1).write.mode("append").parquet(f"{root}/done")
    return buckets


def read_fact(spark: SparkSession, root: str) -> DataFrame:
    return fact_table(spark, root, 1).read().select(*FACT_COLUMNS)
