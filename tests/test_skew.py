"""Hot keys: one customer holding a third of the orders, and guest orders with NULL keys."""

import pytest
from pyspark.sql import functions as F

from evstar.operators import first_delivery, lookup, relationships, unique

SKEW_CONF = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.fixture()
def skew_conf(spark):
    old = {k: spark.conf.get(k, None) for k in SKEW_CONF}
    for k, v in SKEW_CONF.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def orders(spark, n=30000):
    return spark.range(n).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise((F.col("id") % 500).cast("string")).alias("customer_id"),
    )


def customers(spark):
    keys = spark.range(500).select(F.col("id").cast("string").alias("customer_id"))
    return keys.unionByName(spark.createDataFrame([("hot",)], "customer_id string")).withColumn(
        "customer_key", F.md5("customer_id")
    )


def test_hot_customer_sort_merge_join_is_split(spark, skew_conf, capsys):
    joined = lookup(orders(spark), customers(spark), "customer_id", ["customer_key"])
    rows = joined.collect()  # run this very plan, then read its final adaptive form
    assert len(rows) == 30000
    joined.explain()
    plan = capsys.readouterr().out
    assert "isFinalPlan=true" in plan
    assert "SortMergeJoin(skew=true)" in plan and "AQEShuffleRead skewed" in plan
    assert joined.filter(F.col("customer_key").isNull()).count() == 0


def test_null_keys_are_kept_by_left_lookup(spark, skew_conf):
    guests = orders(spark).withColumn(
        "customer_id", F.when(F.col("customer_id") == "hot", F.lit(None)).otherwise(F.col("customer_id"))
    )
    joined = lookup(guests, customers(spark), "customer_id", ["customer_key"])
    assert joined.count() == 30000
    assert joined.filter(F.col("customer_key").isNull()).count() == 10000


def test_grouped_checks_on_hot_key(spark):
    df = orders(spark)
    rows = unique(df, "customer_id").rows.filter("customer_id = 'hot'").collect()
    assert rows[0].n_records == 10000
    missing = relationships(df, "customer_id", customers(spark).filter("customer_id <> 'hot'"), "customer_id")
    assert missing.failures() == 10000
    dedup = first_delivery(
        df.select(
            F.col("customer_id").alias("event_id"),
            F.col("order_id").cast("long").alias("kafka_offset"),
            F.lit(None).cast("timestamp").alias("ingested_at"),
        )
    )
    assert dedup.count() == 501


def test_hot_parent_key_is_reduced_before_the_exchange(spark, skew_conf, capsys):
    """Two thirds of the parent rows share one key."""
    parents = spark.range(30000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("pk"))
    children = spark.createDataFrame([("hot",), ("hot",), ("none",), ("3",)], "ck string")
    missing = relationships(children, "ck", parents, "pk")
    assert [tuple(r) for r in missing.rows.collect()] == [("none", 1)]
    missing.rows.explain()
    plan = capsys.readouterr().out.split("LeftAnti", 1)[1]
    parent_side = plan[: plan.rindex("Range")]
    assert parent_side.rindex("HashAggregate") > parent_side.rindex("Exchange")  # partial distinct below the shuffle
