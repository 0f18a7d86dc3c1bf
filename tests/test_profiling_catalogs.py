import datetime as dt
import json
import os
from decimal import Decimal

from pyspark.sql import functions as F

from evstar.operators import (
    key_affinity,
    key_summary,
    lake_files,
    lake_summary,
    latest_files,
    partition_counts,
    rows_per_type,
    schema_report,
)
from evstar.sources.catalogs import CATALOG_SCHEMAS, read_snapshots, write_snapshot


def test_lake_summary_counts_null_id_once(spark):
    df = spark.createDataFrame(
        [("a", "order"), ("a", "order"), ("b", "click"), (None, "click"), (None, "click")],
        "event_id string, event_type string",
    )
    r = lake_summary(df).first()
    assert (r.total_rows, r.distinct_event_ids, r.duplicate_rows) == (5, 3, 2)
    by_type = {x.event_type: x.n_events for x in rows_per_type(df).collect()}
    assert by_type == {"order": 2, "click": 1}


def test_topic_profile(spark):
    df = spark.createDataFrame(
        [("C1", 0), ("C1", 0), ("C2", 1), ("P7", 2), ("P7", 0), (None, 1)], "key string, partition int"
    )
    assert [(r.partition, r.n_messages) for r in partition_counts(df).collect()] == [(0, 3), (1, 2), (2, 1)]
    s = key_summary(df).first()
    assert (s.messages_without_key, s.distinct_keys) == (1, 3)
    assert [(r.key, r.partitions) for r in key_affinity(df).collect()] == [("P7", [0, 2])]


def test_lake_files_and_latest(spark, tmp):
    for hour in ("01", "02", "03", "04"):
        spark.range(3).write.parquet(f"{tmp}/lake/ingest_date=2026-09-01/ingest_hour={hour}")
    files = lake_files(spark, f"{tmp}/lake")
    n = files.count()
    assert n >= 4 and all(r.file_size > 0 for r in files.collect())
    last = latest_files(files).collect()
    assert len(last) == 3 and "ingest_hour=04" in last[0].file_path


def test_schema_report(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert [tuple(r) for r in schema_report(spark, df).collect()] == [("x", "int"), ("y", "string")]


def products(spark, price):
    return spark.createDataFrame([("P1", "Lamp", "Home", Decimal(price))], CATALOG_SCHEMAS["products"])


def test_snapshot_same_day_overwrite_keeps_other_days(spark, tmp):
    write_snapshot(products(spark, "4.00"), tmp, "products", "2026-08-01")
    write_snapshot(products(spark, "5.00"), tmp, "products", "2026-09-01")
    write_snapshot(products(spark, "6.00"), tmp, "products", "2026-09-01")
    rows = sorted((r.snapshot_date, r.unit_price) for r in read_snapshots(spark, tmp, "products").collect())
    assert rows == [(dt.date(2026, 8, 1), Decimal("4.00")), (dt.date(2026, 9, 1), Decimal("6.00"))]


def test_read_json_array_export(spark, tmp):
    folder = f"{tmp}/products/snapshot_date=2026-09-01"
    os.makedirs(folder)
    items = [
        {"product_id": "P0001", "product_name": "Red Lamp", "category": "Home", "unit_price": 12.5},
        {"product_id": "P0002", "product_name": "Blue Mug", "category": "Home", "unit_price": 3.99},
    ]
    with open(f"{folder}/products.json", "w") as f:
        json.dump(items, f, indent=2)
    rows = read_snapshots(spark, tmp, "products", json_array=True).orderBy("product_id").collect()
    assert [(r.product_id, r.unit_price, r.snapshot_date) for r in rows] == [
        ("P0001", Decimal("12.50"), dt.date(2026, 9, 1)),
        ("P0002", Decimal("3.99"), dt.date(2026, 9, 1)),
    ]


def test_ensure_parallelism_only_spreads_small_inputs(spark):
    from evstar.operators import ensure_parallelism

    one = spark.range(100).coalesce(1)
    assert ensure_parallelism(one, 4).rdd.getNumPartitions() == 4
    many = spark.range(100).repartition(6)
    assert ensure_parallelism(many, 4) is many


def test_write_snapshots_many_dates_in_one_write(spark, tmp):
    from evstar.sources.catalogs import write_snapshots

    write_snapshot(products(spark, "1.00"), tmp, "products", "2026-07-01")
    df = products(spark, "4.00").withColumn("snapshot_date", F.lit(dt.date(2026, 8, 1))).unionByName(
        products(spark, "5.00").withColumn("snapshot_date", F.lit(dt.date(2026, 9, 1)))
    )
    write_snapshots(df, tmp, "products")
    got = sorted((r.snapshot_date.isoformat(), str(r.unit_price)) for r in read_snapshots(spark, tmp, "products").collect())
    assert got == [("2026-07-01", "1.00"), ("2026-08-01", "4.00"), ("2026-09-01", "5.00")]
