import datetime as dt
import hashlib

from evstar.functions import (
    date_key,
    date_spine,
    date_spine_covering,
    is_weekend,
    iso_day_of_week,
    message_key,
    surrogate_key,
)
from evstar.functions.keys import SURROGATE_NULL_TOKEN
from evstar.plans.marts import dim_date


def md5(s):
    return hashlib.md5(s.encode()).hexdigest()


def test_surrogate_key_single_and_null(spark):
    df = spark.createDataFrame([("C0001",), (None,)], "customer_id string")
    got = [r.k for r in df.select(surrogate_key("customer_id").alias("k")).collect()]
    assert got == [md5("C0001"), md5(SURROGATE_NULL_TOKEN)]


def test_surrogate_key_multi_column_and_types(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "x int, y string")
    got = [r.k for r in df.select(surrogate_key("x", "y").alias("k")).collect()]
    assert got == [md5("1-a"), md5(f"{SURROGATE_NULL_TOKEN}-b")]


def test_message_key_prefers_customer(spark):
    df = spark.createDataFrame(
        [("C1", "P1"), ("", "P2"), (None, "P3")], "customer_id string, product_id string"
    )
    assert [r.k for r in df.select(message_key().alias("k")).collect()] == ["C1", "P2", "P3"]


def test_date_key_and_weekday(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2026, 9, 1, 23, 30),), (dt.datetime(2024, 1, 6, 0, 0),)], "ts timestamp"
    )
    rows = df.select(
        date_key("ts").alias("k"), iso_day_of_week("ts").alias("dow"), is_weekend("ts").alias("we")
    ).collect()
    assert [(r.k, r.dow, r.we) for r in rows] == [(20260901, 2, False), (20240106, 6, True)]


def test_date_spine_end_exclusive_and_calendar(spark):
    spine = date_spine(spark, "2025-01-01", "2028-01-01")
    assert spine.count() == 1095
    d = dim_date(spark, "2025-01-01", "2025-01-08").orderBy("date_key").collect()
    assert len(d) == 7
    first = d[0]
    assert first.date_key == 20250101 and first.calendar_date == dt.date(2025, 1, 1)
    assert (first.calendar_year, first.calendar_quarter, first.calendar_month) == (2025, 1, 1)
    assert (first.month_name, first.day_name, first.day_of_week) == ("Jan", "Wed", 3)
    assert [r.is_weekend for r in d] == [False, False, False, True, True, False, False]


def test_date_spine_covering_data(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 2, 27, 5),), (dt.datetime(2024, 3, 2, 1),)], "ts timestamp"
    )
    days = [r.date_day for r in date_spine_covering(df, "ts").orderBy("date_day").collect()]
    assert days[0] == dt.date(2024, 2, 27) and days[-1] == dt.date(2024, 3, 2) and len(days) == 5


def test_calendar_columns_types(spark):
    types = dict(dim_date(spark, "2025-01-01", "2025-01-02").dtypes)
    assert types["date_key"] == "int" and types["calendar_date"] == "date"
    assert types["is_weekend"] == "boolean" and types["day_of_week"] == "int"


def test_stable_uuid_shape_and_determinism(spark):
    import re

    from evstar.functions import stable_uuid

    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2)], "x string, y int")
    ids = [r.u for r in df.select(stable_uuid("x", "y").alias("u")).collect()]
    assert all(re.fullmatch(r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}", u) for u in ids)
    assert ids[0] == ids[1] != ids[2]
    assert ids[0].replace("-", "") == md5("a-1")
