"""The incremental lake profile against the full one."""

import os
import random

from evstar.operators.profiling import lake_summary, rows_per_type
from evstar.sources.lake import LAKE_SCHEMA, read_lake
from evstar.streaming.compact import compact_lake
from evstar.streaming.profile_state import LakeProfile


def append(spark, rows, lake):
    spark.createDataFrame(rows, LAKE_SCHEMA).repartition(2).write.mode("append").partitionBy("ingest_date", "ingest_hour").parquet(lake)


def row(event, kind, hour, offset):
    return (event, kind, "2026-09-01T10:00:00+00:00", "{}", 0, offset, "2026-09-01T10:00:00+00:00", "2026-09-01", hour)


def check(spark, lake, profile):
    lake_rows = read_lake(spark, lake)
    assert tuple(profile.summary().first()) == tuple(lake_summary(lake_rows).first())
    assert sorted(map(tuple, profile.per_type().collect()), key=str) == sorted(map(tuple, rows_per_type(lake_rows).collect()), key=str)


def test_profile_follows_the_lake(spark, tmp):
    rng, lake = random.Random(6), f"{tmp}/lake"
    profile = LakeProfile(spark, lake, f"{tmp}/state", buckets=4)
    assert profile.refresh() == 0 and tuple(profile.summary().first()) == (0, 0, 0)
    draw = lambda hours, n: [row(rng.choice([None, *(f"e{i}" for i in range(40))]), rng.choice(["order", "view", None]), rng.choice(hours), rng.randrange(999)) for _ in range(n)]
    append(spark, draw(["08", "09"], 50), lake)
    assert profile.refresh() == 2
    check(spark, lake, profile)
    append(spark, draw(["09"], 10), lake)  # more in an hour that was read
    append(spark, draw(["10"], 30), lake)
    assert profile.refresh() == 2 and profile.refresh() == 0
    check(spark, lake, profile)
    compact_lake(spark, lake, f"{tmp}/journal")
    profile.refresh()  # other files, the same rows
    check(spark, lake, profile)


def test_only_changed_hours_are_opened(spark, tmp):
    lake = f"{tmp}/lake"
    append(spark, [row("a", "order", "08", 1)], lake)
    profile = LakeProfile(spark, lake, f"{tmp}/state", buckets=2)
    profile.refresh()
    folder = f"{lake}/ingest_date=2026-09-01/ingest_hour=08"
    for n in os.listdir(folder):
        if n.endswith(".crc"):
            os.remove(f"{folder}/{n}")
        else:
            size = os.path.getsize(f"{folder}/{n}")
            with open(f"{folder}/{n}", "wb") as f:
                f.write(b"x" * size)
    append(spark, [row("b", "view", "09", 2), row("a", "view", "09", 3)], lake)
    assert profile.refresh() == 1
    assert tuple(profile.summary().first()) == (3, 2, 1)
