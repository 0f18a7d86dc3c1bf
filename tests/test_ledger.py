"""Loading by offsets, merging lake files, and intervals against sets."""

import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import evstar.streaming.ledger as ledger_module
from evstar.sources.lake import LAKE_SCHEMA, read_lake
from evstar.streaming.compact import compact_lake, lake_files, packed
from evstar.streaming.ledger import INTERVALS, Ledger, merged_intervals, not_covered, offset_intervals


def lake_row(partition, offset, hour="10", at=1, event=None):
    stamp = f"2026-09-01T10:00:{at:02d}+00:00"
    return (event or f"e{partition}-{offset}", "order", stamp, '{"a": 1}', partition, offset, stamp, "2026-09-01", hour)


def append(spark, rows, lake, files=1):
    df = spark.createDataFrame(rows, LAKE_SCHEMA).repartition(files)
    df.write.mode("append").partitionBy("ingest_date", "ingest_hour").parquet(lake)


def new_ledger(spark, tmp):
    return Ledger(spark, f"{tmp}/lake", f"{tmp}/raw", f"{tmp}/ledger")


def loaded(ledger):
    return sorted((r.kafka_partition, r.kafka_offset) for r in ledger.read().collect())


@pytest.mark.parametrize("chunk", [4, 7, 1 << 20])
def test_intervals_against_sets(spark, monkeypatch, chunk):
    monkeypatch.setattr(ledger_module, "CHUNK", chunk)
    rng = random.Random(chunk)
    offsets = [(rng.randrange(3), rng.randrange(60)) for _ in range(110)]
    offsets += [(5, o) for o in range(8, 40)]  # one run over many chunks
    df = spark.createDataFrame(offsets, "kafka_partition int, kafka_offset long").repartition(3)
    got = sorted(map(tuple, offset_intervals(df).collect()))
    want = []
    for p, o in sorted(set(offsets)):
        if want and want[-1][0] == p and want[-1][2] == o - 1:
            want[-1] = (p, want[-1][1], o)
        else:
            want.append((p, o, o))
    assert got == want
    held = spark.createDataFrame(want[::2], INTERVALS)
    inside = {(p, o) for p, a, b in want[::2] for o in range(a, b + 1)}
    left = {tuple(r) for r in not_covered(df, held).collect()}
    assert left == {x for x in offsets if x not in inside}


@given(st.lists(st.tuples(st.integers(0, 1), st.integers(0, 30), st.integers(0, 9)), max_size=12))
@settings(max_examples=15, deadline=None, derandomize=True)
def test_merging_overlapping_intervals(spark, spans):
    df = spark.createDataFrame([(p, a, a + n) for p, a, n in spans], INTERVALS)
    covered = {(p, o) for p, a, n in spans for o in range(a, a + n + 1)}
    got = [tuple(r) for r in merged_intervals(df).collect()]
    assert sum(b - a + 1 for _, a, b in got) == len(covered)
    assert {(p, o) for p, a, b in got for o in range(a, b + 1)} == covered
    assert not any((p, b + 1) in covered for p, _, b in got)


def test_load_merge_load_again_and_backfill(spark, tmp):
    lake, ledger = f"{tmp}/lake", new_ledger(spark, tmp)
    assert ledger.load() == 0 and ledger.read().count() == 0
    append(spark, [lake_row(p, o) for p in (0, 1) for o in range(30) if not 10 <= o < 15], lake, files=6)
    assert ledger.load() == 50 and ledger.load() == 0
    files = lake_files(spark, lake).count()
    removed, added = compact_lake(spark, lake, f"{tmp}/journal")
    assert (removed, added) == (files, 1) and lake_files(spark, lake).count() == 1
    assert read_lake(spark, lake).count() == 50
    assert ledger.load() == 0  # other files, the same offsets
    # a gap, a copy of loaded rows, one offset twice; in an older hour
    append(spark, [lake_row(0, o, "09") for o in range(8, 15)] + [lake_row(0, 12, "09", at=5, event="later copy")], lake)
    assert ledger.load() == 5
    assert loaded(ledger) == sorted([(p, o) for p in (0, 1) for o in range(30) if p == 0 or not 10 <= o < 15])
    assert ledger.read().filter("event_id = 'later copy'").count() == 0
    assert {r.load for r in ledger.read().filter("kafka_offset = 12").collect()} == {ledger.last_load()}
    assert sorted(map(tuple, merged_intervals(ledger.intervals()).collect())) == [(0, 0, 29), (1, 0, 9), (1, 15, 29)]


def test_only_changed_hours_are_opened(spark, tmp):
    lake, ledger = f"{tmp}/lake", new_ledger(spark, tmp)
    append(spark, [lake_row(0, o, "08") for o in range(5)], lake)
    assert ledger.load() == 5
    folder = f"{lake}/ingest_date=2026-09-01/ingest_hour=08"
    for n in os.listdir(folder):  # can no longer be read, at the same size
        size = os.path.getsize(f"{folder}/{n}")
        with open(f"{folder}/{n}", "wb") as f:
            f.write(b"x" * size)
    for n in os.listdir(folder):
        if n.endswith(".crc"):
            os.remove(f"{folder}/{n}")
    append(spark, [lake_row(0, o, "09") for o in range(5, 7)], lake)
    assert ledger.load() == 2


def test_a_load_that_broke_off_is_done_again(spark, tmp):
    lake, ledger = f"{tmp}/lake", new_ledger(spark, tmp)
    append(spark, [lake_row(0, o) for o in range(4)], lake)
    spark.createDataFrame([(0, 0, 99)], INTERVALS).write.parquet(f"{tmp}/ledger/intervals/load=1")
    spark.createDataFrame([("half",)], "event_id string").write.parquet(f"{tmp}/raw/load=1")
    assert ledger.read().count() == 0
    assert ledger.load() == 4 and loaded(ledger) == [(0, o) for o in range(4)]


def test_many_loads_fold_into_one_set(spark, tmp, monkeypatch):
    monkeypatch.setattr(ledger_module, "LOADS_PER_SET", 3)
    lake, ledger = f"{tmp}/lake", new_ledger(spark, tmp)
    for k in range(5):
        append(spark, [lake_row(0, 2 * k), lake_row(0, 2 * k + 1)], lake)
        assert ledger.load() == 2
    assert ledger.load() == 0 and len(loaded(ledger)) == 10
    assert len(os.listdir(f"{tmp}/ledger/intervals")) < 5
    assert sorted(map(tuple, merged_intervals(ledger.intervals()).collect())) == [(0, 0, 9)]


def test_a_row_without_offset_stops_the_load(spark, tmp):
    append(spark, [lake_row(0, 1), lake_row(0, None)], f"{tmp}/lake")
    ledger = new_ledger(spark, tmp)
    with pytest.raises(Exception, match="without topic offset"):
        ledger.load()
    assert ledger.read().count() == 0 and ledger.last_load() == 0


def test_files_are_packed_by_hour_and_size(spark):
    sizes = [("a", 60, "1"), ("b", 30, "1"), ("c", 30, "1"), ("d", 30, "1"), ("e", 30, "1"), ("f", 30, "2"), ("g", 10, "3"), ("h", 10, "3")]
    df = spark.createDataFrame([(p, n, "d", h) for p, n, h in sizes], "path string, length long, ingest_date string, ingest_hour string")
    bins = {}
    for r in packed(df, 100).collect():
        bins.setdefault(r.bin, set()).add(r.path)
    # a is large already, f is alone; the fourth of the hour begins below the size
    assert sorted(map(sorted, bins.values())) == [["b", "c", "d", "e"], ["g", "h"]]


def test_a_merge_that_broke_off_is_finished_or_dropped(spark, tmp, monkeypatch):
    import evstar.streaming.compact as compact_module

    lake, journal = f"{tmp}/lake", f"{tmp}/journal"
    append(spark, [lake_row(0, o) for o in range(20)], lake, files=4)
    want = sorted(map(tuple, read_lake(spark, lake).select("event_id").collect()))

    def broken(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(compact_module, "_finish", broken)
    with pytest.raises(RuntimeError, match="lost"):
        compact_lake(spark, lake, journal)
    monkeypatch.undo()
    assert lake_files(spark, lake).count() == 4
    os.remove(f"{journal}/run=1/files/_SUCCESS")  # not whole: dropped, merged anew
    assert compact_lake(spark, lake, journal) == (4, 1)
    append(spark, [lake_row(0, 20)], lake)
    monkeypatch.setattr(compact_module, "_finish", broken)
    with pytest.raises(RuntimeError, match="lost"):
        compact_lake(spark, lake, journal)
    monkeypatch.undo()
    compact_lake(spark, lake, journal)  # whole: moved in first
    assert lake_files(spark, lake).count() == 1
    assert sorted(map(tuple, read_lake(spark, lake).select("event_id").collect())) == sorted([*want, ("e0-20",)])


def test_the_hour_being_written_is_left(spark, tmp):
    for hour in ("09", "10"):
        append(spark, [lake_row(0, int(hour) * 10 + o, hour) for o in range(8)], f"{tmp}/lake", files=3)
    compact_lake(spark, f"{tmp}/lake", f"{tmp}/journal", before=("2026-09-01", "10"))
    counts = {r.ingest_hour: r["count"] for r in lake_files(spark, f"{tmp}/lake").groupBy("ingest_hour").count().collect()}
    assert counts == {"09": 1, "10": 3}


def test_plan_of_the_anti_join_has_no_nested_loop(spark):
    rows = spark.range(5).select(F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"))
    plan = not_covered(rows, spark.createDataFrame([(0, 1, 2)], INTERVALS))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_a_row_meets_one_stretch_of_offsets_not_every_interval_of_its_chunk(spark):
    """Every fourth offset loaded: thousands of intervals in one chunk."""
    n = 40_000
    rows = spark.range(n, numPartitions=4).select(F.lit(0).alias("kafka_partition"), F.col("id").alias("kafka_offset"))
    held = rows.filter("kafka_offset % 4 = 0").select("kafka_partition", F.col("kafka_offset").alias("first_offset"), F.col("kafka_offset").alias("last_offset"))
    left = not_covered(rows, held)
    joins = [line for line in left._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join LeftAnti" in line]
    assert len(joins) == 1 and "first_offset" not in joins[0] and "word" in joins[0]
    assert left.filter("kafka_offset % 4 = 0").count() == 0 and left.count() == n - n // 4


def test_spans_around_the_ends_of_stretches(spark):
    spans = [(0, 0, 0), (0, 62, 65), (0, 127, 127), (0, 192, 319), (1, 63, 64), (1, 0, (1 << 20) + 5)]
    rows = [(p, o) for p in (0, 1, 2) for o in (*range(330), (1 << 20) - 1, 1 << 20, (1 << 20) + 5, (1 << 20) + 6)]
    got = not_covered(spark.createDataFrame(rows, "kafka_partition int, kafka_offset long"), spark.createDataFrame(spans, INTERVALS))
    want = [(p, o) for p, o in rows if not any(p == q and a <= o <= b for q, a, b in spans)]
    assert sorted(map(tuple, got.collect())) == sorted(want)
