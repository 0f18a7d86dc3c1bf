import datetime as dt

from pyspark.sql import functions as F

from evstar.operators import first_delivery, keep_first, latest_version

T0 = dt.datetime(2026, 9, 1, 10, 0)
T1 = dt.datetime(2026, 9, 1, 11, 0)


def test_first_delivery_earliest_ingest_then_offset(spark):
    df = spark.createDataFrame(
        [
            ("e1", T1, 1, "late copy"),
            ("e1", T0, 9, "early, higher offset"),
            ("e1", T0, 5, "early, lowest offset"),
            ("e2", None, 1, "null ingest"),
            ("e2", T1, 7, "ingested"),
            (None, T0, 1, "no id a"),
            (None, T0, 2, "no id b"),
        ],
        "event_id string, ingested_at timestamp, kafka_offset long, note string",
    )
    got = {r.event_id: r.note for r in first_delivery(df).collect()}
    assert got == {"e1": "early, lowest offset", "e2": "ingested", None: "no id a"}


def test_latest_version_newest_wins_nulls_first(spark):
    df = spark.createDataFrame(
        [
            ("P1", dt.date(2026, 1, 1), 10.0),
            ("P1", dt.date(2026, 2, 1), 12.0),
            ("P2", dt.date(2026, 2, 1), 5.0),
            ("P2", None, 6.0),
        ],
        "product_id string, snapshot_date date, unit_price double",
    )
    got = {r.product_id: r.unit_price for r in latest_version(df, "product_id").collect()}
    assert got == {"P1": 12.0, "P2": 6.0}


def test_latest_version_tiebreak(spark):
    df = spark.createDataFrame(
        [(1, dt.date(2026, 1, 1), 3), (1, dt.date(2026, 1, 1), 8), (2, dt.date(2026, 1, 1), 4)],
        "k int, snapshot_date date, o int",
    )
    got = {r.k: r.o for r in latest_version(df, "k", tiebreak=[F.col("o").desc()]).collect()}
    assert got == {1: 8, 2: 4}


def test_keep_first_plan_limits_before_shuffle(spark, capsys):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    out = keep_first(df, ["k"], [F.col("v").desc()])
    out.explain()
    plan = capsys.readouterr().out
    assert plan.count("WindowGroupLimit") == 2  # partial (map side) and final
    assert sorted(r.v for r in out.collect()) == list(range(993, 1000))


def test_hot_key_keeps_one_row(spark):
    # a third of all rows on one key
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("event_id"),
        F.col("id").alias("kafka_offset"),
        F.lit(T0).alias("ingested_at"),
    )
    out = first_delivery(df)
    assert out.count() == 2001
    assert out.filter("event_id = 'hot'").first().kafka_offset == 0


def test_merge_latest_fold_equals_full_latest(spark):
    from evstar.operators import merge_latest

    days = [dt.date(2026, 9, d) for d in (1, 2, 3)]
    snaps = [
        spark.createDataFrame([("P1", days[0], 1.0), ("P2", days[0], 2.0), ("P3", days[0], 3.0)], "product_id string, snapshot_date date, price double"),
        spark.createDataFrame([("P1", days[1], 1.5), ("P4", days[1], 4.0)], "product_id string, snapshot_date date, price double"),
        spark.createDataFrame([("P2", days[2], 2.5), ("P4", days[2], 4.5)], "product_id string, snapshot_date date, price double"),
    ]
    latest = None
    for snap in snaps:
        latest = merge_latest(latest, snap, "product_id")
    full = latest_version(snaps[0].unionByName(snaps[1]).unionByName(snaps[2]), "product_id")
    assert sorted(map(tuple, latest.collect())) == sorted(map(tuple, full.collect()))
    assert {r.product_id: r.price for r in latest.collect()} == {"P1": 1.5, "P2": 2.5, "P3": 3.0, "P4": 4.5}
