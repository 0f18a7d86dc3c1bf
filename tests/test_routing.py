import datetime as dt

from pyspark.sql import functions as F

from evstar.operators import accepted, parse_messages, quarantined, stamp

GOOD = (
    '{"event_id": "e1", "event_type": "order", "event_timestamp": "2026-09-01T10:00:00.123456+00:00",'
    ' "payload": {"order_id": "O1", "quantity": 2, "unit_price": 2.50}, "extra": 1}'
)


def messages(spark, values):
    rows = [(i % 3, i, v if v is None or isinstance(v, (bytes, bytearray)) else v.encode()) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "partition int, offset long, value binary")


def route(spark, values):
    return {r.offset: r for r in parse_messages(messages(spark, values)).collect()}


def test_valid_event_fields_and_extra_dropped(spark):
    r = route(spark, [GOOD])[0]
    assert r.error is None
    assert (r.event_id, r.event_type, r.event_timestamp) == ("e1", "order", "2026-09-01T10:00:00.123456+00:00")
    assert r.payload == '{"order_id":"O1","quantity":2,"unit_price":2.5}'
    lake = accepted(parse_messages(messages(spark, [GOOD])))
    assert "extra" not in lake.columns
    assert lake.columns == ["event_id", "event_type", "event_timestamp", "payload", "kafka_partition", "kafka_offset"]


def test_fault_cases_are_quarantined_with_reason(spark):
    cases = [
        "not json",
        '[{"event_id": "e1"}]',
        '{"event_id": "e1", "event_type": "order", "event_timestamp": "t"}',
        None,
        b'\xff{"event_id": "e1"}',
        '{"event_id": "e1", "event_type": "click", "event_timestamp": "t", "payload": NaN}',
        '{"event_id": "e1", "event_id": "e2", "event_type": "x", "event_timestamp": "t", "payload": {}}',
        '{"payload": {}}',
        "null",
        '"just a string"',
    ]
    got = {o: r.error for o, r in route(spark, cases).items()}
    assert got == {
        0: "invalid JSON",
        1: "message is not a JSON object",
        2: "missing fields: ['payload']",
        3: "empty message",
        4: "invalid UTF-8",
        5: "invalid JSON",
        6: "invalid JSON",
        7: "missing fields: ['event_id', 'event_timestamp', 'event_type']",
        8: "message is not a JSON object",
        9: "message is not a JSON object",
    }


def test_required_key_with_null_value_is_accepted(spark):
    msg = '{"event_id": null, "event_type": "order", "event_timestamp": "t", "payload": null}'
    r = route(spark, [msg])[0]
    assert r.error is None and r.event_id is None and r.payload == "null"


def test_non_string_envelope_values_kept_as_text(spark):
    msg = '{"event_id": 17, "event_type": {"a": 1}, "event_timestamp": "t", "payload": [1]}'
    r = route(spark, [msg])[0]
    assert (r.event_id, r.event_type, r.payload) == ("17", '{"a":1}', "[1]")


def test_quarantine_record_shape_and_lossy_text(spark):
    bad = quarantined(parse_messages(messages(spark, [GOOD, b"\xffabc", None]))).orderBy("offset").collect()
    assert [(r.partition, r.offset, r.error) for r in bad] == [(1, 1, "invalid UTF-8"), (2, 2, "empty message")]
    assert bad[0].raw_value == "�abc" and bad[1].raw_value is None


def test_stamp_formats(spark):
    at = dt.datetime(2026, 9, 1, 3, 4, 5, 678)
    df = stamp(spark.createDataFrame([(1,)], "x int"), F.lit(at).cast("timestamp"))
    r = df.first()
    assert (r.ingested_at, r.ingest_date, r.ingest_hour) == ("2026-09-01T03:04:05.000678+00:00", "2026-09-01", "03")


def test_stamp_default_is_one_value_per_query(spark):
    df = stamp(spark.range(1000).repartition(8))
    assert df.select("ingested_at").distinct().count() == 1
