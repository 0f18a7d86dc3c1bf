"""Property tests: Spark expressions against plain-Python statements of the rules."""

import datetime as dt
import hashlib
import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from evstar.functions import date_key, surrogate_key
from evstar.functions.keys import SURROGATE_NULL_TOKEN
from evstar.operators import parse_messages

REQUIRED = {"event_id", "event_type", "event_timestamp", "payload"}
SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])

scalars = st.one_of(st.none(), st.booleans(), st.integers(-10**6, 10**6), st.text(max_size=8))
values = st.recursive(scalars, lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(max_size=5), inner, max_size=3), max_leaves=6)
envelopes = st.dictionaries(
    st.sampled_from(sorted(REQUIRED) + ["extra", "other"]), values, max_size=6
)
documents = st.one_of(envelopes, values)


def expected_error(doc):
    if not isinstance(doc, dict):
        return "message is not a JSON object"
    missing = REQUIRED - doc.keys()
    if missing:
        return f"missing fields: {sorted(missing)}"
    return None


complete = st.fixed_dictionaries(
    {"event_id": st.one_of(st.none(), st.text(max_size=5)), "event_type": st.text(max_size=5), "event_timestamp": st.text(max_size=5), "payload": values},
    optional={"extra": values},
)
ROUTING = settings(max_examples=12, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))


def routed(spark, texts):
    rows = [(0, i, t.encode()) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "partition int, offset long, value binary")
    out = parse_messages(df).withColumn("loads", F.schema_of_variant(F.try_parse_json("payload")))
    return {r.offset: r for r in out.collect()}


@ROUTING
@given(st.lists(st.one_of(complete, complete, documents), min_size=60, max_size=120))
def test_routing_matches_rules(spark, docs):
    got = routed(spark, [json.dumps(d) for d in docs])
    for i, d in enumerate(docs):
        assert got[i].error == expected_error(d), (d, got[i].error)
        if got[i].error is None:
            if d["event_id"] is None or isinstance(d["event_id"], str):
                assert got[i].event_id == d["event_id"]
            assert json.loads(got[i].payload) == d["payload"], d
            assert got[i].loads is not None  # what is accepted can be loaded


broken = st.builds(
    lambda d, how, tail: {"cut": json.dumps(d)[:-1], "tail": json.dumps(d) + tail, "twice": json.dumps(d) * 2, "head": tail + json.dumps(d)}[how],
    complete,
    st.sampled_from(["cut", "tail", "twice", "head"]),
    st.sampled_from(["x", " x", "}", "]", ",", " {}", '"', "] [", ", {}", '}, {"a": 1}', "]]", '"]', " null"]),
)


@ROUTING
@given(st.lists(broken, min_size=60, max_size=120))
def test_broken_texts_are_rejected(spark, texts):
    got = routed(spark, texts)
    for i, t in enumerate(texts):
        try:
            want = expected_error(json.loads(t))
        except ValueError:
            want = "invalid JSON"
        assert got[i].error == want, t


@pytest.mark.parametrize("payload", ['"hello"', '"123"', '"null"', "null", "1.5", "true", "[1, 2]", '{"b": 1, "a": {"z": [], "y": ""}}', '"{\\"a\\": 1"', '"é\\n"'])
def test_payload_text_is_the_json_it_was(spark, payload):
    text = '{"event_id": "e", "event_type": "t", "event_timestamp": "s", "payload": %s}' % payload
    r = routed(spark, [text])[0]
    assert r.error is None and json.loads(r.payload) == json.loads(payload) and r.loads is not None
    if payload.startswith("{"):
        assert list(json.loads(r.payload)) == ["b", "a"]  # key order kept


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), st.text(max_size=12)), st.one_of(st.none(), st.integers(-999, 999))), min_size=1, max_size=40))
def test_surrogate_key_matches_md5(spark, pairs):
    df = spark.createDataFrame(pairs, "a string, b int")
    got = [r.k for r in df.select(surrogate_key("a", "b").alias("k")).collect()]
    for (a, b), k in zip(pairs, got):
        parts = [SURROGATE_NULL_TOKEN if a is None else a, SURROGATE_NULL_TOKEN if b is None else str(b)]
        assert k == hashlib.md5("-".join(parts).encode()).hexdigest()


@SETTINGS
@given(st.lists(st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2200, 1, 1)), min_size=1, max_size=40))
def test_date_key_matches_calendar(spark, stamps):
    df = spark.createDataFrame([(s,) for s in stamps], "ts timestamp_ntz")
    got = [r.k for r in df.select(date_key("ts").alias("k")).collect()]
    assert got == [int(s.strftime("%Y%m%d")) for s in stamps]
