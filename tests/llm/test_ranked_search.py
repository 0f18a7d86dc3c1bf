"""Reversed search against a score of every document for every item."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from evstar.llm.queries import op13_ranked_search
from evstar.llm.ranked_search import Heaps, ItemIndex, ranked_search


def terms(text):
    found = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text or "")
    return ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in w) for w in found]


def plain(docs, items, top=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    n_docs, n_terms = sum(bool(c) for _, c in counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(w for _, c in counts for w in c)
    by_id = {}
    for i, t in items:
        by_id.setdefault(i, set()).update(terms(t))
    out = set()
    for item, wanted in by_id.items():
        scored = []
        for doc_id, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms if n_terms else 0
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * (10**9 * c[w] // (1000 * c[w] + 8 * m)) for w in wanted if c[w])
            if score > 0:
                scored.append((-score, doc_id is None, doc_id))
        scored.sort(key=lambda s: (s[0], s[1], s[2] or 0))
        out |= {(item, k, d, -s) for k, (s, _, d) in enumerate(scored[:top], 1)}
    return out


def got(df):
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_whole_tables_against_every_score(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    result = op13_ranked_search(spark, SF_SMALL)
    assert result.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert got(result) == plain(docs, items)


def random_rows(seed, n, null_ids=True):
    rng = random.Random(seed)
    return [
        (None if null_ids and rng.random() < 0.1 else rng.randrange(n), rng.choice([None, "", " ".join(rng.choices(["A", "b", "Cc", "é", "x-y", "9"], k=rng.randrange(30)))]))
        for _ in range(n)
    ]


@pytest.mark.parametrize("block_chars", [8_000_000, 60])
def test_nulls_ties_repeats_and_blocks_of_items(spark, block_chars):
    docs, items = random_rows(1, 90), random_rows(2, 12)
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(5).withColumn("n", F.lit("x")).withColumn("terms", F.lit("x"))
    i = spark.createDataFrame(items, "item_id long, text string").withColumn("item", F.lit("x")).withColumn("rank", F.lit(0))
    ranked = [tuple(r) for r in ranked_search(d, i, block_chars=block_chars).collect()]
    want = plain(docs, items)
    assert sorted(map(str, ranked)) == sorted(map(str, want))
    assert len({(r[0], r[1]) for r in ranked}) == len(ranked)


def test_many_equal_documents(spark):
    docs = [(i, "alpha beta beta") for i in range(500)] + [(1000 + i, "gamma delta") for i in range(3000)]
    items = [(1, "beta"), (2, "alpha gamma"), (3, "nothing")]
    got_rows = got(ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(7), spark.createDataFrame(items, "item_id long, text string")))
    assert got_rows == plain(docs, items)
    assert sorted(r[2] for r in got_rows if r[0] == 1) == list(range(10))


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    items = some.withColumnRenamed("doc_id", "item_id")
    assert ranked_search(none, items).collect() == []
    assert ranked_search(some, items.limit(0)).collect() == []
    assert ranked_search(spark.createDataFrame([(1, None), (2, "...")], some.schema), items).collect() == []


def test_heaps_and_index():
    rng = np.random.default_rng(0)
    heaps, seen = Heaps(3, 4), []
    for _ in range(300):
        doc_id, scores = (None if rng.random() < 0.1 else int(rng.integers(0, 40))), rng.integers(0, 6, 3)
        heaps.update(scores, doc_id)
        seen.append((doc_id, scores))
    for item in range(3):
        want = sorted(((-int(s[item]), d is None, d or 0) for d, s in seen if s[item] > 0))[:4]
        assert sorted((-s, d is None, d or 0) for i, d, s in heaps.rows() if i == item) == want
    index = ItemIndex([{b"a", b"b"}, set(), {b"b"}])
    assert index.scores(np.array([0, 1]), np.array([5, 7])).tolist() == [12, 0, 7]
    assert index.scores(np.array([], np.int64), np.array([], np.int64)).tolist() == [0, 0, 0]
