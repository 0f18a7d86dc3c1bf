"""SimHash fingerprints, bit-sliced links and groups against brute force."""

import os
import re
from itertools import combinations

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from conftest import SF_SMALL
import evstar.llm.rows as rows_module
from evstar.llm.common import passing_copies, stored
from evstar.llm.components import connected_components
from evstar.llm.rows import as_files, keep_rows, with_place
from evstar.llm.simhash import _within, bit_sliced_links, fingerprint, keep_one_row, near_links, simhash_groups, star_links


def plain_fingerprint(text, k=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.text(alphabet="aBé \n\t \x1c!x", max_size=40))
@settings(max_examples=150, deadline=None, derandomize=True)
def test_fingerprint_matches_the_definition(text):
    assert fingerprint(text) % 2**64 == plain_fingerprint(text)


def components(ids, links):
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {i: find(i) for i in ids}


def close(a, b, r=2):
    return bin((a ^ b) % 2**64).count("1") <= r


def near_values(rng, n, flips):
    base = rng.integers(0, 2**63, max(n // 5, 1)).astype(np.uint64)
    out = set()
    while len(out) < n:
        v = int(rng.choice(base))
        for b in rng.choice(64, rng.integers(0, flips + 1), replace=False):
            v ^= 1 << int(b)
        out.add(v)
    return np.array(sorted(out), np.uint64)


@pytest.mark.parametrize("radius", [1, 2, 3, 5, 7])
def test_bit_sliced_links_find_exactly_the_near_pairs(radius):
    rng = np.random.default_rng(radius)
    fps = near_values(rng, 150, radius + 2)
    bucket = np.repeat([0, 1, 2], 50)
    got = {(int(a), int(b)) for left, right in bit_sliced_links(fps, bucket, radius) for a, b in zip(left, right)}
    want = {(i, j) for i, j in combinations(range(150), 2) if bucket[i] == bucket[j] and close(int(fps[i]), int(fps[j]), radius)}
    assert got == want


def test_a_far_block_is_abandoned():
    assert _within([0b01] * 3 + [0] * 61, 1, 0b01, 2) == 0
    assert _within([0b01] * 2 + [0] * 62, 1, 0b01, 2) == 0b01


def test_star_links_keep_the_groups():
    rng = np.random.default_rng(3)
    fps = near_values(rng, 300, 3)
    a, b = star_links(fps, np.zeros(300, np.int64), 2)
    ids = [int(f) for f in fps]
    want = components(ids, [(x, y) for x, y in combinations(ids, 2) if close(x, y)])
    assert components(ids, zip(a.tolist(), b.tolist())) == want and len(a) < 300


def test_near_links_over_one_hot_bucket(spark):
    """All fingerprints share 48 bits: every table has one large bucket."""
    values = [(int(v),) for v in np.random.default_rng(1).choice(1 << 16, 400, replace=False)]
    links = near_links(spark.createDataFrame(values, "fp long")).collect()
    ids = [v for (v,) in values]
    want = components(ids, [(x, y) for x, y in combinations(ids, 2) if close(x, y)])
    assert components(ids, [tuple(r) for r in links]) == want


@pytest.mark.parametrize("shape", ["chain", "star", "mixed", "none"])
def test_connected_components(spark, shape):
    edges = {
        "chain": [(i, i + 1) for i in range(40)],
        "star": [(7, i) for i in range(60) if i != 7],
        "mixed": [(1, 2), (2, 1), (3, 3), (4, 9), (9, 5), (-8, 5), (30, 31), (31, 32), (32, 30)],
        "none": [],
    }[shape]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {x for e in edges for x in e}
    want = components(nodes, edges)
    assert got == {n: r for n, r in want.items() if n != r}


def test_groups_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = {r["doc_id"]: plain_fingerprint(r["text"]) for r in docs.collect()}
    want = components(rows, [(a, b) for a, b in combinations(rows, 2) if close(rows[a], rows[b])])
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_groups(docs).collect()}
    assert got == {i: (f"{rows[i]:016x}", want[i]) for i in rows}


def test_awkward_rows(spark):
    schema = "doc_id long, text string, fp string, component_id long, key string"
    rows = [(3, None), (2, " \n"), (5, ""), (None, "one two"), (None, "ONE TWO"), (7, "one  two"), (9, "alone here now x"), (9, "alone here now x")]
    docs = spark.createDataFrame([(i, t, "f", 1, "k") for i, t in rows], schema)
    groups = simhash_groups(docs)
    got = [(r["doc_id"], r["component_id"]) for r in groups.collect()]
    assert sorted(got, key=str) == sorted([(3, 2), (2, 2), (5, 2), (None, 7), (None, 7), (7, 7), (9, 9), (9, 9)], key=str)
    kept = keep_one_row(docs)
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 7, 9] and kept.columns == docs.columns
    assert simhash_groups(docs.limit(0)).count() == 0


def test_near_dedup_stage_keeps_one_row_of_each_group(spark):
    rows = [(9, "alone here now x")] * 5 + [(4, "some words of a first text"), (4, "quite another text with this id"), (4, "some words of a first text")]
    rows += [(None, "only null ids here")] * 3 + [(None, "a group with a number"), (7, "a group with a number"), (8, "A group with a number")]
    docs = spark.createDataFrame([(i, t, "s") for i, t in rows], "doc_id long, text string, source string")
    kept = corpus_pipeline.near_dedup_stage(spark, docs, SF_SMALL)
    assert kept.columns == docs.columns
    want = [(9, "alone here now x"), (4, "some words of a first text"), (4, "quite another text with this id"), (None, "only null ids here"), (7, "a group with a number")]
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=str) == sorted(want, key=str)
    assert corpus_pipeline.near_dedup_stage(spark, docs.limit(0), SF_SMALL).count() == 0


def test_rows_are_chosen_in_their_files_without_an_exchange(spark, tmp):
    rows = [(i % 70, f"text number {i % 50} of some more words", i, "x") for i in range(400)]
    schema = "doc_id long, text string, simhash_row long, `odd ``name` string"
    spark.createDataFrame(rows, schema).withColumn("file", F.lit("f")).withColumn("Place", F.lit(1)).repartition(5).write.parquet(f"{tmp}/docs")
    docs = spark.read.parquet(f"{tmp}/docs")
    kept = keep_one_row(docs)
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan
    got = kept.collect()
    assert kept.schema == docs.schema
    assert sorted(r["text"] for r in got) == sorted({r[1] for r in rows})
    smallest = {t: min(r[0] for r in rows if r[1] == t) for _, t, _, _ in rows}
    assert all(r["doc_id"] == smallest[r["text"]] and tuple(r)[:4] in rows for r in got)


def test_lists_of_chosen_rows(spark, tmp, monkeypatch):
    monkeypatch.setattr(rows_module, "ROWS_IN_A_LIST", 7)
    spark.range(100).repartition(3).write.parquet(f"{tmp}/n")
    docs = spark.read.parquet(f"{tmp}/n")
    placed = with_place(docs, "file", "place")
    assert sorted(r["id"] for r in keep_rows(docs, placed.filter("id % 3 = 0").drop("id")).collect()) == list(range(0, 100, 3))
    assert keep_rows(docs, placed.filter("id < 0").drop("id")).collect() == []
    assert as_files(docs) is docs and as_files(docs.filter("id > 5")) is not docs


def test_copies_go_when_nothing_reads_them(spark):
    with passing_copies(spark) as copies:
        first, second = stored(spark.range(3), "a"), stored(spark.range(4), "b")
        kept = copies.pop()
    assert second.count() == 4 and os.path.exists(kept) and not os.path.exists(copies[0])
