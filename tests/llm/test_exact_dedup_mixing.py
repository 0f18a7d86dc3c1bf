"""Exact dedup and source mixing on small and awkward tables."""

import hashlib
import math
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from evstar.llm.exact_dedup import SALTS, ascii_lower, exact_dedup
from evstar.llm.mixing import hash_uniform, mix_sources, mixing_rates

DOCS = "doc_id long, text string, source string, digest string, salt int, copy_no int, mix_cdf string"


def poisson_quantile(mean, u):
    """Smallest k whose cumulative probability exceeds ``u``."""
    k, p = 0, math.exp(-mean)
    c = p
    while c <= u:
        k += 1
        p *= mean / k
        c += p
    return k


def make(spark, rows):
    return spark.createDataFrame([(i, t, s, "x", 7, 9, "c") for i, t, s in rows], DOCS)


ROWS = [
    (1, "Same Text", "a"), (2, "same text", "a"), (3, "SAME TEXT", "b"), (4, "É same", "b"), (5, "é same", "b"),
    (6, None, "a"), (7, "", None), (None, "lonely", "a"), (None, "same TEXT", "a"), (8, "ÉA", "b"), (9, "Éa", "b"),
    (10, "x" * 50_000, "b"), (10, "x" * 50_000, "b"), (11, "İ", "b"), (12, "i̇", "b"),
]


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def expected(rows):
    groups = defaultdict(list)
    for i, t, _ in rows:
        groups[lower(t)].append(i)
    out = []
    for i, t, _ in rows:
        ids = groups[lower(t)]
        keep = max((x for x in ids if x is not None), default=None)
        out.append((i, keep, len(ids), i == keep, hashlib.sha256(lower(t).encode()).hexdigest()))
    return Counter(out)


@pytest.mark.parametrize("digest", ["sha256", "one character", "constant"])
def test_labels_match_brute_force_whatever_the_digest(spark, digest):
    weak = {"one character": lambda c: F.substring(F.md5(c), 1, 1), "constant": lambda c: F.lit("d")}
    args = (weak[digest],) if digest in weak else ()
    got = exact_dedup(make(spark, ROWS), *args)
    assert got.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert Counter(map(tuple, got.collect())) == expected(ROWS)


def test_hot_group_and_empty_table(spark):
    rows = [(i, "hot" if i % 3 else f"own {i}", "s") for i in range(900)]
    assert Counter(map(tuple, exact_dedup(make(spark, rows)).collect())) == expected(rows)
    assert exact_dedup(make(spark, rows).limit(0)).count() == 0


def test_ascii_lower_leaves_other_letters(spark):
    df = spark.createDataFrame([("ÀÉZ",), ("ABC",), ("",)], "t string")
    assert [r[0] for r in df.select(ascii_lower(F.col("t"))).collect()] == ["ÀÉz", "abc", ""]


def test_dedup_plan_has_no_python(spark):
    plan = exact_dedup(make(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_mixing_counts_follow_the_inverted_distribution(spark):
    rows = [(i, "w" * (1 + i % 7), "abc"[i % 3]) for i in range(600)]
    docs = make(spark, rows)
    rates = {r["mix_source"]: r["rate"] for r in mixing_rates(docs, {"a": 60.0, "b": 1.0}).collect()}
    assert rates["c"] == 0 and rates["a"] > 2
    name = F.concat_ws(":", F.col("doc_id").cast("string"), F.md5("text"), F.lit("0"))
    draws = {r[0]: r[1] for r in docs.select("doc_id", hash_uniform(name, F.lit(17), F.lit(1))).collect()}
    want = {i: poisson_quantile(rates[s], draws[i]) for i, _, s in rows if rates[s]}
    got = mix_sources(docs, {"a": 60.0, "b": 1.0}).collect()
    counts = Counter(r["doc_id"] for r in got)
    assert counts == {i: n for i, n in want.items() if n}
    assert all(sorted(r["copy_no"] for r in got if r["doc_id"] == i) == list(range(1, n + 1)) for i, n in list(counts.items())[:20])
    assert all(r["n_copies"] == counts[r["doc_id"]] for r in got)


def test_mixing_reaches_target_weights(spark):
    rows = [(i, "word " * 20, "big" if i % 10 else "small") for i in range(6000)]
    got = mix_sources(make(spark, rows), {"big": 1.0, "small": 1.0})
    chars = {r["source"]: r["n"] for r in got.groupBy("source").agg(F.sum(F.length("text")).alias("n")).collect()}
    assert abs(chars["big"] / sum(chars.values()) - 0.5) < 0.05


def test_large_means_are_split_and_keep_their_mean(spark):
    rows = [(i, "x", "rare" if i < 40 else "common") for i in range(4000)]
    got = mix_sources(make(spark, rows), {"rare": 1.0, "common": 1.0})  # mean 50 for the rare source
    n = Counter(r["doc_id"] for r in got.collect() if r["source"] == "rare")
    mean = sum(n.values()) / 40
    assert abs(mean - 50) < 5 * math.sqrt(50 / 40)


def test_mixing_awkward_rows(spark):
    rows = [(None, "a b", None), (None, "a b", None), (1, None, "s"), (2, "", "t"), (3, "some text", "s"), (3, "some text", "s")]
    got = mix_sources(make(spark, rows))
    assert got.columns == ["doc_id", "text", "source", "digest", "salt", "mix_cdf", "n_copies", "copy_no", "shuffle_key"]
    assert all(r["mix_cdf"] == "c" and r["salt"] == 7 for r in got.collect())
    assert len({r["shuffle_key"] for r in got.collect()}) == got.count()  # equal rows have keys of their own
    assert mix_sources(make(spark, rows).limit(0)).count() == 0
    again = Counter(map(tuple, mix_sources(make(spark, rows)).collect()))
    assert again == Counter(map(tuple, got.collect()))


def test_mixing_plan_has_no_python(spark):
    plan = mix_sources(make(spark, ROWS))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_mixing_order_is_global(spark):
    rows = [(i, "w", "s") for i in range(500)]
    ids = [r["doc_id"] for r in mix_sources(make(spark, rows)).collect()]
    later = sum(a < b for a, b in zip(ids, ids[1:]))
    assert 0.35 < later / len(ids) < 0.65  # neither ascending nor descending


@pytest.mark.parametrize("seed", [17, 18, 20])
@pytest.mark.parametrize("same_text", [True, False])
def test_rows_that_share_an_id_draw_for_themselves(spark, seed, same_text):
    rows = [(None if i % 3 else i, "word " * 20 if same_text else f"word {i:05d} " + "word " * 18, "big" if i % 2 else "small") for i in range(3000)]
    got = mix_sources(make(spark, rows).repartition(5), {"big": 1.0, "small": 1.0}, seed).select("doc_id", "source", "shuffle_key").collect()
    assert abs(len(got) - 3000) < 150
    assert abs(sum(r["source"] == "big" for r in got) / len(got) - 0.5) < 0.05
    assert abs(sum(r["doc_id"] is None for r in got) / len(got) - 2 / 3) < 0.05
    assert len({r["shuffle_key"] for r in got}) == len(got)


def test_dedup_spreads_rows_of_one_id(spark):
    rows = [(1, "a" if i % 2 else "b", "s") for i in range(6000)]
    assert Counter(map(tuple, exact_dedup(make(spark, rows).repartition(4)).collect())) == expected(rows)
    spread = make(spark, rows).repartition(4).select((F.monotonically_increasing_id() % SALTS).alias("salt")).groupBy("salt").count()
    assert spread.count() == SALTS and max(r["count"] for r in spread.collect()) < 2 * 6000 / SALTS
