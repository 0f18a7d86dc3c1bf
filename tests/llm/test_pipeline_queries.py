"""The registered queries, their SQL, and the corpus pipeline by stages."""

import os
import re
from collections import Counter
from itertools import combinations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from conftest import SF_SMALL
from evstar.llm import quality
from evstar.llm.common import stored
from evstar.llm.decontaminate import words_of
from test_simhash import close, components, plain_fingerprint

OPERATORS = {f"op{n}_" for n in range(1, 14)}


def test_every_operator_has_one_query():
    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert Counter(re.match(r"op\d+_", n)[0] for n in names) == Counter(OPERATORS)
    assert "pipeline" in entry.queries()
    assert {n for n in entry.oracle_sql() if re.match(r"op\d+_", n)} == {
        "op1_poisson_mixing",
        "op7_decontaminate",
        "op10_exact_dedup",
        "op11_conversation_repair",
        "op12_license_scan",
        "op13_ranked_search",
    }


def test_no_other_package_imports_the_subpackage():
    root = os.path.dirname(corpus_pipeline.__file__)
    for folder, _, names in os.walk(f"{root}/evstar"):
        if "/llm" not in folder:
            for n in names:
                if n.endswith(".py"):
                    assert "llm" not in open(f"{folder}/{n}").read().split("import", 1)[-1].replace("__", ""), n


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    out = [("documents", docs)]
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, stage(spark, out[-1][1], SF_SMALL).cache()))
    yield dict(out)
    for _, df in out[1:]:
        df.unpersist()


def rows(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_columns_of_documents_all_the_way(stages):
    for name in list(stages)[1:-1]:
        assert stages[name].columns == stages["documents"].columns


def test_quality_stage(spark, stages):
    docs = stages["documents"]
    model = quality.train(docs, spark.read.parquet(f"{SF_SMALL}/labels.parquet"))
    want = {r["doc_id"] for r in quality.score_quality(docs, model).collect() if r["predicted"]}
    assert set(rows(stages["quality_classifier"])) == want and len(want) < docs.count()


def test_near_dedup_stage(stages):
    before = {i: plain_fingerprint(r["text"]) for i, r in rows(stages["quality_classifier"]).items()}
    groups = components(before, [(a, b) for a, b in combinations(before, 2) if close(before[a], before[b])])
    assert set(rows(stages["simhash_near_dedup"])) == {i for i, root in groups.items() if i == root}


def test_decontamination_stage(spark, stages):
    grams = set()
    for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect():
        w = words_of(r["text"] or "")
        grams.update(tuple(w[i : i + 10]) for i in range(max(len(w) - 9, 1)) if w)
    want = set()
    for i, r in rows(stages["simhash_near_dedup"]).items():
        w = words_of(r["text"] or "")
        if not any(tuple(w[k : k + n]) in grams for n in {len(g) for g in grams} for k in range(len(w) - n + 1)):
            want.add(i)
    assert set(rows(stages["benchmark_decontamination"])) == want


def test_mixing_and_token_stages(stages):
    mixed = Counter(r["doc_id"] for r in stages["source_mixing"].collect())
    assert set(mixed) <= set(rows(stages["benchmark_decontamination"]))
    tokens = stages["token_output"].collect()
    assert Counter(r["doc_id"] for r in tokens) == mixed
    at = 0
    for r in sorted(tokens, key=lambda r: r["start"]):
        assert r["start"] == at
        at += r["n_tokens"]


def test_copies_of_a_document_are_not_neighbours_in_the_token_files(spark):
    docs = spark.createDataFrame([(i, f"document {i}", "en", "rare" if i < 40 else "big", 9) for i in range(1000)], "doc_id long, text string, lang string, source string, n_chars long")
    mixed = stored(corpus_pipeline.mixing_stage(spark, docs, SF_SMALL), "mixed")
    tokens = corpus_pipeline.token_stage(spark, mixed, SF_SMALL)
    order = [r["doc_id"] for r in sorted(tokens.collect(), key=lambda r: r["start"])]
    assert Counter(order) == Counter(r["doc_id"] for r in mixed.collect()) and order != sorted(order)
    repeats = len(order) - len(set(order))
    assert repeats > 100 and sum(a == b for a, b in zip(order, order[1:])) < repeats / 10


def test_run_gives_the_last_stage(spark, stages):
    by_document = lambda df: Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in df.collect())
    result = corpus_pipeline.run(spark, SF_SMALL)
    assert by_document(result) == by_document(stages["token_output"])
    rows = sorted(result.collect(), key=lambda r: r["start"])
    assert [r["start"] for r in rows] == [sum(x["n_tokens"] for x in rows[:k]) for k in range(len(rows))]


def test_stages_take_empty_and_awkward_documents(spark, stages):
    docs = stages["documents"]
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, "x " * 20_000, None, None, 1)], docs.schema)
    for df in (docs.limit(0), odd):
        for _, stage in corpus_pipeline.STAGES:
            df = stage(spark, df, SF_SMALL)
            df.collect()


