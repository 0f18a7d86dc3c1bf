"""The similarity join against a comparison of every window with every
template, and the query's columns."""

import random
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import SF_SMALL
from evstar.llm.license_scan import TEMPLATES, Template, TemplateIndex, alpha, document_frequency, find_blocks, scan_licenses
from evstar.llm.queries import op12_license_scan

SMALL = [
    Template("p", "a b", 100, True),
    Template("q", "b a a", 100, True),
    Template("r", "a b c d e"),
    Template("s", "c c a a d e f f"),
    Template("t", "g", 100, True),
    Template("u", ""),
]


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def plain(text, templates):
    w, out = words(text), []
    for n, t in enumerate(templates):
        tw = words(t.text)
        need, width = -(-len(tw) * t.percent // 100), min(len(tw), len(w))
        if not tw or not w:
            continue
        hits = []
        for s in range(len(w) - width + 1):
            overlap = sum((Counter(w[s : s + width]) & Counter(tw)).values())
            if overlap >= need and (not t.ordered or w[s : s + width] == tw):
                hits.append((s, overlap / len(tw)))
        runs = []
        for s, c in hits:
            if runs and not t.ordered and s == runs[-1][1] - width + 1:
                runs[-1] = (runs[-1][0], s + width, max(runs[-1][2], c))
            else:
                runs.append((s, s + width, c))
        out += [(n, *r) for r in runs]
    return out


@given(st.lists(st.sampled_from("abcdefgx"), max_size=40), st.dictionaries(st.sampled_from([c.encode() for c in "abcdefg"]), st.integers(0, 9)))
@settings(max_examples=300, deadline=None, derandomize=True)
def test_no_block_is_lost_whatever_the_order(letters, frequency):
    index = TemplateIndex(list(enumerate(SMALL)), frequency)
    assert index.matches([c.encode() for c in letters]) == plain(" ".join(letters), SMALL)


def test_alpha_is_exact():
    assert [alpha(n, 80) for n in (1, 4, 5, 6, 10, 15)] == [1, 4, 4, 5, 8, 12]
    assert alpha(3, 100) == 3 and alpha(1000, 29) == 290


def result(df):
    return [tuple(r) for r in df.orderBy("doc_id").collect()]


def test_whole_table_against_every_window(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    found = {r["doc_id"]: r for r in op12_license_scan(spark, SF_SMALL).collect()}
    held = {d["doc_id"]: d["text"] for d in docs.collect()}
    assert set(found) == set(held)
    for doc_id, text in held.items():
        want, r = plain(text, TEMPLATES), found[doc_id]
        base = [m for m in want if TEMPLATES[m[0]].ordered]
        assert r["n_words"] == len(words(text)) and r["n_base"] == len(base)
        assert r["first_word"] == min((m[1] for m in base), default=None)
        assert r["last_word"] == max((m[1] for m in base), default=None)
        assert r["base_labels"] == ",".join(sorted({TEMPLATES[m[0]].label for m in base}))
        assert r["labels"] == ",".join(sorted({TEMPLATES[m[0]].label for m in want}))
        assert r["score"] == max((m[3] for m in want), default=0.0)


def test_every_notice_finds_itself_even_with_some_words_changed(spark):
    rng, rows = random.Random(1), []
    for n, t in enumerate(TEMPLATES):
        w = t.text.split()
        rows.append((n, "lorem ipsum " + " ".join(w) + " dolor"))
        spare = len(words(t.text)) - alpha(len(words(t.text)), t.percent)
        plain_words = [i for i, x in enumerate(w) if re.fullmatch(r"\w+", x)]
        for i in rng.sample(plain_words, min(spare, len(plain_words))):
            w[i] = "zzz"
        rows.append((100 + n, "\n".join(w)))
    found = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for n, t in enumerate(TEMPLATES):
        assert t.label in found[n]["labels"].split(",") and found[n]["score"] == 1.0
        assert t.label in found[100 + n]["labels"].split(",")


def test_awkward_rows(spark):
    rows = [
        (None, None, "x"),
        (1, "", "x"),
        (2, "MIT License mit license, MIT-LICENSE", "x"),
        (2, "MIT License mit license, MIT-LICENSE", "x"),
        (3, "license mit", "x"),
        (4, "word " * 50_000 + "General Public License " * 3, "x"),
        (5, "ŁMIT license", "x"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, license_matches string").withColumn("n_words", F.lit(0)).withColumn("places", F.lit(0))
    got = sorted((r[:6] for r in map(tuple, scan_licenses(df).collect())), key=str)
    assert got == sorted(
        [
            (None, 0, 0, None, None, ""),
            (1, 0, 0, None, None, ""),
            (2, 5, 2, 0, 3, "mit"),  # a no-break space is part of a word
            (2, 5, 2, 0, 3, "mit"),
            (3, 2, 0, None, None, ""),
            (4, 50_009, 3, 50_000, 50_006, "gpl"),
            (5, 2, 0, None, None, ""),
        ],
        key=str,
    )
    assert scan_licenses(df.limit(0)).collect() == []
    assert [r["score"] for r in scan_licenses(df, [Template("none", "")]).collect()] == [0.0] * 7


def test_blocks_of_templates_change_nothing(spark):
    rows = [(i, " ".join(random.Random(i).choices("abcdefgx", k=60))) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    whole = {r["doc_id"]: sorted(map(tuple, r["license_matches"])) for r in find_blocks(df, SMALL).collect()}
    parts = {r["doc_id"]: sorted(map(tuple, r["license_matches"])) for r in find_blocks(df, SMALL, block_words=4).collect()}
    assert whole == parts == {i: sorted(plain(t, SMALL)) for i, t in rows}
    assert any(whole.values())


def test_frequency_counts_documents(spark):
    df = spark.createDataFrame([(1, "mit mit"), (2, "MIT x"), (3, None)], "doc_id long, text string").repartition(3)
    assert document_frequency(df, {b"mit", b"gpl"}) == {b"mit": 2}
