"""Benchmark decontamination against a plain version."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from evstar.llm.decontaminate import WindowSet, contamination, cut_words, remove_documents, remove_spans, words_of

ITEM = "one two three four five six seven eight nine ten eleven"


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


@given(st.text(max_size=60))
@settings(max_examples=150, deadline=None, derandomize=True)
def test_words_match_the_pattern(text):
    assert [w.decode() for w in words_of(text)] == plain_words(text)


def plain_report(docs, items):
    out = []
    for doc_id, text in docs:
        words, hit, found = plain_words(text), set(), set()
        for item_id, item in items:
            w = plain_words(item)
            k = min(10, len(w))
            for s in range(len(w) - k + 1) if k else ():
                for p in range(len(words) - k + 1):
                    if words[p : p + k] == w[s : s + k]:
                        hit.update(range(p, p + k))
                        found.update(() if item_id is None else (str(item_id),))
        out.append((doc_id, len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


ITEMS = [(1, ITEM), (2, "Short ITEM here"), (3, None), (4, ""), (10, "five six seven eight nine ten eleven twelve thirteen fourteen"), (2, "Short ITEM here"), (5, "a a a a a a a a a a a"), (None, "null id words here now")]
DOCS = [
    (1, "before " + ITEM.upper() + " after"),
    (2, "short, item! here short item here"),
    (3, None),
    (4, ""),
    (5, ITEM + " twelve thirteen fourteen"),
    (6, "a " * 5000),
    (7, "one two three four five six seven eight nine"),
    (None, "x short item here"),
    (8, "éa short item heré"),
    (9, "null id words here now"),
    (1, "before " + ITEM.upper() + " after"),
]


def frames(spark):
    docs = spark.createDataFrame([(i, t, "x", 3) for i, t in DOCS], "doc_id long, text string, decon_found string, n_words int")
    return docs, spark.createDataFrame(ITEMS, "item_id long, text string")


def by_text(rows):
    return sorted(map(str, rows))


def test_report_matches_brute_force_in_one_block_and_in_many(spark):
    docs, items = frames(spark)
    want = by_text(plain_report(DOCS, ITEMS))
    assert by_text(tuple(r) for r in contamination(docs, items).collect()) == want
    assert by_text(tuple(r) for r in contamination(docs, items, block_chars=40).collect()) == want


def test_removal_of_documents_and_spans(spark):
    docs, items = frames(spark)
    kept = remove_documents(docs, items)
    assert kept.columns == ["doc_id", "text", "n_words"]
    assert sorted(map(str, (r["doc_id"] for r in kept.collect()))) == ["3", "4", "7", "8"]
    texts = {r["doc_id"]: r["text"] for r in remove_spans(docs, items).collect()}
    assert texts[1] == "before  after" and texts[3] is None and texts[9] == ""
    assert texts[2].split() == [] and texts[6].strip() == ""


def test_empty_tables(spark):
    docs, items = frames(spark)
    assert contamination(docs.limit(0), items).count() == 0
    assert all(not r["contaminated"] and r["n_items"] == 0 for r in contamination(docs, items.limit(0)).collect())


def test_hash_hits_are_verified():
    windows = WindowSet([("i", ITEM)])
    windows.words[:] = 0  # hashes still match; the words no longer do
    assert windows.scan(words_of(ITEM)) == ([], set())


def test_cut_words_keeps_the_rest():
    assert cut_words("Ab, cd (ef) gh", [(1, 3)]) == "Ab, ) gh"
    assert cut_words("é x é x", [(0, 1), (3, 4)]) == " x é "


def test_columns_with_odd_names_stay(spark):
    docs = spark.createDataFrame([(1, ITEM, (1, "x"), 2), (2, "clean", (3, "y"), 4)], "doc_id long, text string, `a.b` struct<`odd field`: long, z: string>, `tick``s` long")
    items = spark.createDataFrame([(1, ITEM)], "item_id long, text string")
    kept = remove_documents(docs, items)
    assert kept.schema == docs.schema and [tuple(r)[0] for r in kept.collect()] == [2]
    spans = remove_spans(docs, items)
    assert spans.columns == docs.columns and {r[0]: r[1] for r in spans.collect()} == {1: "", 2: "clean"}


def test_a_large_benchmark_fits_its_block():
    rng = np.random.default_rng(0)
    items = [(str(k), " ".join(map(str, rng.integers(0, 500_000, 1000)))) for k in range(1000)]
    windows = WindowSet([*items, ("long", "a " * 300_000)])
    held = windows.words.nbytes + sum(h.nbytes + p.nbytes for h, p in windows.hashes.values())
    assert held < 25 * 1_300_000 and len(windows.hashes[10][0]) <= 991 * 1000 + 1
    text = items[3][1].split()
    assert windows.scan(words_of(" ".join(["x", *text[5:20], "y"]))) == ([(1, 16)], {"3"})
    assert windows.scan(words_of("a " * 12)) == ([(0, 12)], {"long"})
