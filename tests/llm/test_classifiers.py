"""Held-out accuracy and awkward rows of the learned operators, and their
parts against plain versions."""

import math
import zlib

import numpy as np
import pytest

from evstar.llm import langid, quality, toxicity
from evstar.llm.deobfuscate import SPACED, SYMBOLS, Restorer, spaced_runs, symbol, trigram_counts

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return {t: spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels")}


def labelled(tables, scored, label):
    """(label, predicted, score) of held-out documents."""
    y = {r["doc_id"]: r[label] for r in tables["labels"].collect()}
    rows = [r for r in scored.collect() if r["held_out"] and r["doc_id"] in y]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    return [(y[r["doc_id"]], r["predicted"], r["score"]) for r in rows]


def test_quality_on_held_out_documents(tables):
    model = quality.train(tables["documents"], tables["labels"])
    scored = quality.score_quality(tables["documents"], model).cache()
    got = labelled(tables, scored, "quality")
    assert len(got) > 50 and np.mean([a == b for a, b, _ in got]) > 0.95
    assert all(0 <= s <= 1 and p == (s >= 0.3) for _, p, s in got)
    kept = quality.keep_good(tables["documents"], model)
    assert kept.columns == tables["documents"].columns
    assert {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in scored.collect() if r["predicted"]}
    scored.unpersist()


def test_toxicity_on_held_out_documents(spark):
    tables = {t: spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels")}
    scored = toxicity.score_toxicity(tables["documents"], toxicity.train(tables["documents"], tables["labels"]))
    got = labelled(tables, scored, "toxic")
    assert np.mean([a == b for a, b, _ in got]) > 0.97
    toxic, clean = [s for a, _, s in got if a], [s for a, _, s in got if not a]
    assert np.mean([t > c for t in toxic for c in clean]) > 0.9


def test_language_on_held_out_documents(tables):
    scored = langid.identify(tables["documents"], langid.train(tables["documents"])).collect()
    lang = {r["doc_id"]: r["lang"] for r in tables["documents"].collect()}
    got = [r["lang_pred"] == lang[r["doc_id"]] for r in scored if r["held_out"]]
    assert len(scored) == len(lang) and np.mean(got) > 0.95
    assert all(0 <= r["score"] <= 1 for r in scored)


AWKWARD = [(1, None), (2, ""), (3, " \n\t"), (None, "some words here"), (4, "12 34 !!"), (5, "w" * 30_000), (6, "word " * 8_000), (6, "word " * 8_000)]


def awkward(spark, rows=AWKWARD):
    return spark.createDataFrame([(i, t, "en", 0.5, True, 1) for i, t in rows], "doc_id long, text string, lang string, score double, held_out boolean, label int")


def test_awkward_rows(spark, tables):
    docs = awkward(spark)
    for module, label in ((quality, "quality"), (toxicity, "toxic")):
        for labels in (tables["labels"].limit(0), spark.createDataFrame([(3, None, None), (None, 1, 1), (4, 0, 0), (6, 1, 1), (6, 0, 0)], "doc_id long, quality int, toxic int")):
            model = module.train(docs, labels)
            score = module.score_quality if module is quality else module.score_toxicity
            got = score(docs, model)
            assert got.columns == ["doc_id", "held_out", "score", "predicted"] and got.count() == len(AWKWARD)
            assert all(0 <= r["score"] <= 1 for r in got.collect())
            assert score(docs.limit(0), model).count() == 0
    for trees in (langid.train(docs), langid.train(docs.limit(0))):
        got = langid.identify(docs, trees).collect()
        assert [r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3, 4)] == ["und"] * 4
        assert langid.identify(docs.limit(0), trees).count() == 0


def plain_code_length(counts, text, order=3, min_context=2):
    """PPM code length by its definition, for one language."""
    total = {}
    for gram, n in counts.items():
        for k in range(order + 1):
            total.setdefault(gram[3 - k : 3], {}).setdefault(gram[3], 0)
            total[gram[3 - k : 3]][gram[3]] += n
    bits, data = 0.0, b"\0\0\0" + text
    for i in range(3, len(data)):
        for k in range(order, -1, -1):
            seen = total.get(data[i - k : i], {})
            if k and sum(seen.values()) < min_context:
                continue
            n, d = sum(seen.values()), len(seen)
            if data[i] in seen:
                bits -= math.log2(seen[data[i]] / (n + d))
                break
            bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


def test_code_lengths_follow_the_definition():
    train = [b"the cat sat on the mat", b"then the hat"]
    grams, n = langid._gram_counts(train)
    trees = langid.ContextTrees([("en", int(g), int(c)) for g, c in zip(grams, n)])
    counts = {int(g).to_bytes(4, "big"): int(c) for g, c in zip(grams, n)}
    texts = [b"the cat", b"hat on xyz", b"", b"\xc3\xa9 then", b"a"]
    assert trees.code_lengths(texts)[:, 0] == pytest.approx([plain_code_length(counts, t) for t in texts], rel=1e-5)


def test_code_lengths_do_not_depend_on_the_batch(monkeypatch):
    grams, n = langid._gram_counts([b"some text to learn from", b"other text"])
    trees = langid.ContextTrees([("a", int(g), int(c)) for g, c in zip(grams, n)])
    texts = [b"text " * k for k in range(30)]
    whole = trees.code_lengths(texts)
    monkeypatch.setattr(langid, "BYTES_AT_A_TIME", 40)
    assert np.allclose(trees.code_lengths(texts), whole)


def plain_passages(text, size):
    words = [w for w in text.encode().split()]
    return [words[i : i + size] for i in range(0, len(words), size)] or [[]]


def test_passage_features_cover_the_whole_text():
    texts = ["Aa bb! cc", "", "x " * 200 + "END", "\n lead é tail ", "a\x1cb"]
    x, sizes = quality.passage_features(texts)
    assert sizes.tolist() == [len(plain_passages(t, quality.PASSAGE_WORDS)) for t in texts]
    rows = [p for t in texts for p in plain_passages(t, quality.PASSAGE_WORDS)]
    for got, words in zip(x, rows):
        chars = sum(map(len, words))
        if not words:
            assert not got.any()
            continue
        flat = b"".join(words)
        assert got[0] == pytest.approx(sum(65 <= c <= 90 for c in flat) / chars)
        assert got[4] == pytest.approx(flat.count(b"!") / chars)
        assert got[18] == pytest.approx(chars / len(words) / 10)
        assert got[20] == pytest.approx(sum(a == b for a, b in zip(words, words[1:])) / len(words))
        assert got[21] == pytest.approx(len(set(words)) / len(words))
        assert got[23] == pytest.approx(sum(len(w) <= 3 for w in words) / len(words))


def test_attention_gradients_match_differences():
    rng = np.random.default_rng(0)
    x, sizes, y = rng.normal(size=(9, 5)), np.array([2, 3, 4]), np.array([0.0, 1.0, 1.0])
    model = quality.AttentionModel(5, 4)

    def loss():
        p = model.forward(x, sizes)[0]
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    score, state = model.forward(x, sizes)
    for name, d in model._gradients(score - y, sizes, state).items():
        flat = model.w[name].ravel()
        for i in range(0, flat.size, 3):
            flat[i] += 1e-6
            up = loss()
            flat[i] -= 2e-6
            down = loss()
            flat[i] += 1e-6
            assert d.ravel()[i] == pytest.approx((up - down) / 2e-6, abs=1e-6)


def test_attention_finds_the_passage_that_matters():
    rng = np.random.default_rng(1)
    sizes = rng.integers(3, 9, 400)
    x = rng.normal(size=(sizes.sum(), 6))
    heads = np.r_[0, np.cumsum(sizes)[:-1]]
    y = rng.integers(0, 2, 400).astype(float)
    x[heads[y == 1] + 1, 0] += 6  # one passage of a positive document shows it
    model = quality.AttentionModel(6, 8)
    model.fit(x, sizes, y, steps=150)
    score, state = model.forward(x, sizes)
    assert np.mean((score > 0.5) == y) > 0.95
    attention = state[5]
    assert np.mean(attention[heads[y == 1] + 1]) > 2 * np.mean(1 / sizes)


WORDS = ["idiot", "stupid", "moron", "the", "that", "is", "good", "people", "say", "loser", "worthless", "trash"]


@pytest.fixture(scope="module")
def restorer():
    return Restorer(trigram_counts([" ".join(WORDS)] * 200))


@pytest.mark.parametrize(
    "shown,word",
    [("1d10t", "idiot"), ("stuuuupid", "stupid"), ("m0r0n", "moron"), ("l.o.s.e.r", "loser"), ("w0rthle$$", "worthless"), ("s t u p i d", "stupid"), ("+r4sh", "trash"), ("!d!ot", "idiot")],
)
def test_disguises_are_restored(restorer, shown, word):
    assert word in restorer.words(shown)


def test_plain_words_stay(restorer):
    for w in WORDS + ["3", "2024", "a-b", "wow!!", "$$$"]:
        assert restorer.words(w) == set(__import__("re").findall(r"[^\W\d_]+", w))


def test_viterbi_finds_the_best_path(restorer):
    """Against all paths, on short tokens."""
    from itertools import product

    def cost(steps):
        a = b = 0
        total = 0.0
        for emitted, channel in steps:
            total += channel
            if emitted:
                c = symbol(emitted)
                total += restorer.bits[a][b][c]
                a, b = b, c
        return total + restorer.bits[a][b][0]

    for token in ("1d10t", "l00ser", "s.t.1", "tttr4$h", "m|8"):
        paths = list(product(*(restorer._steps(token, k) for k in range(len(token)))))
        best = min(map(cost, paths))
        assert any(cost(p) == pytest.approx(best) and "".join(e for e, _ in p) == restorer.decode(token) for p in paths)


def test_trigram_counts_of_the_corpus():
    counts = trigram_counts(["Ab é", "b"]).reshape(SYMBOLS, SYMBOLS, SYMBOLS)
    assert counts[0, 1, 2] == 1 and counts[2, 0, 27] == 1 and counts[0, 2, 0] == 1
    assert counts.sum() == len(" ab é b ") - 2


@pytest.mark.parametrize(
    "shown,word",
    [("1d107", "idiot"), ("l0$3r", "loser"), ("7r45h", "trash"), ("5+up1d", "stupid"), ("i-d-i-o-t,", "idiot"), ("s.t.u.p.i.d.", "stupid"),
     ("l  o  s  e  r", "loser"), ("id-iot", "idiot"), ("stuupid", "stupid"), ("l000ser", "loser"), ("lo0ser", "loser"), ("(m00ron)", "moron")],
)
def test_more_disguises_are_restored(restorer, shown, word):
    assert word in restorer.words(shown)


@pytest.mark.parametrize(
    "text,word",
    [("you l o s e r.", "loser"), ("so s t u p i d, yes", "stupid"), ('"t r a s h!"', "trash"), ("m  o  r  o  n", "moron"), ("l.o.s.e.r.", "loser"), ("say 1d107!", "idiot")],
)
def test_disguises_are_found_in_texts(restorer, text, word):
    assert word in {w for t in toxicity.tokens_of(text) for w in restorer.words(t)}


def test_sample_is_bounded_whatever_the_names_and_repeats(spark):
    from pyspark.sql import functions as F

    from evstar.llm.sampling import labelled_sample

    docs = spark.createDataFrame([(1, f"text {i}") for i in range(400)] + [(i, "t") for i in range(2, 40)], "doc_id long, text string")
    docs = docs.select("*", *[F.lit("x").alias(c) for c in ("draw", "sample_label", "sample_id", "label", "half", "quality", "toxic", "row_text")]).repartition(4)
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(40)], "doc_id long, quality int, toxic int").withColumn("draw", F.lit(0))
    rows = labelled_sample(docs, labels, "quality", 25).collect()
    assert 0 < len(rows) <= 25 and len({r["doc_id"] for r in rows}) == len(rows)
    model = quality.train(docs, labels)
    assert quality.keep_good(docs, model).dtypes == docs.dtypes
    assert quality.score_quality(docs, model).count() == docs.count()
    toxicity.score_toxicity(docs, toxicity.train(docs, labels)).count()


def test_whole_bags_are_fitted(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality.AttentionModel, "fit", lambda self, x, sizes, y, **_: seen.append(sorted(sizes.tolist())))
    docs = spark.createDataFrame([(2, "w " * 64 * 50), (3, "w"), (4, "w " * 65)], "doc_id long, text string")
    labels = spark.createDataFrame([(2, 1), (3, 0), (4, 0)], "doc_id long, quality int")
    quality.train(docs, labels)
    assert seen[0][-1] in (2, 50) and sum(seen[0]) == sum({2: 50, 3: 1, 4: 2}[i] for i in (2, 3, 4) if zlib.crc32(str(i).encode()) % 5)


def test_numbers_that_are_no_letters_have_no_language(spark):
    docs = spark.createDataFrame([(i, "der die das und ist nicht ein eine", "de") for i in range(60)], "doc_id long, text string, lang string")
    trees = langid.train(docs)
    assert trees.predict(["\u00bd \u2461", "\u2167", "12 _", "\u3007"])[0] == ["und"] * 4
    assert trees.predict(["\u00aa", "x", "\u4e00"])[0] == ["de"] * 3


def test_spaced_runs_by_their_beginnings():
    rng = np.random.default_rng(3)
    signs = ["a", "l", "0", "$", " ", " ", ".", "-", '"', "[", "(", "x", "\n", "é", "1", "_", "*", "!"]
    for _ in range(20_000):
        text = "".join(rng.choice(signs, rng.integers(0, 14)))
        assert spaced_runs(text) == [m.group() for m in SPACED.finditer(text)], text
