"""Toxicity by noisy-channel restoration and a learned lexicon.

1. Trigram counts of the character model are gathered over all documents.
2. Disguised tokens are restored (:mod:`deobfuscate`); a document's words are
   those it shows and those restored.
3. From a bounded labelled sample, words and word beginnings get a strength:
   the lower bound of the share of toxic documents among those that contain
   them. A logistic score on a document's strongest words is fitted with each
   half of the sample described by the strengths of the other half.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held_out, stored, texts_of
from .deobfuscate import Restorer, spaced_runs, trigram_counts
from .sampling import labelled_sample

#: Labelled documents the lexicon and the score are learned from, at most.
TRAINING_DOCS = 16_000
#: Toxic sample documents a word must be in to enter the lexicon.
MIN_SUPPORT = 2
THRESHOLD = 0.5
#: Lengths of word beginnings used besides whole words.
BEGINNINGS = (4, 5)
#: Token strengths a task remembers before it starts anew.
REMEMBERED = 400_000
#: Strength from which a token counts as toxic by itself.
SURE = 0.7
Z = 1.64  # one-sided 95 % bound


def character_counts(docs: DataFrame) -> np.ndarray:
    """Trigram counts over every whole text (at most 28^3 numbers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for _, texts in texts_of(batch, "text"):
                counts = trigram_counts(texts)
                total = counts if total is None else total + counts
        if total is not None:
            at = np.flatnonzero(total)
            yield pa.record_batch([pa.array(at), pa.array(total[at])], names=["gram", "n"])

    rows = docs.select("text").mapInArrow(run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")).collect()
    counts = np.zeros(28**3, np.int64)
    for r in rows:
        counts[r["gram"]] = r["n"]
    return counts


def features(word: str) -> list[str]:
    return ["=" + word, *("^" + word[:n] for n in BEGINNINGS if len(word) >= n)]


def tokens_of(text: str) -> set[str]:
    """Distinct lower-case tokens, and runs of spaced single letters."""
    low = text.lower()
    found = set(low.split())
    found.update(spaced_runs(low))
    return found


class ToxicModel:
    """Lexicon, restorer and score weights."""

    def __init__(self, counts: np.ndarray, strengths: dict[str, float]) -> None:
        self.restorer = Restorer(counts)
        self.strengths = strengths
        self.starts = {f[1:3] for f in strengths}  # of words that may have a strength
        self.weights = np.zeros(4)
        self.bias = 0.0
        self.known: dict[str, float] = {}

    def strength(self, token: str) -> float:
        if token not in self.known:
            if len(self.known) > REMEMBERED:
                self.known.clear()
            of, starts = self.strengths, self.starts
            self.known[token] = max(
                (of.get(f, 0.0) for word in self.restorer.words(token) if word[:2] in starts for f in features(word)), default=0.0
            )
        return self.known[token]

    def describe(self, text: str) -> tuple[float, ...]:
        """The weights of evidence of the two strongest tokens, the number of
        strong tokens, and their share."""
        tokens = tokens_of(text)
        strong = sorted((s for s in map(self.strength, tokens) if s > 0.1), reverse=True)
        first, second = (-math.log(1 - s) for s in (strong + [0.0, 0.0])[:2])
        sure = sum(s > SURE for s in strong)
        return first, second, math.log1p(sure), sure / (len(tokens) + 10)

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 400, rate: float = 0.5) -> None:
        """Logistic regression by gradient descent with momentum."""
        w, speed = np.zeros(x.shape[1] + 1), np.zeros(x.shape[1] + 1)
        x1 = np.c_[x, np.ones(len(x))]
        for _ in range(steps):
            p = 1 / (1 + np.exp(-x1 @ w))
            speed = 0.9 * speed - rate * (x1.T @ (p - y) / len(y) + 1e-4 * w)
            w = w + speed
        self.weights, self.bias = w[:-1], float(w[-1])

    def score(self, texts: list[str]) -> np.ndarray:
        x = np.array([self.describe(t) for t in texts], float).reshape(-1, 4)
        return 1 / (1 + np.exp(-(x @ self.weights + self.bias)))


def lower_bound(toxic: int, clean: int) -> float:
    """Wilson lower bound of ``toxic / (toxic + clean)``."""
    n = toxic + clean
    p = toxic / n
    return (p + Z * Z / (2 * n) - Z * np.sqrt(p * (1 - p) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)


def strengths(toxic: dict[str, int], clean: dict[str, int]) -> dict[str, float]:
    """Strengths of the features of at least ``MIN_SUPPORT`` toxic documents."""
    bounds = {f: float(lower_bound(n, clean.get(f, 0))) for f, n in toxic.items() if n >= MIN_SUPPORT}
    return {f: s for f, s in bounds.items() if s > 0.1}


def _feature_counts(sample: DataFrame, restorer: Restorer, only: set[str] | None = None) -> DataFrame:
    """``feature, half, n``: documents of each half that contain a feature."""
    sc = sample.sparkSession.sparkContext
    shared, wanted = sc.broadcast(restorer), sc.broadcast(only)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = batch.column(1).to_pylist()
            counts: Counter[tuple[str, int]] = Counter()
            for start, texts in texts_of(batch, "text"):
                for half, text in zip(halves[start:], texts):
                    found = {f for t in tokens_of(text) for w in shared.value.words(t) for f in features(w)}
                    counts.update((f, half) for f in (found if wanted.value is None else found & wanted.value))
            yield pa.record_batch(
                [pa.array([k[i] for k in counts], t) for i, t in enumerate((pa.string(), pa.int32()))] + [pa.array(counts.values(), pa.int64())],
                names=["feature", "half", "n"],
            )

    rows = sample.select("text", "half").mapInArrow(run, "feature string, half int, n long")
    return rows.groupBy("feature", "half").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, labels: DataFrame, training_docs: int = TRAINING_DOCS) -> ToxicModel | None:
    """Learn from all texts (character counts) and a bounded labelled sample
    of documents that are not held out; None without toxic or clean labels.

    The driver gets the character counts, the features of at least
    ``MIN_SUPPORT`` toxic sample documents, and four numbers for each sample
    document."""
    counts = character_counts(docs)
    restorer = Restorer(counts)
    sample = labelled_sample(docs, labels, "toxic", training_docs)
    sample = stored(sample.withColumn("half", F.pmod("draw", F.lit(2)).cast("int")), "toxic-sample")
    if sample.select("label").distinct().count() < 2:
        return None
    enough = Window.partitionBy("feature")
    toxic = _feature_counts(sample.filter("label = 1"), restorer).withColumn("all", F.sum("n").over(enough))
    in_toxic = toxic.filter(F.col("all") >= MIN_SUPPORT).collect()
    in_clean = _feature_counts(sample.filter("label = 0"), restorer, {r["feature"] for r in in_toxic}).collect()

    def of(rows: list, *halves: int) -> dict[str, int]:
        out: Counter[str] = Counter()
        for r in rows:
            if r["half"] in halves:
                out[r["feature"]] += r["n"]
        return out

    described = [ToxicModel(counts, strengths(of(in_toxic, 1 - h), of(in_clean, 1 - h))) for h in (0, 1)]
    shared = docs.sparkSession.sparkContext.broadcast(described)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            halves = batch.column(1).to_pylist()
            x = [
                shared.value[h].describe(t)
                for start, texts in texts_of(batch, "text")
                for h, t in zip(halves[start:], texts)
            ]
            columns = [pa.array([float(r[i]) for r in x], pa.float64()) for i in range(4)]
            yield pa.record_batch([*columns, batch.column(2)], names=["a", "b", "c", "d", "label"])

    rows = sample.select("text", "half", "label").mapInArrow(run, "a double, b double, c double, d double, label int").collect()
    rows = sorted(tuple(r) for r in rows)  # the order of tasks is no input
    model = ToxicModel(counts, strengths(of(in_toxic, 0, 1), of(in_clean, 0, 1)))
    model.fit(np.array([r[:4] for r in rows], float), np.array([r[4] for r in rows], float))
    return model


def score_toxicity(docs: DataFrame, model: ToxicModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Null and empty texts have no words and get the score of such. Without a
    model (no labels, or one label only) every score is 0. Null ids and
    repeated rows pass through; other columns are ignored; an empty table
    gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.empty(0)]
            for _, texts in texts_of(batch, "text"):
                scores.append(np.zeros(len(texts)) if shared.value is None else shared.value.score(texts))
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(np.concatenate(scores), pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
