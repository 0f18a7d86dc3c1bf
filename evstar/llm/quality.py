"""Quality classifier by attention-based multiple-instance learning.

A document is a bag of passages (runs of ``PASSAGE_WORDS`` words, the whole
text). Every passage is encoded as numbers that describe its writing; a
small network embeds each, gives it a gated attention weight, and scores the
weighted mean of the embeddings. Only document labels are known: the
attention learns which passages speak for them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, map_batches, texts_of
from .sampling import labelled_sample

PASSAGE_WORDS = 64
#: Labelled documents the network is fitted on, at most.
TRAINING_DOCS = 4000
THRESHOLD = 0.3
HIDDEN = 16
STEPS = 120
SEED = 5

_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_CLASSES = np.zeros((256, 9), np.float32)
for _i, _chars in enumerate(
    (
        [*range(65, 91)],  # upper case
        [*range(97, 123)],  # lower case
        [*range(48, 58)],  # digits
        [*range(128, 256)],  # beyond ASCII
        [33],  # exclamation marks
        [*b".,;:?'\"-()"],  # ordinary punctuation
        [*b"|<>{}[]\\/=_~^`"],  # table and markup signs
        [*b"#$%&*@+"],  # symbols
        [*range(0, 9), *range(14, 32), 127],  # control bytes
    )
):
    _CLASSES[_chars, _i] = 1
_MIX = np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64) | np.uint64(1)
N_FEATURES = 9 + 9 + 8


def passage_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Features of every passage of the texts, and the number of passages of
    each text. A text without words has one passage of zeros."""
    raw = b"\n".join(t.encode("utf-8", "surrogatepass") for t in texts) + b"\n"
    data = np.frombuffer(raw, np.uint8)
    space = _SPACE[data]
    edge = np.diff(np.r_[1, space.view(np.int8)])
    starts = np.flatnonzero(edge == -1)
    stops = np.flatnonzero(np.r_[edge, 0] == 1)
    ends_of_text = np.cumsum([len(t.encode("utf-8", "surrogatepass")) + 1 for t in texts])
    words_before = np.r_[0, np.searchsorted(starts, ends_of_text)]
    n_words = np.diff(words_before)
    n_passages = np.maximum(-(-n_words // PASSAGE_WORDS), 1)
    out = np.zeros((int(n_passages.sum()), N_FEATURES), np.float32)
    if not len(starts):
        return out, n_passages
    first_passage = np.r_[0, np.cumsum(n_passages)[:-1]]
    text_of = np.repeat(np.arange(len(texts)), n_words)
    passage = first_passage[text_of] + (np.arange(len(starts)) - words_before[text_of]) // PASSAGE_WORDS
    length = (stops - starts).astype(np.float64)
    heads = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]])
    filled = passage[heads]
    count = np.diff(np.r_[heads, len(starts)]).astype(np.float64)

    # Byte classes: sums over each word, then over each passage.
    # reduceat over [start, stop) pairs; the gaps are white space and drop out.
    pairs = np.c_[starts, np.minimum(stops, len(data) - 1)].ravel()
    by_word = np.stack([np.add.reduceat(_CLASSES[data, k], pairs)[::2] for k in range(9)], axis=1)
    last_class = _CLASSES[data[stops - 1]]
    chars = np.add.reduceat(length, heads)
    out[filled, :9] = np.add.reduceat(by_word, heads) / chars[:, None]
    out[filled, 9:18] = np.add.reduceat(last_class, heads) / count[:, None]

    # Words: lengths, repeats of the word before, and distinct words.
    position = np.arange(len(data)) - np.repeat(np.r_[0, starts], np.diff(np.r_[0, starts, len(data)]))
    weighted = (data.astype(np.uint64) + np.uint64(1)) * _MIX[position % 64] * np.uint64(2654435761)
    key = np.add.reduceat(np.where(space, np.uint64(0), weighted ^ weighted >> np.uint64(31)), starts)
    same = np.r_[False, (key[1:] == key[:-1]) & (passage[1:] == passage[:-1])]
    order = np.lexsort((key, passage))
    fresh = np.r_[True, (key[order][1:] != key[order][:-1]) | (passage[order][1:] != passage[order][:-1])]
    distinct = np.bincount(passage[order][fresh], minlength=len(out))[filled]
    upper = by_word[:, 0] >= np.maximum(length - by_word[:, 4:].sum(axis=1), 1) * 0.9
    per = lambda v: np.add.reduceat(np.asarray(v, np.float64), heads) / count
    mean = chars / count
    out[filled, 18] = mean / 10
    out[filled, 19] = np.sqrt(np.maximum(per(length**2) - mean**2, 0)) / 10
    out[filled, 20] = per(same)
    out[filled, 21] = distinct / count
    out[filled, 22] = per(upper)
    out[filled, 23] = per(length <= 3)
    out[filled, 24] = per(by_word[:, 4:].sum(axis=1) >= length)  # words without letters or digits
    out[filled, 25] = np.log1p(count) / 5
    return out, n_passages


class AttentionModel:
    """Embedding, gated attention and output weights, with the scaling of
    the features."""

    def __init__(self, features: int = N_FEATURES, hidden: int = HIDDEN, seed: int = SEED) -> None:
        rng = np.random.default_rng(seed)
        normal = lambda *shape: rng.normal(0, 1 / np.sqrt(shape[0]), shape)
        self.mean, self.scale = np.zeros(features), np.ones(features)
        self.w = {
            "embed": normal(features, hidden), "embed0": np.zeros(hidden),
            "attend": normal(hidden, hidden), "attend0": np.zeros(hidden),
            "gate": normal(hidden, hidden), "gate0": np.zeros(hidden),
            "weigh": normal(hidden, 1), "out": normal(hidden, 1), "out0": np.zeros(1),
        }

    def forward(self, x: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, tuple]:
        """Scores of bags of passages (rows of ``x``, ``sizes`` each)."""
        w, heads = self.w, np.r_[0, np.cumsum(sizes)[:-1]]
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ w["embed"] + w["embed0"])
        a = np.tanh(h @ w["attend"] + w["attend0"])
        g = 1 / (1 + np.exp(-(h @ w["gate"] + w["gate0"])))
        logit = ((a * g) @ w["weigh"]).ravel()
        top = np.repeat(np.maximum.reduceat(logit, heads), sizes)
        e = np.exp(logit - top)
        attention = e / np.repeat(np.add.reduceat(e, heads), sizes)
        z = np.add.reduceat(attention[:, None] * h, heads)
        score = 1 / (1 + np.exp(-np.clip(z @ w["out"] + w["out0"], -30, 30).ravel()))
        return score, (x, heads, h, a, g, attention, z)

    def fit(self, x: np.ndarray, sizes: np.ndarray, y: np.ndarray, steps: int = STEPS, rate: float = 0.02) -> None:
        """Adam on the mean cross-entropy of the bags, all bags each step."""
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-3
        first = {k: np.zeros_like(v) for k, v in self.w.items()}
        second = {k: np.zeros_like(v) for k, v in self.w.items()}
        for step in range(1, steps + 1):
            score, state = self.forward(x, sizes)
            for k, d in self._gradients(score - y, sizes, state).items():
                d = d + 1e-4 * self.w[k]
                first[k] = 0.9 * first[k] + 0.1 * d
                second[k] = 0.999 * second[k] + 0.001 * d * d
                self.w[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)

    def _gradients(self, error: np.ndarray, sizes: np.ndarray, state: tuple) -> dict[str, np.ndarray]:
        w, (x, heads, h, a, g, attention, z) = self.w, state
        error = (error / len(error))[:, None]
        dz = np.repeat(error * w["out"].T, sizes, axis=0)
        d_attention = (dz * h).sum(axis=1)
        mean = np.repeat(np.add.reduceat(attention * d_attention, heads), sizes)
        d_logit = (attention * (d_attention - mean))[:, None]
        d_ag = d_logit * w["weigh"].T
        da, dg = d_ag * g * (1 - a * a), d_ag * a * g * (1 - g)
        dh = attention[:, None] * dz + da @ w["attend"].T + dg @ w["gate"].T
        dx = dh * (1 - h * h)
        return {
            "embed": x.T @ dx, "embed0": dx.sum(axis=0), "attend": h.T @ da, "attend0": da.sum(axis=0),
            "gate": h.T @ dg, "gate0": dg.sum(axis=0), "weigh": (a * g).T @ d_logit,
            "out": z.T @ error, "out0": error.sum(axis=0),
        }


def train(docs: DataFrame, labels: DataFrame, training_docs: int = TRAINING_DOCS) -> AttentionModel | None:
    """Fit on a bounded sample of labelled documents that are not held out;
    None if it has no or only one label. Tasks encode the sample; the driver
    gets at most ``training_docs`` whole bags, 104 bytes for each passage of
    ``PASSAGE_WORDS`` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = batch.column(2).to_pylist()
            for start, texts in texts_of(batch, "text"):
                x, sizes = passage_features(texts)
                bags = np.split(x, np.cumsum(sizes)[:-1])
                yield pa.record_batch(
                    [
                        batch.column(0).slice(start, len(texts)),
                        pa.array(keep[start : start + len(texts)], pa.int32()),
                        pa.array([b.astype("<f4").tobytes() for b in bags], pa.binary()),
                    ],
                    names=["doc_id", "label", "bag"],
                )

    sample = labelled_sample(docs, labels, "quality", training_docs).select("doc_id", "text", "label")
    rows = sample.mapInArrow(run, "doc_id long, label int, bag binary").collect()
    rows.sort(key=lambda r: (r["doc_id"], r["bag"]))  # the order of tasks is no input
    y = np.array([r["label"] for r in rows], float)
    if len(set(y.tolist())) < 2:
        return None
    bags = [np.frombuffer(r["bag"], "<f4").reshape(-1, N_FEATURES) for r in rows]
    model = AttentionModel()
    model.fit(np.concatenate(bags).astype(float), np.array([len(b) for b in bags]), y)
    return model


def score_quality(docs: DataFrame, model: AttentionModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``.

    Null and empty texts are one empty passage and are scored like others.
    Without a model (no labels, or one label only) every score is 0.5. Null
    ids and repeated rows pass through; other columns are ignored; an empty
    table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [np.empty(0)]
            for _, texts in texts_of(batch, "text"):
                if shared.value is None:
                    scores.append(np.full(len(texts), 0.5))
                else:
                    scores.append(shared.value.forward(*passage_features(texts))[0])
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(np.concatenate(scores), pa.float64())],
                names=["doc_id", "held_out", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    scored = rows.mapInArrow(run, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: AttentionModel | None, threshold: float = THRESHOLD) -> DataFrame:
    """The documents whose score reaches the threshold, unchanged; they are
    filtered where they are read, without a join."""
    at = docs.columns.index("text")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if shared.value is None:
                yield batch
                continue
            scores = [np.empty(0)] + [shared.value.forward(*passage_features(t))[0] for _, t in texts_of(batch, at)]
            yield batch.filter(pa.array(np.concatenate(scores) >= threshold))

    return map_batches(docs, run, docs.schema)
