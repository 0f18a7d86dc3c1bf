"""Language identification by prediction by partial matching (PPM).

Each language has a byte context tree up to ``ORDER`` bytes deep. Escape
probabilities are those of PPM method C: in a context seen ``n`` times with
``d`` distinct next bytes, a known byte ``s`` costs ``c(s) / (n + d)`` and
the escape to the next shorter context ``d / (n + d)``; below order 0 all
256 bytes are alike. The statistics are frozen after training, so a text's
code length under a language is exact, and the shortest code wins.

The trees of all languages are laid out as one table of contexts (a context
unknown to every language stands for its longest known suffix), so a task
scores a batch of texts with two array look-ups per byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import held_out, stored, texts_of
from .mixing import hash_uniform

ORDER = 3
#: Training documents taken per language, on average, by a hash of the id.
TRAINING_DOCS = 1500
#: A context seen less often than this in training is left to its suffix.
MIN_CONTEXT = 2
#: Bytes scored at a time in a task.
BYTES_AT_A_TIME = 1 << 20

def fold(text: str) -> bytes:
    return text.lower().encode("utf-8", "surrogatepass")


def _gram_counts(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Counts of all four-byte windows; each text starts after zero bytes."""
    data = np.frombuffer(b"".join(b"\0\0\0" + t for t in texts), np.uint8).astype(np.uint32)
    if len(data) < 4:
        return np.empty(0, np.uint32), np.empty(0, np.int64)
    grams = data[:-3] << 24 | data[1:-2] << 16 | data[2:-1] << 8 | data[3:]
    return np.unique(grams[grams & 0xFF != 0], return_counts=True)


def gram_table(docs: DataFrame) -> DataFrame:
    """``lang, gram, n``: four-byte windows of the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(1).to_pylist()
            for start, texts in texts_of(batch, "text"):
                by_lang: dict[str, list[bytes]] = {}
                for lang, text in zip(langs[start:], texts):
                    by_lang.setdefault(lang, []).append(fold(text))
                for lang, held in by_lang.items():
                    grams, n = _gram_counts(held)
                    yield pa.record_batch(
                        [pa.array([lang] * len(grams), pa.string()), pa.array(grams.astype(np.int64)), pa.array(n.astype(np.int64))],
                        names=["lang", "gram", "n"],
                    )

    rows = docs.select("text", "lang").mapInArrow(run, "lang string, gram long, n long")
    return rows.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class ContextTrees:
    """Frozen statistics of all languages.

    ``symbol_of`` maps bytes to the symbols seen in training (one more for
    all others); ``row_of[c3, c2, c1]`` is the table row of the longest known
    suffix of a context; ``bits[row, symbol, language]`` the code length.
    """

    def __init__(self, counts: list[tuple[str, int, int]], min_context: int = MIN_CONTEXT) -> None:
        self.langs = sorted({lang for lang, _, _ in counts})
        number = {lang: i for i, lang in enumerate(self.langs)}
        lang = np.array([number[c[0]] for c in counts], np.int64)
        gram = np.array([c[1] for c in counts], np.int64)
        n = np.array([c[2] for c in counts], np.float64)
        parts = [gram >> shift & 0xFF for shift in (24, 16, 8, 0)]
        seen = np.unique(np.r_[0, np.concatenate(parts)]) if counts else np.array([0])
        self.symbol_of = np.full(256, len(seen), np.int64)  # the last symbol: any byte not seen
        self.symbol_of[seen] = np.arange(len(seen))
        self.size = size = len(seen) + 1
        parts = [self.symbol_of[p] for p in parts]
        many = max(len(self.langs), 1)
        lowest = np.full((1, size, many), 8.0)
        tables, offsets = [], []
        row_of = np.zeros((), np.int64)  # of the context one shorter
        for order in range(ORDER + 1):
            context = np.zeros(len(gram), np.int64)
            for p in parts[ORDER - order : ORDER]:
                context = context * size + p
            totals = np.bincount(context, n, minlength=size**order)
            known = np.flatnonzero(totals >= min_context) if order else np.array([0])
            rank = np.full(size**order, -1, np.int64)
            rank[known] = np.arange(len(known))
            keep = rank[context] >= 0
            cell = np.zeros((len(known), size, many))
            np.add.at(cell, (rank[context[keep]], parts[ORDER][keep], lang[keep]), n[keep])
            total = cell.sum(axis=1, keepdims=True)
            distinct = (cell > 0).sum(axis=1, keepdims=True)
            if order:
                suffix = row_of[known % size ** (order - 1)]  # drop the oldest byte
                shorter = np.concatenate(tables)[suffix]
            else:
                shorter = lowest
            with np.errstate(divide="ignore", invalid="ignore"):
                direct = -np.log2(cell / (total + distinct))
                escape = np.where(total > 0, -np.log2(distinct / (total + distinct)), 0.0) + shorter
            table = np.where(cell > 0, direct, escape)
            offsets.append(sum(len(t) for t in tables))
            tables.append(table)
            base = np.tile(row_of.ravel(), size) if order else np.zeros(1, np.int64)
            row_of = np.where(rank >= 0, rank + offsets[-1], base)
        self.bits = np.concatenate(tables).astype(np.float32).reshape(-1, many)
        self.row_of = row_of.astype(np.int32)

    def code_lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits of each text under each language, ``(texts, languages)``."""
        out = np.zeros((len(texts), self.bits.shape[1]))
        start = 0
        while start < len(texts):
            stop, held = start, 0
            while stop < len(texts) and (stop == start or held + len(texts[stop]) <= BYTES_AT_A_TIME):
                held += len(texts[stop]) + ORDER
                stop += 1
            part = texts[start:stop]
            s = self.symbol_of[np.frombuffer(b"".join(b"\0" * ORDER + t for t in part), np.uint8)]
            context = (s[:-3] * self.size + s[1:-2]) * self.size + s[2:-1]
            index = self.row_of[context].astype(np.int64) * self.size + s[3:]
            cost = np.zeros((len(s), self.bits.shape[1]))
            cost[3:] = self.bits[index]
            sizes = np.array([len(t) for t in part])
            begins = np.cumsum(sizes + ORDER) - sizes
            total = np.r_[np.zeros((1, cost.shape[1])), np.cumsum(cost, axis=0)]
            out[start:stop] = total[begins + sizes] - total[begins]
            start = stop
        return out

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray]:
        """Language and score: the probability of the shortest code against
        the others, all languages alike beforehand; ``und`` and 0 for a text
        without a letter."""
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts))
        lengths = self.code_lengths([fold(t) for t in texts])
        best = lengths.argmin(axis=1)
        gap = np.minimum(lengths - lengths.min(axis=1, keepdims=True), 1000.0)
        score = 1 / np.exp2(-gap).sum(axis=1)
        lettered = [any(map(str.isalpha, t)) for t in texts]  # a character of category L
        return (
            [self.langs[b] if ok else "und" for b, ok in zip(best, lettered)],
            np.where(lettered, score, 0.0),
        )


def train(docs: DataFrame, training_docs: int = TRAINING_DOCS) -> ContextTrees:
    """Context trees from documents that are not held out and have a
    language. Per language about ``training_docs`` documents are taken (all,
    if it has no more), by a hash of the id; counts are gathered by Spark,
    and what reaches the driver is one row per distinct window."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    rate = F.lit(1.0)
    for lang, n in sizes.items():
        rate = F.when(F.col("lang") == lang, F.lit(min(1.0, training_docs / n))).otherwise(rate)
    sample = known.filter(hash_uniform(F.col("doc_id"), F.lit("langid")) < rate)
    counts = stored(gram_table(sample), "langid-grams")
    return ContextTrees([tuple(r) for r in counts.collect()])


def identify(docs: DataFrame, trees: ContextTrees) -> DataFrame:
    """One row per document: ``doc_id, held_out, lang_pred, score``.

    ``und`` with score 0 for a null text, one without a letter, or when
    nothing could be learned. Ties go to the first language by name. Null
    ids (not learned from, as held out) and repeated rows pass through; other
    columns are ignored; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs, scores = [], []
            for _, texts in texts_of(batch, "text"):
                found, score = shared.value.predict(texts)
                langs += found
                scores.append(score)
            scores = np.concatenate(scores) if scores else np.empty(0)
            yield pa.record_batch(
                [batch.column(0), batch.column(2), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", held_out(F.col("doc_id")).alias("held_out"))
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
