"""Ranked lexical search turned round: the items are indexed, the documents
stream by.

Documents become term counts once (only the items' terms are kept, next to
the number of all terms) and are written to the shared folder; corpus counts
come from these. The inverted index from terms to items is broadcast; every
task streams its documents' counts through it, keeps the best documents of
each item in a bounded heap, and hands over its heaps, which are merged item
by item. Items beyond a size go in blocks, one pass over the documents each.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from .common import stored, texts_of
from .decontaminate import words_of

TOP = 10
#: Characters of item text whose index is broadcast at once.
BLOCK_CHARS = 8_000_000
#: Length normalisation of the score, in hundredths.
LENGTH_PERCENT = 90

_COUNTS = "doc_id long, n long, terms array<int>, tfs array<long>"


class ItemIndex:
    """Terms numbered in order of their bytes, and for each term the items
    that hold it (as slices of one array)."""

    def __init__(self, item_terms: list[set[bytes]]) -> None:
        self.terms = {t: k for k, t in enumerate(sorted(set().union(*item_terms)))}
        held: list[list[int]] = [[] for _ in self.terms]
        for item, terms in enumerate(item_terms):
            for t in terms:
                held[self.terms[t]].append(item)
        self.sizes = np.array([len(h) for h in held], np.int64)
        self.starts = np.r_[0, np.cumsum(self.sizes)]
        self.items = np.array([i for h in held for i in h], np.int64)
        self.n_items = len(item_terms)

    def scores(self, terms: np.ndarray, parts: np.ndarray) -> np.ndarray:
        """Each item's sum of ``parts`` over its terms among ``terms``."""
        sizes = self.sizes[terms]
        ends = np.cumsum(sizes)
        rows = np.repeat(self.starts[terms] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)
        out = np.zeros(self.n_items, np.int64)
        np.add.at(out, self.items[rows], np.repeat(parts, sizes))
        return out


class Heaps:
    """The ``top`` best ``(score, document)`` of each item: higher scores
    first, then smaller ids (null ids after all others)."""

    def __init__(self, n_items: int, top: int) -> None:
        self.top, self.held = top, [[] for _ in range(n_items)]
        self.least = np.ones(n_items, np.int64)  # a score below this cannot enter

    def update(self, scores: np.ndarray, doc_id: int | None) -> None:
        rank = (doc_id is None, 0 if doc_id is None else doc_id)
        for item in np.flatnonzero(scores >= self.least).tolist():
            heap, entry = self.held[item], (int(scores[item]), not rank[0], -rank[1])
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            else:
                heapq.heappushpop(heap, entry)
            if len(heap) == self.top:
                self.least[item] = max(heap[0][0], 1)

    def rows(self) -> Iterator[tuple[int, int | None, int]]:
        for item, heap in enumerate(self.held):
            for score, named, minus_id in heap:
                yield item, -minus_id if named else None, score


def term_counts(docs: DataFrame, index) -> DataFrame:
    """``doc_id``, the number ``n`` of all terms, and the counts of those
    terms that the (broadcast) index holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = index.value.terms
        for batch in batches:
            for start, texts in texts_of(batch, "text"):
                sizes, terms, tfs = [], [], []
                for text in texts:
                    words = words_of(text)
                    counts = Counter(words)
                    own = [(known[w], c) for w, c in counts.items() if w in known]
                    sizes.append(len(words))
                    terms.append([t for t, _ in own])
                    tfs.append([c for _, c in own])
                ids = batch.column(0).slice(start, len(texts))
                columns = [ids, pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.int32())), pa.array(tfs, pa.list_(pa.int64()))]
                yield pa.record_batch(columns, names=["doc_id", "n", "terms", "tfs"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _COUNTS)


def best_of_tasks(counts: DataFrame, index, weights: np.ndarray, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """``(item, doc_id, score)``: every task's heaps over its documents."""
    weights = counts.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heaps = Heaps(index.value.n_items, top)
        for batch in batches:
            ids, sizes = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            offsets = batch.column(2).offsets.to_numpy()
            terms = batch.column(2).values.to_numpy()
            tfs = batch.column(3).values.to_numpy()
            for k, (doc_id, n) in enumerate(zip(ids, sizes)):
                a, b = offsets[k], offsets[k + 1]
                if a == b:
                    continue
                t, tf = terms[a:b], tfs[a:b]
                m = 100 - LENGTH_PERCENT + LENGTH_PERCENT * n * n_docs // n_terms
                parts = weights.value[t] * (1_000_000_000 * tf // (1000 * tf + 8 * m))
                heaps.update(index.value.scores(t, parts), doc_id)
        found = list(heaps.rows())
        columns = list(zip(*found)) or [[], [], []]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["item", "doc_id", "score"])

    return counts.mapInArrow(run, "item long, doc_id long, score long")


def _search_block(docs: DataFrame, items: list[tuple], item_type: T.DataType, top: int) -> DataFrame:
    spark = docs.sparkSession
    by_id: dict[object, set[bytes]] = {}
    for item_id, text in items:
        by_id.setdefault(item_id, set()).update(words_of(text))
    index = spark.sparkContext.broadcast(ItemIndex(list(by_id.values())))
    counts = stored(term_counts(docs, index), "search-counts")
    corpus = counts.agg(F.count_if(F.col("n") > 0).alias("docs"), F.sum("n").alias("terms")).first()
    n_docs, n_terms = corpus["docs"] or 0, corpus["terms"] or 0
    held = counts.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    ratio = F.lit(float(2 * n_docs + 2)) / (2 * F.col("df") + 1).cast("double")
    weighed = held.select("term", F.floor(F.lit(1000.0) * F.log(ratio)).cast("long").alias("w"))
    weights = np.zeros(len(index.value.terms), np.int64)
    for r in weighed.toLocalIterator():  # at most the index's terms
        weights[r["term"]] = r["w"]
    best = best_of_tasks(counts, index, weights, n_docs, n_terms, top)
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
    ranked = best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
    ids = spark.createDataFrame(
        list(enumerate(by_id)), T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", item_type)])
    )
    return ranked.join(F.broadcast(ids), "item").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, top: int = TOP, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` documents with a
    score above 0, by score, then by ``doc_id`` (null ids last).

    - Null and empty texts have no terms; an item or a table without any term
      gives no row.
    - Rows that share an ``item_id`` (null is an id too) are one item with the
      terms of all of them; documents that repeat are ranked one by one.
    - Other columns are ignored.
    """
    item_type = items.schema["item_id"].dataType
    found = items.select("item_id", F.coalesce("text", F.lit("")).alias("text")).distinct()
    found = stored(found, "search-items")
    chars = found.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(chars // block_chars) + 1
    out = None
    for block in range(blocks):
        part = found.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block)
        ranked = _search_block(docs, [tuple(r) for r in part.toLocalIterator()] or [(None, "")], item_type, top)
        out = ranked if out is None else out.unionByName(ranked)
    return out
