"""Benchmark decontamination with a broadcast hash set of n-grams.

Words are runs of ASCII letters and digits or any non-ASCII character, after
lower-casing A-Z. A benchmark item gives its windows of ``WINDOW``
consecutive words; an item with fewer words gives one window of them all.
Every task scans its documents' word windows against the set of window
hashes, verifies each hit word by word, and reports or removes what was hit.
Documents are never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import map_batches, stored, texts_of

WINDOW = 10
#: Characters of benchmark text whose windows are broadcast at once: 20 bytes a
#: word, and some 110 for each different word, so 200 MB in a worker at the very
#: most. A larger benchmark is handled in blocks, one pass over the documents each.
BLOCK_CHARS = 8_000_000

_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


class WindowSet:
    """The windows of some benchmark items: a vocabulary, the items' words as
    one array of its numbers, and for each window length the sorted hashes of
    the windows, with the start of each in that array. Eight to sixteen bytes
    a window, besides the vocabulary."""

    def __init__(self, items: list[tuple[str | None, str]], window: int = WINDOW) -> None:
        numbers: dict[bytes, int] = {}
        words: list[np.ndarray] = []
        starts: dict[int, list[np.ndarray]] = {}
        self.item_ids, bounds, at = [], [], 0
        for item_id, text in items:
            found = words_of(text)
            if not found:
                continue
            words.append(np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in found), np.uint32, len(found)))
            size = min(window, len(found))
            starts.setdefault(size, []).append(np.arange(at, at + len(found) - size + 1, dtype=np.int64))
            self.item_ids.append(item_id)
            bounds.append(at)
            at += len(found)
        self.vocabulary = numbers
        self.words = np.concatenate(words) if words else np.empty(0, np.uint32)
        self.bounds = np.array(bounds, np.int64)
        self.hashes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for size, parts in starts.items():
            places = np.concatenate(parts)
            hashes = _window_hashes(self.words, size)[places]
            order = np.argsort(hashes, kind="stable")  # places of one hash ascend, so an item's are together
            self.hashes[size] = self._once_an_item(hashes[order], places[order], size)

    def _once_an_item(self, hashes: np.ndarray, places: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Without windows equal to the one before them in the same item."""
        item = np.searchsorted(self.bounds, places, "right")
        again = np.flatnonzero((hashes[1:] == hashes[:-1]) & (item[1:] == item[:-1])) + 1
        for j in range(size):
            again = again[self.words[places[again] + j] == self.words[places[again - 1] + j]]
        kept = np.ones(len(places), bool)
        kept[again] = False
        return hashes[kept], places[kept]

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word intervals that windows occur in, and the ids of the
        items they belong to (an item without an id marks words only)."""
        n = len(words)
        ids = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.uint32, n)
        marks, found = None, set()
        unknown = np.flatnonzero(ids == 0)
        longest = int(np.diff(np.r_[-1, unknown, n]).max()) - 1 if n else 0
        for size, (hashes, places) in self.hashes.items():
            if longest < size:
                continue
            seen = _window_hashes(ids, size)
            first = np.searchsorted(hashes, seen)
            first[first == len(hashes)] = 0
            for start in np.flatnonzero(hashes[first] == seen).tolist():
                window = ids[start : start + size]
                hit = False
                for place in places[first[start] : np.searchsorted(hashes, seen[start], "right")].tolist():
                    if np.array_equal(self.words[place : place + size], window):
                        hit = True
                        found.add(self.item_ids[int(np.searchsorted(self.bounds, place, "right")) - 1])
                if hit:
                    if marks is None:
                        marks = np.zeros(n + 1, np.int64)
                    marks[start] += 1
                    marks[start + size] -= 1
        found.discard(None)
        if marks is None:
            return [], found
        inside = np.r_[0, np.cumsum(marks[:n]) > 0, 0].astype(np.int8)
        edges = np.diff(inside)
        return list(zip(np.flatnonzero(edges == 1).tolist(), np.flatnonzero(edges == -1).tolist())), found


def _window_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """A polynomial hash of each ``size`` consecutive ids."""
    ids = ids.astype(np.uint64)
    out = np.zeros(max(len(ids) - size + 1, 0), np.uint64)
    for j in range(size):
        out = out * _MULTIPLIER + ids[j : j + len(out)]
    return out ^ out >> np.uint64(29)


def merge_intervals(intervals: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted(intervals):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def cut_words(text: str, intervals: list[tuple[int, int]]) -> str:
    """``text`` without the word intervals: each goes from the start of its
    first word to the end of its last."""
    raw = text.encode("utf-8", "surrogatepass")
    flat = raw.translate(_WORD_BYTES)
    starts, ends, at = [], [], 0
    for word in flat.split():
        at = flat.index(word, at)
        starts.append(at)
        at += len(word)
        ends.append(at)
    out, last = [], 0
    for a, b in intervals:
        out.append(raw[last : starts[a]])
        last = ends[b - 1]
    return b"".join([*out, raw[last:]]).decode("utf-8", "surrogatepass")


_FOUND = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("stop", T.LongType())]))),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
)


def _scan(docs: DataFrame, items: list[tuple[str | None, str]], window: int, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with ``decon_found``, merged with what is in
    it already."""
    shared = docs.sparkSession.sparkContext.broadcast(WindowSet(items, window))
    names = docs.columns
    own = [k for k, c in enumerate(names) if c in columns]
    before = names.index("decon_found") if "decon_found" in names else None
    text_at = names.index("text")
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("hits", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
            ("items", pa.list_(pa.string())),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        windows = shared.value
        for batch in batches:
            earlier = None if before is None else batch.column(before).to_pylist()
            found = []
            for start, texts in texts_of(batch, text_at):
                for k, text in enumerate(texts, start):
                    words = words_of(text)
                    hits, holders = windows.scan(words)
                    if earlier:
                        hits = merge_intervals(hits + [(h["start"], h["stop"]) for h in earlier[k]["hits"]])
                        holders.update(earlier[k]["items"])
                    found.append(
                        {
                            "n_words": len(words),
                            "hits": [{"start": a, "stop": b} for a, b in hits],
                            "items": sorted(holders),
                        }
                    )
            yield pa.record_batch([*(batch.column(k) for k in own), pa.array(found, kind)], names=[str(k) for k in range(len(own) + 1)])

    schema = T.StructType([*(docs.schema.fields[k] for k in own), T.StructField("decon_found", _FOUND)])
    return map_batches(docs, run, schema)


def find_windows(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
    columns: list[str] | None = None,
) -> DataFrame:
    """``docs`` (or some ``columns`` of it) with ``decon_found``: the number of words, the merged word
    intervals hit, and the ids (as text) of the items hit.

    Null texts have no words on either side; an item without words is never
    hit; a repeated item counts once; an item with a null id hits words like
    any other but is not among the items. An input column named
    ``decon_found`` is dropped.
    """
    docs = docs.drop("decon_found")
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    items = stored(items.distinct(), "benchmark")
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = int(chars // block_chars) + 1
    for block in range(blocks):
        part = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        own = [c for c in docs.columns if c != "decon_found"]
        carried = columns if columns and block == blocks - 1 else own
        docs = _scan(docs, [tuple(r) for r in part.toLocalIterator()], window, carried)
        if blocks > 1:
            docs = stored(docs, "decon")
    return docs


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_hit, n_items,
    items_sha256, contaminated``. Repeated rows give repeated results; an
    empty benchmark hits nothing; an empty table gives an empty result."""
    found = find_windows(docs.select("doc_id", "text"), benchmark, window, block_chars, ["doc_id"])
    hit = F.aggregate("decon_found.hits", F.lit(0).cast("long"), lambda a, h: a + h["stop"] - h["start"])
    return found.select(
        "doc_id",
        F.col("decon_found.n_words").alias("n_words"),
        hit.alias("n_hit"),
        F.size("decon_found.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("decon_found.items")), 256).alias("items_sha256"),
        (F.size("decon_found.hits") > 0).alias("contaminated"),
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window occurs, unchanged."""
    return find_windows(docs, benchmark, window).filter(F.size("decon_found.hits") == 0).drop("decon_found")


def remove_spans(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """All documents, their texts without the words that were hit (a null
    text stays null)."""
    found = find_windows(docs, benchmark, window)
    position = found.columns.index("text")
    schema, at = found.schema, found.columns.index("decon_found")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = batch.column(at).to_pylist()
            texts = batch.column(position).to_pylist()
            cut = [cut_words(t, [(h["start"], h["stop"]) for h in f["hits"]]) if f["hits"] else t for t, f in zip(texts, hits)]
            yield batch.set_column(position, "text", pa.array(cut, pa.string()))

    return map_batches(found, run, schema).drop("decon_found")
