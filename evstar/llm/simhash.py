"""SimHash near-dedup with bit-sliced comparison.

Fingerprints: 64 majority bits over the XXH64 of a document's word shingles.
Equal fingerprints are merged first, so the rest works on distinct ones.

Candidates: the 64 bits are cut into ``CHUNKS`` equal chunks. Two
fingerprints within ``r`` bits agree on at least ``CHUNKS - r`` chunks, so
one copy of a fingerprint per choice of ``r`` chunks to ignore, keyed by the
rest, brings every such pair together. With the production radius a bucket's
key fixes 48 of 64 bits: no bucket can hold over 65,536 distinct
fingerprints, however the data are skewed.

Comparison: the fingerprints of a run of buckets lie in 64 vertical bit
planes. At each lag the planes are compared with their own shift, so one
word operation updates 64 distances, held in carry-save counters; a lag is
abandoned when every pair still of interest exceeds the radius.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import noted, passing_copies, stored, texts_of
from .components import connected_components
from .rows import as_files, keep_rows, with_place

SHINGLE_WORDS = 3
RADIUS = 2
CHUNKS = 8
SEED = 42
#: Buckets up to this size are compared together, larger ones alone.
SMALL_BUCKET = 64
#: Links kept before they are reduced to one per fingerprint.
LINKS_AT_A_TIME = 1 << 20

_BITS = np.array([[v >> b & 1 for b in range(8)] for v in range(256)], dtype=np.int64)
_BYTE_OF = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Signed 64-bit SimHash: words are runs of anything but ASCII white
    space after lower-casing A-Z; fewer words than a shingle make one
    shingle; no word gives 0. A bit is set if over half the hashes have it."""
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(shingle_words))) if len(words) >= shingle_words else [words]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, shingles), repeat(SEED)), np.uint64)
    parts = hashes.view(np.uint8).reshape(-1, 8) + _BYTE_OF
    counts = np.bincount(parts.ravel(), minlength=2048).reshape(8, 256) @ _BITS
    bits = (counts.ravel() * 2 > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, key: str = "doc_id") -> DataFrame:
    """``(key, fp)`` for every row; a null text has no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [fingerprint(t, shingle_words) for _, texts in texts_of(batch, "text") for t in texts]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.int64())], names=[key, "fp"])

    rows = docs.select(F.col(key).cast("long") if key == "doc_id" else key, "text")
    return rows.mapInArrow(run, T.StructType([rows.schema[key], T.StructField("fp", T.LongType())]))


def _planes(fps: np.ndarray) -> list[int]:
    """Bit plane b as one integer whose bit k is bit b of fingerprint k."""
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    packed = np.packbits(bits, axis=0, bitorder="little")
    return [int.from_bytes(packed[:, b].tobytes(), "little") for b in range(64)]


def _mask(flags: np.ndarray) -> int:
    return int.from_bytes(np.packbits(flags, bitorder="little").tobytes(), "little")


def _lanes(mask: int, n: int) -> np.ndarray:
    raw = np.frombuffer(mask.to_bytes((n + 7) // 8, "little"), np.uint8)
    return np.flatnonzero(np.unpackbits(raw, bitorder="little"))


def _within(planes: list[int], lag: int, alive: int, radius: int) -> int:
    """The lanes of ``alive`` whose distance to the lane ``lag`` further on
    is at most ``radius``. The counters start so that passing the radius
    overflows them."""
    width = radius.bit_length()
    bias = (1 << width) - 1 - radius
    counters = [alive if bias >> i & 1 else 0 for i in range(width)]
    for plane in planes:
        carry = (plane ^ plane >> lag) & alive
        for i, c in enumerate(counters):
            counters[i], carry = c ^ carry, c & carry
            if not carry:
                break
        alive &= ~carry
        if not alive:  # the whole block exceeds the radius
            return 0
    return alive


def bit_sliced_links(fps: np.ndarray, bucket: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs, lag by lag, of fingerprints in the same bucket (buckets
    lie together) within ``radius``."""
    if len(fps) < 2:
        return
    planes, n = _planes(fps), len(fps)
    longest = int(np.diff(np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])).max())
    for lag in range(1, longest):
        same = _mask(bucket[:-lag] == bucket[lag:])
        if same and (near := _within(planes, lag, same, radius)):
            left = _lanes(near, n)
            yield left, left + lag


def _smallest(n: int, left: np.ndarray, right: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Each lane's smallest linked lane, by pointer jumping."""
    left, right = np.r_[left, np.arange(n)], np.r_[right, label]
    label = np.arange(n)
    while True:
        new = label.copy()
        low = np.minimum(label[left], label[right])
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        while not np.array_equal(jump := new[new], new):
            new = jump
        if np.array_equal(new, label):
            return label
        label = new


def star_links(fps: np.ndarray, bucket: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what the bucket's links join: from each fingerprint
    to the first of its group (at most one link per fingerprint)."""
    n = len(fps)
    label, held, size = np.arange(n), [], 0
    for pair in bit_sliced_links(fps, bucket, radius):
        held.append(pair)
        size += len(pair[0])
        if size >= LINKS_AT_A_TIME:
            label = _smallest(n, *map(np.concatenate, zip(*held)), label)
            held, size = [], 0
    if held:
        label = _smallest(n, *map(np.concatenate, zip(*held)), label)
    moved = np.flatnonzero(label != np.arange(n))
    return fps[moved], fps[label[moved]]


def _compare_sorted(radius: int):
    """Over rows (key, fp) sorted by both: the links of each key's rows."""

    def link(keys: np.ndarray, fps: np.ndarray) -> Iterator[pa.RecordBatch]:
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        of_row = np.repeat(sizes, sizes)
        groups = [(of_row > 1) & (of_row <= SMALL_BUCKET)]
        for s, size in zip(starts[sizes > SMALL_BUCKET], sizes[sizes > SMALL_BUCKET]):
            groups.append(slice(s, s + size))
        for rows in groups:
            a, b = star_links(fps[rows].view(np.uint64), keys[rows], radius)
            if len(a):
                yield pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.int64)
        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy()]
            fps = np.r_[fps, batch.column(1).to_numpy()]
            cut = int(np.searchsorted(keys == keys[-1], True))  # the last bucket may go on
            yield from link(keys[:cut], fps[:cut])
            keys, fps = keys[cut:], fps[cut:]
        yield from link(keys, fps)

    return run


def near_links(distinct: DataFrame, radius: int = RADIUS, chunks: int = CHUNKS) -> DataFrame:
    """Links ``(a, b)`` between fingerprints ``fp`` of ``distinct`` that
    join exactly what all pairs within ``radius`` join."""
    if not 0 < radius < chunks or 64 % chunks:
        raise ValueError("needs 0 < radius < chunks, and chunks dividing 64")
    width = 64 // chunks
    keys = []
    for ignored in combinations(range(chunks), radius):
        kept = ~sum(((1 << width) - 1) << (c * width) for c in ignored) & (2**64 - 1)
        signed = kept - 2**64 if kept >= 2**63 else kept
        keys.append(F.xxhash64(F.lit(len(keys)), F.col("fp").bitwiseAND(F.lit(signed))))
    rows = distinct.select(F.explode(F.array(*keys)).alias("key"), "fp")
    rows = rows.repartition("key").sortWithinPartitions("key", "fp")
    return rows.mapInArrow(_compare_sorted(radius), "a long, b long").distinct()


def simhash_groups(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per document: ``doc_id, fingerprint, component_id`` (the
    smallest ``doc_id`` that links of at most ``radius`` bits reach).

    - Null, empty and all-white texts have fingerprint zero and are linked
      like any other.
    - A null ``doc_id`` joins its component but never names it; a component
      of null ids only has a null ``component_id``.
    - Repeated rows give repeated result rows; an empty table an empty one;
      other columns are ignored.
    """
    prints = stored(fingerprints(docs, shingle_words), "simhash")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash-distinct")
    roots = connected_components(near_links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    rooted = stored(rooted, "simhash-roots")
    names = stored(rooted.groupBy("root").agg(F.min("first_id").alias("component_id")), "simhash-names")
    named = stored(rooted.select("fp", "root").join(names, "root").select("fp", "component_id"), "simhash-named")
    return prints.join(named, "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"
    )


def _rows_of(prints: DataFrame, radius: int) -> DataFrame:
    """The place of one row of each component of ``prints`` (``fp`` with the
    row's ``place``): the smallest place."""
    distinct = stored(prints.groupBy("fp").agg(F.min("place").alias("first")), "simhash-distinct")
    roots = connected_components(near_links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left")
    first = rooted.groupBy(F.coalesce("root", "fp").alias("root")).agg(F.min("first").alias("first"))
    return first.select("first.file", "first.place")


def keep_one_row(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, radius: int = RADIUS) -> DataFrame:
    """One row of each component, unchanged: one with its smallest ``doc_id``
    (null ids only where it has no other; of equal ids the first by file and
    place). Repeated rows and repeated ids go as well. Texts are read twice
    and never exchanged; what is chosen are rows of the files ``docs`` reads."""
    spark, docs = docs.sparkSession, as_files(docs)
    with passing_copies(spark) as copies:
        rows = with_place(docs.select("doc_id", "text"), "file", "place")
        doc_id = F.col("doc_id").cast("long")
        order = F.struct(doc_id.isNull().alias("unnamed"), doc_id.alias("doc_id"), "file", "place")
        chosen = _rows_of(fingerprints(rows.select(order.alias("place"), "text"), shingle_words, "place"), radius)
        kept = keep_rows(docs, chosen)
        lists = copies.pop()  # read with the result
    noted(lists)
    return kept
