"""Slices of batches, and the held-out rule."""

import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from evstar.llm import common


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_texts_come_in_bounded_slices(monkeypatch, kind):
    monkeypatch.setattr(common, "ROWS_AT_A_TIME", 3)
    monkeypatch.setattr(common, "BYTES_AT_A_TIME", 10)
    texts = ["a", None, "", "b" * 4, "é" * 40, "c" * 9, "d", "e" * 5, "f" * 5, None, None, None, None]
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts, kind)], names=["doc_id", "text"])
    slices = list(common.texts_of(batch, "text"))
    assert [t for _, part in slices for t in part] == [t or "" for t in texts]
    assert [start for start, _ in slices] == [sum(len(p) for _, p in slices[:k]) for k in range(len(slices))]
    assert all(len(p) <= 3 and (len(p) == 1 or sum(len(t.encode()) for t in p) <= 10) for _, p in slices)
    assert list(common.texts_of(batch.slice(0, 0), "text")) == []
    assert [t for _, part in common.texts_of(batch.slice(4, 3), "text") for t in part] == ["é" * 40, "c" * 9, "d"]


def test_held_out_is_crc32_of_the_id_as_text(spark):
    ids = [0, 1, 7, -3, 10**12, None]
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", common.held_out(F.col("doc_id"))).collect()
    assert [tuple(r) for r in rows] == [(i, zlib.crc32(b"" if i is None else str(i).encode()) % 5 == 0) for i in ids]
