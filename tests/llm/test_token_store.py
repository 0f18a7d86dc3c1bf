"""Token files: exact encoding, round trips, seeks and damage."""

import io
import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF_SMALL
from evstar.llm.token_file import CorruptFile, Reader, Writer
from evstar.llm.token_store import Encoder, encoder, token_output, vocabulary_path, write_tokens

NAME = "byte_bpe_50k.json"


def whole(text):
    return encoder(NAME).tokenizer.encode(text, add_special_tokens=False).ids


@given(st.lists(st.text(alphabet="aZé1'. \n\t\r  \x1c\x85<|endoftext>", max_size=30), max_size=5))
@settings(max_examples=200, deadline=None, derandomize=True)
def test_pieces_give_the_ids_of_whole_texts(texts):
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder(NAME).encode(texts)] == [whole(t) for t in texts]


def test_special_text_and_contractions():
    texts = ["a <|endoftext|> b", "<|endoftext|>", "don't we'll I'm\nit's", " x", "x ", "", "a  b", "日本 語\nт ест 12 3"]
    assert [np.frombuffer(b, "<u2").tolist() for b in encoder(NAME).encode(texts)] == [whole(t) for t in texts]


def test_cache_is_bounded(monkeypatch):
    import evstar.llm.token_store as store

    monkeypatch.setattr(store, "CACHED_PIECES", 50)
    enc = store.Encoder(vocabulary_path(NAME))
    texts = [f"word{i} other{i} third{i}" for i in range(200)]
    for t in texts:
        assert np.frombuffer(enc.encode([t])[0], "<u2").tolist() == whole(t)
    assert len(enc.spaced) + len(enc.plain) < 60


def write(docs, frame_bytes=64):
    sink = io.BytesIO()
    writer = Writer(sink, 4, frame_bytes)
    for doc_id, ids in docs:
        writer.add(doc_id, np.array(ids, "<u4").tobytes())
    assert writer.finish() == sum(len(i) for _, i in docs)
    return sink.getvalue()


DOCS = [(1, [1, 2, 3]), (1, [9]), (None, []), (5, list(range(100))), (7, [0]), (8, [4, 4, 4, 4])]


def test_pieces_of_one_text_are_held_at_a_time():
    import tracemalloc

    enc = Encoder(vocabulary_path("byte_bpe_50k.json"))
    texts = [" ".join(["plain", "words", "again,", "übermut"] * 2000)] * 100
    one = enc.encode(texts[:1])
    tracemalloc.start()
    assert enc.encode(texts) == one * 100
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * len(one[0]) + (4 << 20)  # the ids, and not 800,000 pieces


def test_file_round_trip_and_seek():
    data = write(DOCS)
    reader = Reader(io.BytesIO(data))
    assert [(i, ids.tolist()) for i, ids in reader.documents()] == DOCS
    assert [x.tolist() for x in reader.lookup(1)] == [[1, 2, 3], [9]] and reader.lookup(6) == []
    assert len(reader.frames) > 1
    read = []
    reader._at = lambda offset, size, at=reader._at: read.append((offset, size)) or at(offset, size)
    assert reader.lookup(7)[0].tolist() == [0]
    assert len(read) == 1 and read[0][1] < len(data)  # one frame only


def test_any_zstandard_reader_reads_the_frames():
    data = write(DOCS)
    plain = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(data), read_across_frames=True).read()
    assert np.frombuffer(plain, "<u4").tolist() == [x for _, ids in DOCS for x in ids]


def test_damage_never_gives_other_ids():
    data, noticed = write(DOCS), 0
    for at in range(len(data)):
        broken = bytearray(data)
        broken[at] ^= 0x10
        try:  # a bit that no decoder looks at may go unnoticed
            got = [(i, ids.tolist()) for i, ids in Reader(io.BytesIO(bytes(broken))).documents()]
            assert got == DOCS, at
        except (CorruptFile, zstandard.ZstdError):
            noticed += 1
    assert noticed > 0.9 * len(data)
    for size in (0, 5, len(data) // 2):
        with pytest.raises(CorruptFile):
            Reader(io.BytesIO(data[:size]))


def test_empty_file():
    reader = Reader(io.BytesIO(write([])))
    assert list(reader.documents()) == []


def expected(rows):
    at, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*whole(text or ""), 0]
        out.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_documents_table_round_trip(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = sorted(map(tuple, token_output(docs).collect()), key=lambda r: r[1])
    assert got == expected([(r["doc_id"], r["text"]) for r in docs.collect()])


def test_awkward_rows(spark):
    rows = [(4, None), (2, ""), (9, "long text " * 30_000), (2, ""), (None, "null id"), (3, "tab\there")]
    docs = spark.createDataFrame([(i, t, 1, "f") for i, t in rows], "doc_id long, text string, start int, file string")
    got = sorted(map(tuple, token_output(docs).collect()), key=lambda r: r[1])
    assert got == expected(rows)
    assert token_output(docs.limit(0)).count() == 0


def test_manifest_names_the_counted_files(spark, tmp):
    docs = spark.range(50).selectExpr("id as doc_id", "concat('text ', id) as text")
    manifest = write_tokens(docs, f"file://{tmp}/out").orderBy("part").collect()
    assert sum(r["n_docs"] for r in manifest) == 50
    assert [r["first_token"] for r in manifest] == [sum(x["n_tokens"] for x in manifest[:k]) for k in range(len(manifest))]
