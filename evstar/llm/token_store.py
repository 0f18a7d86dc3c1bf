"""Token-id output: documents encoded, written in ``doc_id`` order to files
of independent zstandard frames with seek tables, and read back."""

from __future__ import annotations

import sys
import zlib
from array import array
from codecs import charmap_decode
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import scratch, shuffle_partitions, stored, texts_of
from .token_file import Reader, Writer

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
#: Pieces kept in a worker's cache before it starts anew (bounds its memory).
CACHED_PIECES = 800_000

#: Signs that, after letters and before white space, are one token run.
_SIGNS = ".,;:!?&%$#*)"


def _byte_characters() -> str:
    """How byte-level tokenizers show the 256 bytes: visible Latin-1
    characters as they are, the others from code point 256 on, in byte order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return "".join(chr(b if b in shown else next(others)) for b in range(256))


_BYTE_CHARACTERS = _byte_characters()
_encoders: dict[str, Encoder] = {}


class Encoder:
    """Packed ids of texts by a tokenizer of the ``tokenizers`` library.

    The tokenizers here are byte-level: they first cut a text before each
    single space, and around each single newline, that stands between two
    other characters, and between letters and the signs after them; so no
    token crosses such a place, and the ids of the pieces, joined, are the
    ids of the text. Words repeat, so each piece is encoded once and kept.
    A text with any other white space is encoded whole.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.id_bytes = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.code = "H" if self.id_bytes == 2 else "I"
        self.spaced: dict[str, bytes] = {}  # pieces with a space before them
        self.plain: dict[str, bytes] = {}
        self.newline = self._ids("\n")

    def _bytes(self, ids: list[int]) -> bytes:
        packed = array(self.code, ids)
        if sys.byteorder == "big":
            packed.byteswap()
        return packed.tobytes()

    def _ids(self, text: str) -> bytes:
        return self._bytes(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _learn(self, known: dict[str, bytes], words: set[str], prefix: str) -> None:
        """Add the ids of words without white space."""
        whole, ended = set(), []  # encoded as they are; letters with signs after them
        for w in words:
            if w.isalpha():
                whole.add(w)
                continue
            base = w.rstrip(_SIGNS)
            if base != w and base.isalpha():
                ended.append((w, base))
                whole.add(base)
            else:
                whole.add(w)
        tokenize = self.tokenizer.model.tokenize
        for w in whole:
            if w in known:
                continue
            if w.isalpha():  # one pre-token: straight to the merges
                shown = charmap_decode((prefix + w).encode(), "strict", _BYTE_CHARACTERS)[0]
                known[w] = self._bytes([t.id for t in tokenize(shown)])
            else:
                known[w] = self._ids(prefix + w)
        for w, base in ended:
            if w in known:
                continue
            signs = w[len(base) :]
            if signs not in self.plain:
                self.plain[signs] = self._ids(signs)
            known[w] = known[base] + self.plain[signs]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The packed ids of each text."""
        if len(self.spaced) + len(self.plain) > CACHED_PIECES:
            self.spaced.clear()
            self.plain.clear()
        # one text after the other: its pieces stay in the processor's cache until they are joined
        return [self._encoded(text) for text in texts]

    def _encoded(self, text: str) -> bytes:
        pieces = text.split(" ")
        found = [self.plain.get(pieces[0]), *map(self.spaced.get, pieces[1:])]
        if None in found:
            missing = [k for k, ids in enumerate(found) if ids is None]
            new = [pieces[k] for k in missing]
            joined = "\n".join(new)
            words = joined.split("\n")
            if joined.split() != words:  # a kept piece has no white space; new ones are checked here
                return self._ids(text)  # white space other than single spaces and newlines
            firsts: set[str] = set()  # words without a space before them
            heads = new
            if len(words) != len(new):
                firsts.update(w for p in new if "\n" in p for w in p.split("\n")[1:])
                heads = [p.split("\n", 1)[0] for p in new]
            if missing[0] == 0:
                firsts.add(heads[0])
                heads = heads[1:]
            self._learn(self.plain, firsts, "")
            self._learn(self.spaced, set(heads), " ")
            for k in missing:
                known = self.spaced if k else self.plain
                found[k] = known.get(pieces[k])
                if found[k] is None:
                    first, *rest = pieces[k].split("\n")
                    found[k] = self.newline.join([known[first], *map(self.plain.__getitem__, rest)])
        return b"".join(found)


def vocabulary_path(name: str) -> str:
    """A path as it is; a bare name is a file of the tokenizer package."""
    if "/" in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def encoder(name: str) -> Encoder:
    """This worker's encoder for a vocabulary."""
    if name not in _encoders:
        _encoders[name] = Encoder(vocabulary_path(name))
    return _encoders[name]


def write_tokens(
    docs: DataFrame, folder: str, vocabulary: str = VOCABULARY, end_id: int = END_ID, by_id: bool = True
) -> DataFrame:
    """Encode and write all documents; the manifest, one row per file in
    document order: ``part, file, n_docs, n_tokens, first_token`` (ids in all
    files before it).

    Null texts are empty and give only the end id. Documents come by
    ``doc_id`` (null ids first, rows of one id after each other), or, without
    ``by_id``, as ``docs`` has them: a file for each of its partitions, and
    nothing is exchanged. Every task attempt writes a file of its
    own, and the manifest names those of the attempts that counted, so a lost
    or repeated task leaves no trace in it. An empty table gives an empty
    manifest.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        enc = encoder(vocabulary)
        end = np.array([end_id], f"<u{enc.id_bytes}").tobytes()
        name = f"{folder}/part-{context.partitionId():05d}-{context.taskAttemptId()}.tokens.zst"
        store, path = fs.FileSystem.from_uri(name)
        writer = sink = None
        n_docs = 0
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for start, texts in texts_of(batch, "text"):
                if writer is None:
                    store.create_dir(path.rpartition("/")[0], recursive=True)
                    sink = store.open_output_stream(path, compression=None)
                    writer = Writer(sink, enc.id_bytes)
                for doc_id, packed in zip(ids[start:], enc.encode(texts)):
                    writer.add(doc_id, packed + end)
                    n_docs += 1
        if writer is not None:
            total = writer.finish()
            sink.close()
            yield pa.record_batch(
                [pa.array([v], t) for v, t in ((context.partitionId(), pa.int32()), (name, pa.string()), (n_docs, pa.int64()), (total, pa.int64()))],
                names=["part", "file", "n_docs", "n_tokens"],
            )

    rows = docs.select(F.col("doc_id").cast("long"), "text", F.monotonically_increasing_id().alias("row"))
    if by_id:
        rows = rows.repartitionByRange(shuffle_partitions(docs.sparkSession), "doc_id", "row").sortWithinPartitions("doc_id", "row")
    files = rows.mapInArrow(run, "part int, file string, n_docs long, n_tokens long")
    files = stored(files, "token-manifest")  # the files exist once, and only committed attempts count
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("first_token", F.coalesce(F.sum("n_tokens").over(before), F.lit(0).cast("long")))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start`` (ids of all documents
    before it), ``n_tokens`` and ``ids_crc32`` (over the ids as little-endian
    unsigned 32-bit integers). Every frame's checksum is verified."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = fs.FileSystem.from_uri(row["file"])
                at, out = row["first_token"], []
                with store.open_input_file(path) as source:
                    for doc_id, ids in Reader(source).documents():
                        out.append((doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        at += len(ids)
                columns = zip(*out)
                yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = stored(manifest, "token-files")
    spread = files.repartition(shuffle_partitions(files.sparkSession), "file")
    return spread.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def token_output(docs: DataFrame, vocabulary: str = VOCABULARY, end_id: int = END_ID, by_id: bool = True) -> DataFrame:
    """Write the documents' ids under the shared folder and read them back."""
    folder = scratch(docs.sparkSession, "tokens")
    return read_tokens(write_tokens(docs, folder, vocabulary, end_id, by_id))
