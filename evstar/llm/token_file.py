"""A file of token ids in independent zstandard frames with a seek table.

Layout, all integers little-endian:

- data frames: each an ordinary zstandard frame over the ids (unsigned 16 or
  32 bits) of some whole documents; any zstandard tool reads them;
- a skippable frame with the document index: magic ``0x184D2A50``, its size,
  then a zstandard frame over int64 columns ``doc_id, is_null, frame, first
  id in frame, number of ids``, preceded by the number of documents and the
  bytes of an id;
- a skippable frame with the seek table of the zstandard seekable format:
  magic ``0x184D2A5E``, its size, per frame its compressed size, its plain
  size and the low half of the XXH64 of its plain bytes (unsigned 32 bits
  each), then the number of frames, the descriptor byte with the checksum
  flag, and the magic ``0x8F92EAB1``.

A reader takes the tail, then only the frames of the documents it wants, and
checks each frame before use.
"""

from __future__ import annotations

import struct
from collections.abc import Iterable, Iterator

import numpy as np
import xxhash
import zstandard

# Fixed values of the zstandard seekable format.
INDEX_MAGIC = 0x184D2A50
SEEK_TABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
CHECKSUM_FLAG = 0x80

#: Plain bytes after which a frame is closed (always after a whole document).
FRAME_BYTES = 1 << 18
LEVEL = 3


class CorruptFile(ValueError):
    """A frame or a table does not match its checksum or its size."""


class Writer:
    """Writes documents to a binary sink; holds one frame and the index."""

    def __init__(self, sink, id_bytes: int = 4, frame_bytes: int = FRAME_BYTES) -> None:
        self.sink, self.id_bytes, self.frame_bytes = sink, id_bytes, frame_bytes
        self.pack = zstandard.ZstdCompressor(level=LEVEL)
        self.held: list[bytes] = []
        self.size = 0
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        """One document; ``ids`` are its packed ids."""
        self.index.append(
            (doc_id or 0, int(doc_id is None), len(self.frames), self.size // self.id_bytes, len(ids) // self.id_bytes)
        )
        self.held.append(ids)
        self.size += len(ids)
        if self.size >= self.frame_bytes:
            self._close_frame()

    def _close_frame(self) -> None:
        plain = b"".join(self.held)
        packed = self.pack.compress(plain)
        self.sink.write(packed)
        self.frames.append((len(packed), len(plain), xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF))
        self.held, self.size = [], 0

    def finish(self) -> int:
        """Write the tables; the total number of ids."""
        if self.held:
            self._close_frame()
        columns = np.array(self.index, "<i8").reshape(-1, 5).T.tobytes()
        body = struct.pack("<QB", len(self.index), self.id_bytes) + self.pack.compress(columns)
        body += struct.pack("<I", xxhash.xxh64_intdigest(body) & 0xFFFFFFFF)
        self.sink.write(struct.pack("<II", INDEX_MAGIC, len(body)) + body)
        table = b"".join(struct.pack("<III", *f) for f in self.frames)
        table += struct.pack("<IBI", len(self.frames), CHECKSUM_FLAG, SEEKABLE_MAGIC)
        self.sink.write(struct.pack("<II", SEEK_TABLE_MAGIC, len(table)) + table)
        return sum(f[1] for f in self.frames) // self.id_bytes


class Reader:
    """Reads documents from a seekable binary source."""

    def __init__(self, source) -> None:
        self.source = source
        end = source.seek(0, 2)
        if end < 17:
            raise CorruptFile("no seek table")
        count, flags, magic = struct.unpack("<IBI", self._at(end - 9, 9))
        if magic != SEEKABLE_MAGIC or flags != CHECKSUM_FLAG:
            raise CorruptFile("no seek table")
        head = end - 9 - 12 * count - 8
        if head < 0 or struct.unpack("<II", self._at(head, 8)) != (SEEK_TABLE_MAGIC, 12 * count + 9):
            raise CorruptFile("seek table and footer disagree")
        self.frames = np.frombuffer(self._at(head + 8, 12 * count), "<u4").reshape(-1, 3).astype(np.int64)
        self.starts = np.r_[0, np.cumsum(self.frames[:, 0])]
        at = int(self.starts[-1])
        magic, size = struct.unpack("<II", self._at(at, 8))
        body = self._at(at + 8, size)
        if magic != INDEX_MAGIC or struct.unpack("<I", body[-4:])[0] != xxhash.xxh64_intdigest(body[:-4]) & 0xFFFFFFFF:
            raise CorruptFile("document index")
        n, self.id_bytes = struct.unpack("<QB", body[:9])
        plain = zstandard.ZstdDecompressor().decompress(body[9:-4], max_output_size=40 * n) if n else b""
        self.index = np.frombuffer(plain, "<i8").reshape(5, n)
        self.unpack = zstandard.ZstdDecompressor()

    def _at(self, offset: int, size: int) -> bytes:
        self.source.seek(offset)
        data = self.source.read(size)
        if len(data) != size:
            raise CorruptFile("file too short")
        return data

    def frame(self, k: int) -> np.ndarray:
        """The ids of frame ``k``, checked."""
        packed, plain_size, checksum = (int(x) for x in self.frames[k])
        try:
            plain = self.unpack.decompress(self._at(int(self.starts[k]), packed), max_output_size=plain_size)
        except zstandard.ZstdError as error:
            raise CorruptFile(f"frame {k}: {error}") from error
        if len(plain) != plain_size or xxhash.xxh64_intdigest(plain) & 0xFFFFFFFF != checksum:
            raise CorruptFile(f"frame {k}: checksum")
        return np.frombuffer(plain, f"<u{self.id_bytes}")

    def documents(self, rows: Iterable[int] | None = None) -> Iterator[tuple[int | None, np.ndarray]]:
        """``(doc_id, ids)`` of all documents, or of some index rows, in
        index order; only their frames are decompressed, one at a time."""
        doc_ids, nulls, frames, firsts, counts = self.index
        held, ids = -1, None
        for r in range(len(doc_ids)) if rows is None else sorted(rows):
            if frames[r] != held:
                held, ids = int(frames[r]), self.frame(int(frames[r]))
            yield None if nulls[r] else int(doc_ids[r]), ids[firsts[r] : firsts[r] + counts[r]]

    def lookup(self, doc_id: int) -> list[np.ndarray]:
        """The ids of every document with this id."""
        rows = np.flatnonzero((self.index[0] == doc_id) & (self.index[1] == 0))
        return [ids for _, ids in self.documents(rows.tolist())]
