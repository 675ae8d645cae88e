"""Blocks of documents whose distinct words are looked up together.

Corpus-wide word tables (token ids, counts) are joined to texts by position
without shuffling a row per word: a task cuts its documents into blocks of
bounded size, sends each distinct word of a block once, and the answers come
back to the block as an array over its words.  Documents travel as arrays of
word numbers, compressed.

Blocks are numbered by task and place in it, so the two passes over the
documents (words, word numbers) must see the same splits: the input must be
a stored table.  Each block's name ends in a checksum of its texts, so if a
recomputed split ever differs, the lookup fails instead of mixing answers.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_BYTES = 16 << 20   # text of a block; one longer text is a block of its own
CHUNK_WORDS = 200_000    # word numbers that travel in one row


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays with their types and sizes, compressed; multi-byte numbers go as byte planes."""
    out = []
    for a in arrays:
        a = np.ascontiguousarray(a)
        raw = a.view(np.uint8).reshape(-1, a.itemsize).T.tobytes() if a.itemsize > 1 else a.tobytes()
        kind = a.dtype.str.encode()
        out.append(struct.pack("<BQ", len(kind), len(a)) + kind + raw)
    return zstandard.ZstdCompressor(level=1).compress(b"".join(out))


def unpack(data: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(data)
    out, at = [], 0
    while at < len(raw):
        k, n = struct.unpack_from("<BQ", raw, at)
        dtype = np.dtype(raw[at + 9:at + 9 + k].decode())
        at += 9 + k
        size = n * dtype.itemsize
        planes = np.frombuffer(raw, np.uint8, size, at)
        a = planes.reshape(dtype.itemsize, n).T.copy().view(dtype).reshape(n) if dtype.itemsize > 1 else planes.view(dtype)
        out.append(a)
        at += size
    return out


def cells(batch: pa.RecordBatch) -> Iterator[tuple]:
    """The rows of a batch one after another: cells are large, so they aren't all turned into Python objects at once."""
    for k in range(batch.num_rows):
        yield tuple(c[k].as_py() for c in batch.columns)


class Block:
    """Documents of one block as numbers of its distinct words."""

    def __init__(self, task: int, place: int):
        self.name = (task << 20 | place) << 20
        self.crc = self.size = 0
        self.ids: list[int | None] = []
        self.words: dict = {}
        self.docs: list[np.ndarray] = []

    def add(self, doc_id: int | None, words: list, size: int, crc: int) -> None:
        number = self.words
        self.docs.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
        self.ids.append(doc_id)
        self.size += size + 64
        self.crc = zlib.crc32(crc.to_bytes(4, "little"), self.crc)

    @property
    def key(self) -> int:
        return self.name | (self.crc & 0xFFFFF)


def blocks(batches: Iterator[pa.RecordBatch], cut: Callable[[bytes], list], limit: int = BLOCK_BYTES) -> Iterator[Block]:
    """Blocks of one split's rows, as :func:`rows_of` makes them; a null text counts as empty."""
    place, block = 0, None
    for b in batches:
        if not b.num_rows:
            continue
        if block is None:
            task = b.column(2)[0].as_py()
            block = Block(task, place)
        for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
            text = text or b""
            if block.ids and block.size + len(text) > limit:
                yield block
                place += 1
                block = Block(task, place)
            block.add(doc_id, cut(text), len(text), zlib.crc32(text))
    if block is not None:
        yield block


def rows_of(docs: DataFrame) -> DataFrame:
    """doc_id, text and the number of the split that a row is read in."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), F.spark_partition_id().alias("split"))


def chunks(block: Block) -> Iterator[bytes]:
    """The documents of a block, some to a row: ids, whether they are null, word numbers."""
    at, n = 0, 0
    for i, d in enumerate(block.docs):
        n += len(d)
        if n >= CHUNK_WORDS or i == len(block.docs) - 1:
            part = block.docs[at:i + 1]
            ids = block.ids[at:i + 1]
            yield pack(np.array([x or 0 for x in ids], np.int64), np.array([x is None for x in ids], np.uint8),
                       np.array([len(x) for x in part], np.int32), np.concatenate(part))
            at, n = i + 1, 0


def unchunk(data: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    ids, null, sizes, words = unpack(data)
    ends = np.cumsum(sizes)
    for i, none, size, end in zip(ids.tolist(), null.tolist(), sizes.tolist(), ends.tolist()):
        yield (None if none else i), words[end - size:end]
