"""Token-id files: length-delimited binary records and an offset index.

A file is a row of frames.  A frame is: payload size (unsigned 64 bit),
masked crc32 of that size, payload, masked crc32 of the payload, one line
feed.  A payload is: doc_id (signed 64 bit), flags (bit 0: the id is null),
bytes per token id (2 or 4), number of ids (unsigned 64 bit), the ids.  All
numbers are little-endian.  Spark's file writer commits the files, so a lost
task leaves none behind and any file system that Spark writes to will do.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlens.llm.bpe import Vocabulary, encode_text
from marketlens.llm.common import map_batches

#: Fixed value: what is added to a rotated checksum, so that checksums of data that hold checksums stay apart.
MASK = 0xA282EAD8
HEAD, BODY = "<QI", "<qBBQ"
HEAD_SIZE, BODY_SIZE = struct.calcsize(HEAD), struct.calcsize(BODY)
INDEX = "file string, record long, doc_id long, offset long, size long, n_tokens long, before long, ids_crc32 long"


def masked(crc: int) -> int:
    return (((crc >> 15) | (crc << 17)) + MASK) & 0xFFFFFFFF


def frame(doc_id: int | None, ids: np.ndarray, wide: bool) -> bytes:
    """One record, without the line feed that Spark's writer puts behind it."""
    payload = struct.pack(BODY, doc_id or 0, doc_id is None, 4 if wide else 2, len(ids)) + ids.astype("<u4" if wide else "<u2").tobytes()
    size = struct.pack("<Q", len(payload))
    return size + struct.pack("<I", masked(zlib.crc32(size))) + payload + struct.pack("<I", masked(zlib.crc32(payload)))


def parse(data: bytes, at: int) -> tuple[int | None, np.ndarray, int]:
    """The record at an offset: id, token ids, offset of the next record.  Raises on a wrong checksum."""
    size, crc = struct.unpack_from(HEAD, data, at)
    if masked(zlib.crc32(data[at:at + 8])) != crc:
        raise ValueError(f"wrong checksum of the size at byte {at}")
    body = memoryview(data)[at + HEAD_SIZE:at + HEAD_SIZE + size]
    end = at + HEAD_SIZE + size
    if masked(zlib.crc32(body)) != struct.unpack_from("<I", data, end)[0]:
        raise ValueError(f"wrong checksum of the record at byte {at}")
    doc_id, flags, width, n = struct.unpack_from(BODY, body)
    ids = np.frombuffer(body, "<u4" if width == 4 else "<u2", n, BODY_SIZE).astype("<u4")
    return (None if flags & 1 else doc_id), ids, end + 5


def write_records(docs: DataFrame, vocabulary: Vocabulary, path: str, end_id: int | None = None, records_per_file: int = 10_000) -> None:
    """Encode every whole text and write the records under ``path``/data in ascending order of doc_id.

    Columns besides doc_id and text are ignored.  A null text counts as
    empty; ``end_id`` is appended to each document; null ids come first and
    equal ids are ordered by a hash of their texts, so one id on many rows is
    spread over tasks too; an empty table gives no records.
    """
    wide = max([end_id or 0, *vocabulary.pieces]) > 0xFFFF

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary.coder()
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                out = []
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids = encode_text(coder, text or "")
                    out.append(frame(doc_id, np.append(ids, np.uint32(end_id)) if end_id is not None else ids, wide))
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["record"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))
    tie = F.xxhash64("text")
    ordered = rows.repartitionByRange("doc_id", tie).sortWithinPartitions("doc_id", tie)
    (map_batches(ordered, run, "record binary").select(F.col("record").cast("string").alias("value"))
     .write.option("maxRecordsPerFile", records_per_file).option("lineSep", "\n").text(f"{path}/data"))


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{path}/data")


def write_index(spark: SparkSession, path: str) -> DataFrame:
    """Read every file once, check it, and write the offset index under ``path``/index; returns the index.

    A row per record: file, record in it, doc_id, byte offset and size of the
    frame, n_tokens, ``start`` (ids in all records before it, over all files
    in order) and a crc32 of the ids as unsigned 32-bit numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(b.num_rows):
                name, data = b.column(0)[k].as_py(), b.column(1)[k].as_py()
                at, before, rows = 0, 0, []
                while at < len(data):
                    doc_id, ids, after = parse(data, at)
                    rows.append((name, len(rows), doc_id, at, after - at, len(ids), before, zlib.crc32(ids.tobytes())))
                    before += len(ids)
                    at = after
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows))], names=[x.split()[0] for x in INDEX.split(", ")])

    spark_files = files(spark, path).select(F.substring_index("path", "/", -1).alias("file"), "content")
    map_batches(spark_files, run, INDEX).write.parquet(f"{path}/offsets")
    offsets = spark.read.parquet(f"{path}/offsets")
    # Files in the order of their task and of their number within the task.
    place = F.struct(F.regexp_extract("file", r"part-(\d+)", 1).cast("long"), F.regexp_extract("file", r"-c(\d+)", 1).cast("long"))
    totals = offsets.groupBy("file").agg(F.sum("n_tokens").alias("total")).withColumn("place", place)
    earlier = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)   # a row per file
    base = totals.select("file", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    offsets.join(base, "file").select("file", "record", "doc_id", "offset", "size", "n_tokens", (F.col("base") + F.col("before")).alias("start"), "ids_crc32").write.parquet(f"{path}/index")
    return spark.read.parquet(f"{path}/index")


def read_records(spark: SparkSession, path: str, wanted: DataFrame | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` of the records that ``wanted`` (rows of the index) names, by offset; default all."""
    index = spark.read.parquet(f"{path}/index") if wanted is None else wanted

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for data, offsets in zip(b.column(0), b.column(1).to_pylist()):
                found = [parse(data.as_py(), at)[:2] for at in offsets]
                yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in found], pa.int64()), pa.array([x[1].astype(np.int32) for x in found], pa.list_(pa.int32()))], names=["doc_id", "ids"])

    places = index.groupBy("file").agg(F.collect_list("offset").alias("offsets"))   # at most records_per_file of each
    return (map_batches(files(spark, path).select(F.substring_index("path", "/", -1).alias("file"), "content")
            .join(places, "file").select("content", "offsets"), run, "doc_id long, ids array<int>"))
