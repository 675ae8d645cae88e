"""BPE encoding and decoding through distinct-word tables.

Encoding: every block of documents sends its distinct words; equal words of
all blocks meet in one task, where each is encoded once; the ids are joined
back to the block and put in place by word number.  Decoding: ids are joined
to the id-to-piece table, whose size the vocabulary bounds.
"""

from __future__ import annotations

import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.llm import blocks as B
from marketlens.llm.blocks import cells
from marketlens.llm.common import map_batches

#: Unicode white space, which ends a word.
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: A cut here is always a cut of the byte-level pattern: it never joins a sign to white space
#: behind it, nor more than one space to a sign behind that.
CUT = re.compile(f" ?[^{WHITE}]+|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+")
#: Texts with none of these are cut by plain replacement.
ODD = re.compile("[\t\x0b-\r\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\x01]|[ \n][ \n]")
PLAIN = "\x01"   # begins the key of a word that has no space before it; other keys stand for a space and themselves


def cut(text: str) -> list[str]:
    """Keys of the words of a text without special strings."""
    if not text:
        return []
    if ODD.search(text) is None and text[0] not in " \n" and text[-1] not in " \n":
        return (PLAIN + text.replace("\n", " \n " + PLAIN)).split(" ")
    return [w[1:] if w[0] == " " and len(w) > 1 and w[1] not in "\n" + PLAIN and not w[1].isspace() else w if w == "\n" else PLAIN + w for w in CUT.findall(text)]


def word_of(key: str) -> str:
    return key[1:] if key[0] == PLAIN else key if key == "\n" else " " + key


class Vocabulary:
    """A byte-level BPE file of the tokenizers library, read on the driver; its size bounds what is sent."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            self.json = f.read()
        spec = json.loads(self.json)
        if spec["model"]["type"] != "BPE" or spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"].get("add_prefix_space"):
            raise ValueError("distinct-word encoding needs a byte-level BPE file without a normalizer or a prefix space")
        model = spec["model"]
        if any(model.get(k) for k in ("dropout", "ignore_merges", "byte_fallback", "continuing_subword_prefix", "end_of_word_suffix")):
            raise ValueError("distinct-word encoding needs a plain BPE model")
        merged = [model["vocab"].get("".join(m.split(" ") if isinstance(m, str) else m)) for m in model["merges"]]
        if None in merged or any(a >= b for a, b in zip(merged, merged[1:])):
            raise ValueError("distinct-word encoding needs ids in the order of the merges")
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        to_byte = byte_of_sign()
        self.pieces = {i: bytes(to_byte[c] for c in piece) for piece, i in spec["model"]["vocab"].items()}
        self.pieces |= {i: s.encode() for s, i in self.special.items()}

    def cutter(self) -> Callable[[bytes], list[str]]:
        """A function from a text to keys of words, which join to the text and encode independently."""
        special = sorted(self.special, key=len, reverse=True)
        if not special:
            return lambda text: cut(text.decode("utf-8", "replace"))
        marks = [s.encode() for s in special]
        split = re.compile("(" + "|".join(map(re.escape, special)) + ")").split

        def keys(text: bytes) -> list[str]:
            s = text.decode("utf-8", "replace")
            if not any(m in text for m in marks):
                return cut(s)
            return [w for k, part in enumerate(split(s)) for w in ([PLAIN + part] if k % 2 else cut(part))]

        return keys

    def coder(self):
        """The same vocabulary and merge order in tiktoken, which encodes single words faster."""
        import tiktoken

        ranks = {piece: i for i, piece in self.pieces.items() if i not in self.special.values()}
        return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=self.special)


#: Longer runs of white space are encoded as the one piece that they are: the pattern's look-ahead fails on very long ones.
LONG_WHITE = re.compile(f"[{WHITE}]{{10000,}}")


def encode_text(coder, text: str) -> np.ndarray:
    """Ids of a text, special strings included, with white space runs of any length."""
    if len(text) < 10_000 or LONG_WHITE.search(text) is None:
        return coder.encode_to_numpy(text, allowed_special="all")
    parts, at = [], 0
    for run in LONG_WHITE.finditer(text):
        end = run.end()
        # The last sign of a run goes with what follows it, but not with a special string.
        if end < len(text) and not text.startswith(tuple(coder.special_tokens_set), end):
            end -= 1
        parts += [coder.encode_to_numpy(text[at:run.start()], allowed_special="all"), np.array(coder._encode_single_piece(text[run.start():end]), np.uint32)]
        at = end
    return np.concatenate([*parts, coder.encode_to_numpy(text[at:], allowed_special="all")])


#: Fixed value: the pattern by which byte-level files of the tokenizers library cut words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_of_sign() -> dict[str, int]:
    """The printable sign that stands for each byte in byte-level vocabularies, turned round."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + k): b for k, b in enumerate(rest)}


ROW = "block long, kind int, data binary"
BLOCK_BYTES = 16 << 20   # text of a block
REMEMBERED = 300_000   # words whose ids a task remembers at a time


def encode(docs: DataFrame, vocabulary: Vocabulary, block_bytes: int = BLOCK_BYTES, buckets: int | None = None) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every whole text, special strings in texts included.

    ``docs`` must be a stored table (see :mod:`blocks`); columns besides
    doc_id and text are ignored.  A null text counts as empty and gives an
    empty array; null and repeated ids are carried row by row; equal texts
    are encoded through the same words; an empty table gives an empty
    result.  Words meet in ``buckets`` of their hash, by default two for each
    shuffle partition; a task holds one block's distinct words with their ids,
    or a bounded number of words of a bucket.
    """
    keys = vocabulary.cutter()
    rows = B.rows_of(docs)
    buckets = buckets or 2 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in B.blocks(batches, keys, block_bytes):
            found = [w.encode("utf-8", "replace") for w in block.words]
            bucket = np.fromiter(map(zlib.crc32, found), np.uint32, len(found)) % buckets
            order = np.argsort(bucket, kind="stable")
            names, starts = np.unique(bucket[order], return_index=True)
            for name, mine in zip(names.tolist(), np.split(order, starts[1:])):
                part = [found[i] for i in mine.tolist()]
                data = B.pack(np.diff(mine, prepend=0).astype(np.uint32), np.array([len(w) for w in part], np.uint32), np.frombuffer(b"".join(part), np.uint8))
                yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([block.key], pa.int64()), pa.array([data], pa.binary())], names=["bucket", "block", "data"])

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in B.blocks(batches, keys, block_bytes):
            for data in B.chunks(block):
                yield pa.RecordBatch.from_arrays([pa.array([block.key], pa.int64()), pa.array([1], pa.int32()), pa.array([data], pa.binary())], names=["block", "kind", "data"])

    def ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = vocabulary.coder()
        known: dict[bytes, np.ndarray] = {}
        for b in batches:
            for _, block, data in cells(b):
                number, size, text = B.unpack(data)
                if len(known) > REMEMBERED:
                    known.clear()
                text, codes, at = text.tobytes(), [], 0
                for n in size.tolist():
                    w = text[at:at + n]
                    at += n
                    code = known.get(w)
                    if code is None:
                        code = known[w] = encode_text(coder, word_of(w.decode()))
                    codes.append(code)
                packed = B.pack(np.cumsum(number, dtype=np.int64).astype(np.uint32), np.fromiter(map(len, codes), np.uint32, len(codes)), np.concatenate(codes))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([0], pa.int32()), pa.array([packed], pa.binary())], names=["block", "kind", "data"])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, parts, lookup = None, [], None
        for b in batches:
            for block, kind, data in cells(b):
                if block != key:
                    key, parts, lookup = block, [], None
                if kind == 0:
                    parts.append(B.unpack(data))
                    continue
                if lookup is None:
                    lookup, parts = by_number(parts), []
                first, size, flat = lookup
                ids, values, offsets = [], [], [0]
                for doc_id, number in B.unchunk(data):
                    if len(number) and int(number.max()) >= len(first):
                        raise RuntimeError("the documents were split differently in the second pass; store them first")
                    n = size[number]
                    end = np.cumsum(n)
                    total = int(end[-1]) if len(end) else 0
                    values.append(flat[np.repeat(first[number] - (end - n), n) + np.arange(total)])
                    ids.append(doc_id)
                    offsets.append(offsets[-1] + total)
                array = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.concatenate(values).astype(np.int32)))
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), array], names=["doc_id", "ids"])

    coded = map_batches(map_batches(rows, words, "bucket long, block long, data binary").repartition("bucket"), ids, ROW)
    return (map_batches(coded.union(map_batches(rows, documents, ROW))
            .repartition("block").sortWithinPartitions("block", "kind"), place, "doc_id long, ids array<int>"))


def by_number(parts: list[list[np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First position, number and flat array of ids, by word number."""
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint32)
    number = np.concatenate([p[0] for p in parts])
    count = np.concatenate([p[1] for p in parts]).astype(np.int64)
    flat = np.concatenate([p[2] for p in parts])
    size, first = np.zeros(len(number), np.int64), np.zeros(len(number), np.int64)
    size[number], first[number] = count, np.cumsum(count) - count
    return first, size, flat


def decode(encoded: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``doc_id``, ``ids`` and ``text``: ids joined to their pieces, special tokens kept.

    The id-to-piece table is sent to every task (its bound is the size of the
    vocabulary).  Ids outside it add nothing; bytes that are no UTF-8 become
    replacement signs; a null or empty array gives an empty text.
    """
    table = encoded.sparkSession.sparkContext.broadcast(vocabulary.pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = table.value
        lookup = [pieces.get(i, b"") for i in range(max(pieces, default=-1) + 1)] + [b""]
        for whole in batches:
            for at in range(0, whole.num_rows, 1000):
                b = whole.slice(at, 1000)
                lists = b.column(1)
                flat = lists.flatten().fill_null(-1).to_numpy(zero_copy_only=False)
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                ends = np.cumsum(sizes)
                flat = np.where((flat >= 0) & (flat < len(lookup) - 1), flat, len(lookup) - 1).tolist()
                texts = [b"".join(map(lookup.__getitem__, flat[end - n:end])).decode("utf-8", "replace") for n, end in zip(sizes.tolist(), ends.tolist())]
                yield pa.RecordBatch.from_arrays([b.column(0), lists, pa.array(texts, pa.string())], names=["doc_id", "ids", "text"])

    return map_batches(encoded.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")), run, "doc_id long, ids array<int>, text string")


def default_vocabulary(spark: SparkSession) -> Vocabulary:  # noqa: ARG001
    import public_tokenizers

    return Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
