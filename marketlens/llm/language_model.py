"""Language-model scores from a sharded Elias-Fano bigram trie.

1. Documents become blocks of word numbers, written once.
2. Words of all blocks meet in buckets of their hash: each gets its count in
   the training tokens, sent back to its blocks by number.
3. Bigrams of all blocks meet in shards of their context; contexts that
   exceed a shard's share are spread over several by their second word.  A
   shard sums the training counts, builds its trie, maps its levels into
   memory, and answers every bigram of every block with a probability code.
4. A block with its counts and codes scores its documents.

The probability of a word behind a context is its discounted share,
c(context, word) / (c(context) + prior), plus prior / (c(context) + prior)
times the word's own smoothed share (a Dirichlet prior).
"""

from __future__ import annotations

import math
import os
import tempfile
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlens.llm import blocks as B
from marketlens.llm.blocks import cells
from marketlens.llm.common import LOWER, map_batches, stored
from marketlens.llm.ef_trie import Trie, probabilities

WORD_BITS = 40   # successors are kept as 40-bit hashes within their context


@dataclass(frozen=True)
class Model:
    prior: float = 100.0
    unseen: float = 0.1                 # added to every word's count
    block_bytes: int = 10 << 20
    shard_bytes: int = 12 << 20         # of text, whose bigrams a task holds

    @property
    def hot(self) -> int:
        """A context with so many training tokens is spread over shards: an eighth of a shard's share."""
        return max(1, self.shard_bytes // 64)


BLOCKS = "block long, bytes long, words binary, hashes binary, docs binary"
ROW = "block long, kind int, data binary"
RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def block_table(docs: DataFrame, held_out: Column, model: Model) -> DataFrame:
    """One row per block: its distinct words with their training counts and hashes, and its documents as word numbers.

    The empty word stands for the end of a text and for what precedes its first word.
    """
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"),
                       F.coalesce(held_out, F.lit(False)).alias("held_out"), F.spark_partition_id().alias("split"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        def out() -> pa.RecordBatch:
            sizes = np.array([len(x) for x in texts], np.int64)
            flat = np.concatenate(texts)
            train = np.repeat(~np.array(held), sizes)
            found = list(number)
            counts = np.bincount(flat[train], minlength=len(found))
            counts[0] = (~np.array(held)).sum()
            hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
            words = B.pack(np.array([len(w) for w in found], np.int32), np.frombuffer(b"".join(found), np.uint8), counts.astype(np.int64))
            null = np.array([x is None for x in ids], np.uint8)
            body = B.pack(np.array([len(found)], np.int64), np.array([x or 0 for x in ids], np.int64), null, np.array(held, np.uint8), sizes, flat.astype(np.int32))
            binary = [pa.array([x], pa.binary()) for x in (words, B.pack(hashes), body)]
            return pa.RecordBatch.from_arrays([pa.array([split << 24 | place], pa.int64()), pa.array([size], pa.int64()), *binary], names=["block", "bytes", "words", "hashes", "docs"])

        ids, held, texts, number, size, place, split = [], [], [], {b"": 0}, 0, 0, 0
        for b in batches:
            for doc_id, text, out_of, at in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                text, split = text or b"", at
                if ids and size + len(text) > model.block_bytes:
                    yield out()
                    ids, held, texts, number, size, place = [], [], [], {b"": 0}, 0, place + 1
                words = text.translate(LOWER).split()
                texts.append(np.fromiter((number.setdefault(w, len(number)) for w in words), np.int32, len(words)))
                ids.append(doc_id)
                held.append(out_of)
                size += len(text) + 64
        if ids:
            yield out()

    return map_batches(rows, run, BLOCKS)


def bigrams(docs: bytes) -> tuple:
    """The arrays of a block's documents, its distinct bigrams (first and second word number, training count) and where they stand."""
    n, ids, null, held, sizes, flat = B.unpack(docs)
    n = int(n[0])
    ends = np.cumsum(sizes + 1)                                # each text is closed by the empty word
    second = np.zeros(int(ends[-1]), np.int64)
    inside = np.ones(len(second), bool)
    inside[ends - 1] = False
    second[inside] = flat
    first = np.r_[0, second[:-1]]
    pairs, where = np.unique(first * n + second, return_inverse=True)
    counts = np.bincount(where[np.repeat(held == 0, sizes + 1)], minlength=len(pairs))
    return (ids, null, held, sizes, ends, n), (pairs // n, pairs % n, counts), where, second


def word_counts(table: DataFrame, buckets: int, model: Model) -> DataFrame:
    """For each block the training counts of its words (kind 0); in block -1 totals (kind 8) and hot contexts (kind 9).

    Words of all blocks meet in ``buckets`` of their hash; a task holds one
    bucket's distinct words.
    """

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, data in cells(b):
                sizes, text, counts = B.unpack(data)
                ends, text = np.cumsum(sizes, dtype=np.int64), text.tobytes()
                words = [text[e - n:e] for e, n in zip(ends.tolist(), sizes.tolist())]
                bucket = np.fromiter(map(zlib.crc32, words), np.uint32, len(words)) % buckets
                order = np.argsort(bucket, kind="stable")
                names, starts = np.unique(bucket[order], return_index=True)
                for name, mine in zip(names.tolist(), np.split(order, starts[1:])):
                    c = counts[mine]
                    part = B.pack(np.diff(mine, prepend=0).astype(np.uint32), sizes[mine], c.astype(np.int64 if c.max(initial=0) > 255 else np.uint8),
                                  np.frombuffer(b"".join([words[i] for i in mine.tolist()]), np.uint8))
                    yield pa.RecordBatch.from_arrays([pa.array([name], pa.int64()), pa.array([block], pa.int64()), pa.array([part], pa.binary())], names=["bucket", "block", "data"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        tokens = distinct = 0
        hot_h, hot_c = [], []

        def answers(known: dict[bytes, int], parts: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal tokens, distinct
            sums = np.zeros(len(known), np.int64)
            for _, _, which, c in parts:
                sums += np.bincount(which, c, minlength=len(known)).astype(np.int64)
            tokens += int(sums.sum())
            distinct += int((sums > 0).sum())
            names = list(known)
            for i in np.flatnonzero(sums >= model.hot).tolist():
                hot_h.append(xxhash.xxh3_64_intdigest(names[i]))
                hot_c.append(int(sums[i]))
            for block, number, which, _ in parts:
                data = B.pack(number, sums[which].astype(np.int64))
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([0], pa.int32()), pa.array([data], pa.binary())], names=["block", "kind", "data"])

        bucket, known, parts = None, {}, []
        for b in batches:
            for name, block, data in cells(b):
                if name != bucket:
                    yield from answers(known, parts)
                    bucket, known, parts = name, {}, []
                number, sizes, counts, text = B.unpack(data)
                ends, text = np.cumsum(sizes, dtype=np.int64), text.tobytes()
                which = np.fromiter((known.setdefault(text[e - n:e], len(known)) for e, n in zip(ends.tolist(), sizes.tolist())), np.int32, len(sizes))
                parts.append((block, np.cumsum(number, dtype=np.int64).astype(np.int32), which, counts))
        yield from answers(known, parts)
        rows = [B.pack(np.array([tokens, distinct], np.int64)), B.pack(np.array(hot_h, np.uint64), np.array(hot_c, np.int64))]
        yield pa.RecordBatch.from_arrays([pa.array([-1, -1], pa.int64()), pa.array([8, 9], pa.int32()), pa.array(rows, pa.binary())], names=["block", "kind", "data"])

    return (map_batches(map_batches(table.select("block", "words"), send, "bucket long, block long, data binary")
            .repartition("bucket").sortWithinPartitions("bucket"), total, ROW))


def bigram_codes(table: DataFrame, shards: int, hot: tuple[np.ndarray, np.ndarray], model: Model) -> DataFrame:
    """For each block the codes of its distinct bigrams, in their order there (kind 1), from the tries of all shards."""
    order = np.argsort(hot[0])
    hot_words, hot_counts = hot[0][order], hot[1][order]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for block, packed, docs in cells(b):
                hashes = B.unpack(packed)[0]
                _, (first, second, counts), _, _ = bigrams(docs)
                spread = np.zeros(len(hashes), np.uint64)          # over how many shards a context goes, if hot
                if len(hot_words):
                    at = np.minimum(np.searchsorted(hot_words, hashes), len(hot_words) - 1)
                    spread = np.where(hot_words[at] == hashes, hot_counts[at] // model.hot + 1, 0).astype(np.uint64)
                turned = hashes * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)
                home = turned[first] + np.where(spread[first] > 0, (turned[second] >> np.uint64(7)) % np.maximum(spread[first], np.uint64(1)), np.uint64(0))
                shard = (home % np.uint64(shards)).astype(np.int64)
                by = np.argsort(shard, kind="stable")
                keys, starts = np.unique(shard[by], return_index=True)
                for key, mine in zip(keys.tolist(), np.split(by, starts[1:])):
                    new = np.r_[True, first[mine][1:] != first[mine][:-1]]
                    fan = np.diff(np.r_[np.flatnonzero(new), len(mine)])
                    word = hashes[second[mine]] >> np.uint64(64 - WORD_BITS)
                    c = counts[mine]
                    data = B.pack(np.diff(mine, prepend=0).astype(np.uint32), hashes[first[mine][new]], fan.astype(np.uint32),
                                  (word >> np.uint64(32)).astype(np.uint8), word.astype(np.uint32), c.astype(np.uint32 if c.max(initial=0) > 255 else np.uint8))
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([block], pa.int64()), pa.array([data], pa.binary())], names=["shard", "block", "data"])

    def answer(parts: list[tuple[int, bytes]]) -> Iterator[tuple[int, bytes]]:
        def read(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
            at, context, fan, high, low, counts = B.unpack(data)
            return np.cumsum(at, dtype=np.int64).astype(np.uint32), np.repeat(context, fan), high.astype(np.uint64) << np.uint64(32) | low, counts

        learnt = []
        for _, data in parts:
            _, context, word, counts = read(data)
            seen = counts > 0
            learnt.append((context[seen], word[seen], counts[seen].astype(np.int64)))
        context, word, counts = (np.concatenate([x[k] for x in learnt]) for k in range(3))
        names, number = np.unique(context, return_inverse=True)
        key = number.astype(np.uint64) << np.uint64(WORD_BITS) | word
        key, where = np.unique(key, return_inverse=True)
        sums = np.bincount(where, counts, minlength=len(key))
        number, word = (key >> np.uint64(WORD_BITS)).astype(np.int64), key & np.uint64((1 << WORD_BITS) - 1)
        total = np.bincount(number, sums, minlength=len(names))
        if len(hot_words):                                         # a hot context's count comes from all its shards
            at = np.minimum(np.searchsorted(hot_words, names), len(hot_words) - 1)
            total = np.where(hot_words[at] == names, hot_counts[at], total)
        built = Trie.build(names[number] if len(names) else context, word, sums / (total[number] + model.prior))
        del learnt, context, counts, where, key
        handle, path = tempfile.mkstemp(prefix="trie-")
        try:
            with os.fdopen(handle, "wb") as f:
                f.write(built)
            del built
            trie = Trie(np.memmap(path, np.uint8, "r"))
            for block, data in parts:
                at, context, word, _ = read(data)
                yield block, B.pack(np.diff(at, prepend=np.uint32(0)), trie.find(context, word))
        finally:
            os.unlink(path)

    def serve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[pa.RecordBatch]:
            for block, data in answer(parts):
                yield pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([1], pa.int32()), pa.array([data], pa.binary())], names=["block", "kind", "data"])

        shard, parts = None, []
        for b in batches:
            for key, block, data in cells(b):
                if key != shard and parts:
                    yield from rows()
                    parts = []
                shard = key
                parts.append((block, data))
        if parts:
            yield from rows()

    return (map_batches(map_batches(table.select("block", "hashes", "docs"), send, "shard long, block long, data binary")
            .repartition("shard").sortWithinPartitions("shard"), serve, ROW))


def score(docs: DataFrame, held_out: Column, model: Model = Model(), name: str = "lm") -> DataFrame:
    """Scores of every whole text by a model of those that are not held out, one row per input row.

    Returns ``doc_id, held_out, n_tokens, n_known, base_score, score,
    train_tokens``.  Tokens are the words (A-Z lowered) and one end.  A null
    text counts as empty: its only token is the end; null and repeated ids are
    carried row by row; a null ``held_out`` counts as false; other columns
    are ignored; without training texts every word is unseen; an empty table
    gives an empty result.  Words are counted as they are written; behind a
    context they are told apart by 40-bit hashes.
    """
    table = stored(block_table(docs, held_out, model), f"{name}-blocks")
    size = table.agg(F.sum("bytes")).first()[0] or 0
    counted = stored(word_counts(table, max(1, math.ceil(size / model.shard_bytes)), model), f"{name}-counts")
    tokens = distinct = 0
    hot_h, hot_c = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for r in counted.where("block = -1").toLocalIterator():        # totals, and contexts above an eighth of a shard's share
        data = B.unpack(bytes(r["data"]))
        if r["kind"] == 8:
            tokens, distinct = tokens + int(data[0][0]), distinct + int(data[0][1])
        else:
            hot_h.append(data[0])
            hot_c.append(data[1])
    codes = bigram_codes(table, max(1, math.ceil(size / model.shard_bytes)), (np.concatenate(hot_h), np.concatenate(hot_c)), model)
    floor = tokens + model.unseen * (distinct + 1)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows(block: int, docs: bytes) -> pa.RecordBatch:
            (ids, null, held, sizes, ends, n), (first, second, _), where, token = bigrams(docs)
            count = np.full(n, -1.0)
            for number, c in known:
                count[number] = c
            if (count < 0).any():
                raise RuntimeError(f"words of block {block} have no count")
            share = (count + model.unseen) / floor
            inside = np.zeros(len(first))
            for at, code in asked:
                inside[np.cumsum(at, dtype=np.int64)] = probabilities(code)
            step = np.log10(inside + model.prior / (count[first] + model.prior) * share[second])
            starts = ends - sizes - 1
            base, score = (np.add.reduceat(x, starts) for x in (np.log10(share)[token], step[where]))
            n_known = np.add.reduceat((count > 0)[token].astype(np.int64), starts)
            columns = (pa.array(ids, mask=null.astype(bool)), pa.array(held.astype(bool)), pa.array(sizes + 1), pa.array(n_known), pa.array(base), pa.array(score))
            return pa.RecordBatch.from_arrays(list(columns), names=[x.split()[0] for x in RESULT.split(", ")])

        key, known, asked = None, [], []
        for b in batches:
            for block, kind, data in cells(b):
                if block != key:
                    key, known, asked = block, [], []
                if kind == 2:
                    yield rows(block, data)
                else:
                    (known if kind == 0 else asked).append(B.unpack(data))

    own = table.select("block", F.lit(2).alias("kind"), F.col("docs").alias("data"))
    parts = counted.where("block >= 0").union(codes).union(own)
    return (map_batches(parts.repartition("block").sortWithinPartitions("block", "kind"), finish, RESULT)
            .withColumn("train_tokens", F.lit(tokens).cast("long")))
