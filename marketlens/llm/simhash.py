"""SimHash near-duplicates by anchor-point covering.

The 64 bits fall into three pieces; of two fingerprints that differ in up to
four bits, one piece differs in at most one.  The anchors of a piece are the
4,096 words of the perfect binary Golay code of length 23, whose covering
radius is 3: every piece is within 3 bits of one anchor.  A fingerprint goes
to every anchor within 3 + 1 bits (5.3 on average), so such a pair meets at
the anchor nearest to either.  The rest of the bits, which hold at most four
differences too, are cut into five parts, of which one is equal: anchor and
part value together are the place where fingerprints are compared.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import ROW, LOWER, map_batches, stored
from marketlens.llm.components import components

PIECES = ((0, 22), (22, 21), (43, 21))   # first bit and number of bits
GOLAY = 0b101011100011                   # generator polynomial of the binary Golay code (23, 12)
RADIUS = 3                               # covering radius of that code
SEED = 42


def fingerprint(text: bytes | None, size: int = 4) -> int:
    """The SimHash of lowered word shingles, repeats included; 0 without a word."""
    import xxhash

    words = (text or b"").translate(LOWER).split()
    if not words:
        return 0
    n = len(words) - size + 1
    digest = xxhash.xxh64_intdigest
    if n <= 1:
        return digest(b" ".join(words), SEED)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    stops = (ends[size - 1:] - 1).tolist()
    starts = [0, *ends[:n - 1].tolist()]
    h = np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, stops)), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        counts += np.unpackbits(h[at:at + (1 << 16)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, size: int = 4) -> DataFrame:
    """``doc_id, row, fp`` (number of the row, the 64 bits as a signed long) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, size) for t in b.column(1).cast(pa.binary()).to_pylist()), np.uint64, b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fp.view(np.int64))], names=["doc_id", "row", "fp"])

    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), (docs[ROW] if ROW in docs.columns else F.monotonically_increasing_id()).alias("row"))
    return map_batches(rows, run, "doc_id long, row long, fp long")


def remainder(x: int) -> int:
    """The syndrome of a 23-bit word: its remainder by the generator polynomial."""
    for k in range(22, 10, -1):
        if x >> k & 1:
            x ^= GOLAY << (k - 11)
    return x


def near_patterns(within: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All differences of up to ``within`` bits to an anchor, by syndrome: flat, first place, number."""
    unit = [remainder(1 << k) for k in range(23)]
    by: list[list[int]] = [[] for _ in range(2048)]
    for w in range(within + 1):
        for bits in combinations(range(23), w):
            s = p = 0
            for k in bits:
                s ^= unit[k]
                p |= 1 << k
            by[s].append(p)
    size = np.array([len(x) for x in by])
    return np.array([p for x in by for p in x], np.int64), np.cumsum(size) - size, size


def places(fp: np.ndarray, max_bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each piece and part: keys of the places where fingerprints meet, and the rows they are of."""
    slack = max_bits // len(PIECES)
    flat, first, size = near_patterns(RADIUS + slack)
    low = np.array([remainder(x) for x in range(1 << 12)])
    high = np.array([remainder(x << 12) for x in range(1 << 11)])
    rows = np.arange(len(fp))
    for k, (at, bits) in enumerate(PIECES):
        word = ((fp >> np.uint64(at)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        syndrome = low[word & 0xFFF] ^ high[word >> 12]
        n = size[syndrome]
        end = np.cumsum(n)
        row = np.repeat(rows, n)
        anchor = (word[row] ^ flat[np.repeat(first[syndrome] - (end - n), n) + np.arange(int(end[-1]) if len(end) else 0)]) >> 11   # the 12 data bits name it
        rest = (fp >> np.uint64(at + bits)) << np.uint64(at) if at + bits < 64 else np.zeros_like(fp)
        rest |= fp & np.uint64((1 << at) - 1)
        cuts = np.linspace(0, 64 - bits, max_bits + 2).astype(int)
        for j, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = ((rest >> np.uint64(a)) & np.uint64((1 << (b - a)) - 1)).astype(np.int64)
            yield ((((k * 8 + j) << 12) | anchor) << 24) | part[row], row


def links_of(keys: np.ndarray, fp: np.ndarray, max_bits: int, small: int = 8) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect what is within ``max_bits`` at equal keys (sorted): all in small groups, a forest in others."""
    a, b = [], []
    starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[starts, len(keys)])
    room = np.repeat(np.where(size <= small, starts + size, 0), size)      # end of the group, if small
    for k in range(1, small):
        i = np.flatnonzero(np.arange(len(keys)) + k < room)
        i = i[np.bitwise_count(fp[i] ^ fp[i + k]) <= max_bits]
        a.append(fp[i])
        b.append(fp[i + k])
    for s, n in zip(starts[size > small].tolist(), size[size > small].tolist()):
        left = fp[s:s + n]
        queue: list = []
        while len(left):                                                    # what is reached leaves the group
            if not queue:
                queue, left = [left[0]], left[1:]
            x = queue.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                a.append(np.full(len(found), x))
                b.append(found)
                queue.extend(found)
                left = left[~near]
    return np.concatenate(a), np.concatenate(b)


def links(distinct: DataFrame, max_bits: int = 4) -> DataFrame:
    """Links ``a, b`` that connect every pair of fingerprints (column fp, each once) within ``max_bits``."""
    if not 0 <= max_bits <= 5:
        raise ValueError("the pieces are laid out for up to five bits")

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy().view(np.uint64)
            for keys, row in places(fp, max_bits):
                for at in range(0, len(keys), 50_000):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[at:at + 50_000]), pa.array(fp[row[at:at + 50_000]].view(np.int64))], names=["place", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(keys: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
            a, b = links_of(keys, fp.view(np.uint64), max_bits)
            pairs = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

        held_k, held_f, n = [], [], 0
        for b in batches:
            keys, fp = b.column(0).to_numpy(), b.column(1).to_numpy()
            if not len(keys):
                continue
            held_k.append(keys)
            held_f.append(fp)
            n += len(keys)
            if n >= 200_000 and held_k[0][0] != keys[-1]:
                k, f = np.concatenate(held_k), np.concatenate(held_f)
                cut = int(np.searchsorted(k, k[-1]))                        # the last key may go on
                yield out(k[:cut], f[:cut])
                held_k, held_f, n = [k[cut:]], [f[cut:]], len(k) - cut
        if n:
            yield out(np.concatenate(held_k), np.concatenate(held_f))

    met = map_batches(distinct.select("fp"), spread, "place long, fp long")
    return map_batches(met.repartition("place").sortWithinPartitions("place"), compare, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, name: str = "simhash") -> DataFrame:
    """``doc_id, fingerprint, component_id, row, stays``, one row per input row.

    Words are runs of signs other than space and \\x09-\\x0D, A-Z lowered; a
    text with fewer words than a shingle is one shingle, one without words
    (null texts too) has fingerprint zero, which links like any other.
    ``component_id`` is the smallest doc_id reachable over links of up to
    ``max_bits`` differing bits; ``row`` is the row's number (``numbered``; else one of this pass only), and one
    row of each component ``stays``: the first by doc_id (null ids last),
    then row.  Null ids are carried (a component of none but null ids has a
    null component_id), repeated ids and rows stay rows; other columns are
    ignored; an empty table gives an empty result.  Copies share a
    fingerprint and are compared once; groups emit connecting links, not all
    pairs.  A place's group is held by one task as 8 bytes a distinct
    fingerprint.
    """
    marked = stored(fingerprints(docs, shingle), f"{name}-fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "row")
    each = marked.groupBy("fp").agg(F.min(place).alias("first"))
    reached = components(links(each, max_bits), name)
    rooted = each.join(reached, each["fp"] == reached["node"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    lowest = rooted.groupBy("root").agg(F.min("first").alias("lowest"))
    component = rooted.join(lowest, "root").select(F.col("fp").alias("of"), "lowest")
    return marked.join(component, marked["fp"] == component["of"], "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("lowest.doc_id").alias("component_id"),
        "row", (F.col("row") == F.col("lowest.row")).alias("stays"))
