"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

Texts and items are sequences of lowered words.  A CGK walk steps along a
sequence: at each step it emits the word it stands on, and a random bit of
step and word says whether it moves on.  Walks over sequences of small edit
distance emit much the same words at the same steps, so edit distance turns
into Hamming distance.  Each of several repetitions walks with bits of its
own and samples a few steps; windows that agree with an item in all sampled
words of a repetition are verified exactly.

Sampling misses long items with many edits, so an exact way stands beside it:
an item is cut into one segment more than edits are allowed, one of which no
edit touches, and a window that holds a segment is verified too.

Windows are item-sized: items fall into size classes, and a window starts at
every word.  A walk is only run from starts whose window holds enough word
pairs of the benchmark: k edits spoil at most 2k pairs, so nothing that could
be verified is lost there.  Segments are looked up in the same windows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import ROW, map_batches, numbered, stored
from marketlens.llm.line_dedup import segments
from marketlens.operators.broadcast import bounded_broadcast

#: Bytes of words (digits, letters, everything outside ASCII), A-Z lowered; all others become spaces.
WORDS = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))
PAIR_BITS = 27            # the set of word pairs and segments is a bitmap of 2**27 bits, whatever the benchmark's size
SEGMENT_WORDS = 8         # a longer segment is looked up by its first words
BROADCAST_ROWS = 500_000  # item keys are broadcast up to so many rows, counted first
GROWTH = 1.25             # of sizes from class to class
SPREAD, TURN = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Search:
    """What counts as a match, and how hard to look."""

    similarity: float = 0.8    # at most (1 - similarity) * words edits, rounded down
    min_words: int = 5         # items with fewer words are not looked for
    repetitions: int = 16      # walks with bits of their own
    samples: int = 3           # steps sampled in each
    seed: int = 11

    def edits(self, words: int) -> int:
        return int((1 - self.similarity) * words + 1e-9)

    def size_class(self, words: int) -> int:
        return int(np.floor(np.log(words / self.min_words) / np.log(GROWTH) + 1e-9))

    def class_size(self, c: int) -> int:
        return int(np.ceil(self.min_words * GROWTH**c - 1e-9))


class Hashes(dict):
    """64-bit hashes of words, computed once each while a bounded number is remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 1_000_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word) | 1
        return h


def symbols(texts: list[bytes | None], hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of some texts, each closed by a zero, and the end of each text in them."""
    lists = [(t or b"").translate(WORDS).split() for t in texts]
    ends = np.cumsum([len(x) + 1 for x in lists])
    out = np.zeros(int(ends[-1]), np.uint64)
    at = 0
    for x, end in zip(lists, ends.tolist()):
        out[at:end - 1] = np.fromiter(map(hashes.__getitem__, x), np.uint64, len(x))
        at = end
    return out, ends


def pair_bits(x: np.ndarray) -> np.ndarray:
    """The bitmap place of each pair of neighbours."""
    return ((x[:-1] * SPREAD ^ x[1:]) * TURN) >> np.uint64(64 - PAIR_BITS)


def walk_keys(x: np.ndarray, starts: np.ndarray, size: int, c: int, search: Search) -> np.ndarray:
    """LSH keys of the windows at some starts: a row per repetition.  ``x`` must end in zeros to stop at."""
    rng = np.random.default_rng([search.seed, c])
    # After s steps a walk has come about s / 2 words far; keep the samples inside the class's size.
    reach = max(search.samples, int(2 * size - 3 * np.sqrt(2 * size)))
    keys = np.empty((search.repetitions, len(starts)), np.uint64)
    for r in range(search.repetitions):
        turn = rng.integers(1, 1 << 63, reach, np.uint64) * np.uint64(2) + np.uint64(1)
        sampled = set(rng.choice(reach, search.samples, replace=False).tolist())
        at = starts.copy()
        key = np.full(len(starts), (c << 8 | r) + 1, np.uint64) * SPREAD
        for j in range(max(sampled) + 1):
            here = x[np.minimum(at, len(x) - 1)]
            if j in sampled:
                key = (key ^ here) * TURN
                key ^= key >> np.uint64(29)
            at = at + ((here * turn[j]) >> np.uint64(63)).astype(np.int64)
        keys[r] = key
    return keys


def run_keys(x: np.ndarray, size: int) -> np.ndarray:
    """Keys of all runs of ``size`` words, by their start."""
    n = max(0, len(x) - size + 1)
    key = np.full(n, size, np.uint64) * SPREAD
    for j in range(size):
        key = (key ^ x[j:j + n]) * TURN
        key ^= key >> np.uint64(29)
    return key


def segment_sizes(words: int, search: Search) -> list[tuple[int, int]]:
    """Start and looked-up words of the segments of an item: one more than it may have edits."""
    return [(at, min(n, SEGMENT_WORDS)) for at, n in segments(words, search.edits(words) + 1) if n]


def segment_keys(x: np.ndarray, search: Search) -> np.ndarray:
    """A key for each segment of an item."""
    return np.concatenate([run_keys(x[at:at + n], n) for at, n in segment_sizes(len(x), search)])


def closest(item: list[int], text: list[int]) -> int:
    """The smallest edit distance of the item to any run of the text, bit-parallel over the item's words."""
    n = len(item)
    full, last = (1 << n) - 1, 1 << (n - 1)
    where: dict[int, int] = {}
    for i, c in enumerate(item):
        where[c] = where.get(c, 0) | 1 << i
    plus, minus, score = full, 0, n
    best = n
    for c in text:
        match = where.get(c, 0)
        across = ((match & plus) + plus ^ plus) | match
        rise, fall = minus | ~(across | plus) & full, across & plus
        across_down = match | minus
        score += bool(rise & last) - bool(fall & last)
        rise, fall = rise << 1, fall << 1                    # a match may begin anywhere: row 0 stays 0
        plus, minus = (fall | ~(across_down | rise)) & full, across_down & rise
        best = min(best, score)
    return best


ITEM = "item_id long, item_row long, words binary, size_class int, keys array<long>"


def item_table(benchmark: DataFrame, search: Search) -> DataFrame:
    """The items with words enough: word hashes, size class, a key per repetition and segment."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = Hashes()
        for b in batches:
            out = []
            for i, row, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).cast(pa.binary()).to_pylist()):
                x, _ = symbols([t], hashes)
                if len(x) - 1 >= search.min_words:
                    c = search.size_class(len(x) - 1)
                    keys = walk_keys(x, np.zeros(1, np.int64), search.class_size(c), c, search)
                    keys = np.r_[keys[:, 0], segment_keys(x[:-1], search)]
                    out.append((i, row, x[:-1].tobytes(), c, keys.view(np.int64).tolist()))
            if out:
                kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=["item_id", "item_row", "words", "size_class", "keys"])

    rows = benchmark.select(benchmark["item_id"].cast("long").alias("item_id"), F.monotonically_increasing_id().alias("item_row"), benchmark["text"].cast("string").alias("text"))
    return map_batches(rows, run, ITEM)


def pair_set(items: DataFrame, search: Search) -> np.ndarray:
    """The bitmap of all word pairs and segments of the items; each task sends its own, compressed, and they are united."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << PAIR_BITS, bool)
        for b in batches:
            for w in b.column(0).to_pylist():
                x = np.frombuffer(w, np.uint64)
                bits[pair_bits(x)] = True
                bits[segment_keys(x, search) >> np.uint64(64 - PAIR_BITS)] = True
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(bits, bitorder="little").tobytes(), 1)], pa.binary())], names=["bits"])

    out = np.zeros(1 << (PAIR_BITS - 3), np.uint8)
    for r in map_batches(items.select("words"), run, "bits binary").toLocalIterator():
        out |= np.frombuffer(zlib.decompress(bytes(r["bits"])), np.uint8)
    return out


REGION = "row long, region long, words binary, keys array<long>"


def regions(docs: DataFrame, items: DataFrame, search: Search) -> DataFrame:
    """Parts of documents where an item may stand: their word hashes, the LSH keys of their windows, and the keys of segments in them."""
    spark = docs.sparkSession
    classes, segment_words = [], set()
    for r in items.groupBy("size_class").agg(F.min(F.length("words")).alias("least"), F.max(F.length("words")).alias("most")).collect():   # one row per class: some dozens
        sizes = range(r["least"] // 8, r["most"] // 8 + 1)
        need = min(n - 1 - 2 * search.edits(n) for n in sizes)
        segment_words |= {k for n in sizes for _, k in segment_sizes(n, search)}
        classes.append((r["size_class"], max(1, need), max(n + search.edits(n) for n in sizes)))
    pairs = spark.sparkContext.broadcast(pair_set(items, search).tobytes())
    classes.sort()

    def find(rows: list[int], texts: list[bytes | None], bitmap: np.ndarray, hashes: Hashes, first: int) -> list[tuple]:
        x, ends = symbols(texts, hashes)
        widest = max(w for _, _, w in classes)
        x = np.concatenate([x, np.zeros(widest + 2, np.uint64)])

        def known(place: np.ndarray) -> np.ndarray:
            return (bitmap[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1).astype(bool)

        hit = known(pair_bits(x)) & (x[:-1] != 0) & (x[1:] != 0)
        if not hit.any():
            return []
        total = np.r_[0, np.cumsum(hit)]
        text_end = np.repeat(ends, np.diff(np.r_[0, ends]))              # windows end with their text
        spots = np.arange(len(text_end))
        found, starts_of = [], []
        for c, need, width in classes:
            stop = np.minimum(spots + width, text_end)
            starts = np.flatnonzero((total[np.maximum(stop - 1, spots)] - total[spots] >= need) & (x[:len(spots)] != 0))
            if len(starts):
                found.append((starts, walk_keys(x, starts, search.class_size(c), c, search)))
                starts_of.append(np.stack([starts, np.minimum(starts + width, text_end[starts])]))
        if not found:
            return []
        spans = np.concatenate(starts_of, axis=1)
        order = np.argsort(spans[0], kind="stable")
        low, high = spans[0][order], np.maximum.accumulate(spans[1][order])
        new = np.r_[True, low[1:] >= high[:-1]]                          # spans that touch make a region
        a = low[new]
        z = high[np.r_[np.flatnonzero(new)[1:] - 1, len(high) - 1]]
        keys: list[list[np.ndarray]] = [[] for _ in a]
        for starts, k in found:
            at = np.searchsorted(a, starts, "right") - 1
            cuts = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
            for s, part in zip(cuts.tolist(), np.split(k, cuts[1:], axis=1)):
                keys[int(at[s])].append(part.ravel())
        inside = np.concatenate([np.arange(s, e) for s, e in zip(a.tolist(), z.tolist())])
        owners = np.repeat(np.arange(len(a)), z - a)
        for size in sorted(segment_words):
            k = run_keys(x, size)[inside]
            at = np.flatnonzero(known(k >> np.uint64(64 - PAIR_BITS)) & (inside + size <= z[owners]))
            for p in at.tolist():
                keys[int(owners[p])].append(k[p:p + 1])
        owner = np.searchsorted(ends, a, "right")
        return [(rows[int(o)], first + n, x[s:e].tobytes(), np.unique(np.concatenate(k)).view(np.int64))
                for n, (o, s, e, k) in enumerate(zip(owner, a.tolist(), z.tolist(), keys))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bitmap, hashes, n = np.frombuffer(pairs.value, np.uint8), Hashes(), 0
        for b in batches:
            at = 0
            sizes = np.cumsum(np.r_[0, b.column(1).cast(pa.binary()).to_pandas().map(lambda t: len(t or b"")).to_numpy()])
            while at < b.num_rows:                                       # some 2 MB of text at a time
                to = max(at + 1, int(np.searchsorted(sizes, sizes[at] + (2 << 20))))
                part = b.slice(at, to - at)
                out = find(part.column(0).to_pylist(), part.column(1).cast(pa.binary()).to_pylist(), bitmap, hashes, n)
                at, n = to, n + len(out)
                if out:
                    kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
                    yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(zip(*out), kinds)], names=["row", "region", "words", "keys"])

    if not classes:
        return spark.createDataFrame([], REGION)
    rows = docs.select(docs[ROW].alias("row"), docs["text"].cast("string").alias("text"))
    return map_batches(rows, run, REGION)


def matches(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), name: str = "decontaminate") -> DataFrame:
    """``row, item_id, distance``: documents (by row number, see ``numbered``) and the items that stand in them, verified."""
    items = stored(item_table(benchmark, search), f"{name}-items")
    found = stored(regions(docs, items, search), f"{name}-regions")
    item_keys = bounded_broadcast(items.select("item_row", F.explode("keys").alias("key")), BROADCAST_ROWS)
    candidates = found.select("row", "region", F.explode("keys").alias("key")).join(item_keys, "key").select("row", "region", "item_row").distinct()
    both = (candidates.join(found.select("row", "region", "words"), ["row", "region"])
            .join(items.select("item_row", "item_id", F.col("words").alias("item_words")), "item_row")
            .select("row", "item_id", "words", "item_words"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for row, item, words, own in zip(*(b.column(k).to_pylist() for k in range(4))):
                own = np.frombuffer(own, np.uint64).tolist()
                distance = closest(own, np.frombuffer(words, np.uint64).tolist())
                if distance <= search.edits(len(own)):
                    out.append((row, item, distance))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names=["row", "item_id", "distance"])

    checked = map_batches(both, verify, "row long, item_id long, distance long")
    return checked.groupBy("row", "item_id").agg(F.min("distance").alias("distance"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, search: Search = Search(), name: str = "decontaminate") -> DataFrame:
    """``doc_id, row, contaminated, item_ids`` (sorted array), one row per input row.

    Rows are numbered once, in a stored copy of doc_id and text, unless
    ``docs`` has the numbers (``numbered``); other columns are ignored.  An item stands in a document if some run of
    its words is within ``(1 - similarity) * words`` word edits of the item.
    Null and empty texts hold nothing; null ids are carried; an item with a
    null id counts for ``contaminated`` only; items of fewer than
    ``min_words`` words (null and empty ones) are not looked for; equal items
    are all reported; an empty table on either side leaves every document
    clean.  No match is missed, however many of its words are edited inside the
    limit: it holds a segment of the item that no edit touched.
    """
    docs = numbered(docs, ["doc_id", "text"], name)
    hits = stored(matches(docs, benchmark, search, name).groupBy("row").agg(F.array_sort(F.collect_set("item_id")).alias("item_ids")), f"{name}-hits")
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs[ROW].alias("at"))
    both = rows.join(hits, rows["at"] == hits["row"], "left")
    return both.select("doc_id", F.col("at").alias("row"), F.col("item_ids").isNotNull().alias("contaminated"), F.coalesce("item_ids", F.array().cast("array<long>")).alias("item_ids"))
