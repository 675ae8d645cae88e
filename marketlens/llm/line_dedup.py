"""Line deduplication by a segment-partition edit join.

Of two lines within ``t`` edits, cut into t+1 segments, one segment of the
shorter stands unchanged in the longer, at most t places away.  Every line
puts its segments into an index by length and segment number, and probes the
indexes of lengths up to t below its own with the substrings that the
positions allow.  Lines that meet are verified by banded bit-parallel edit
distance, and linked lines form classes, of which the first line stays.

Lines of one template share whole segments, so a segment may gather very many
of them.  Such a group is cut again, at places chosen for it where its lines
differ (:func:`cut_points`): what is said above holds for any t+1 segments,
so no pair is lost, and only lines that share a telling segment meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlens.llm.common import ROW, map_batches, numbered, stored
from marketlens.llm.components import components
from marketlens.operators.broadcast import bounded_broadcast

#: Sides of joins with texts are broadcast up to so many rows (8 bytes an id), counted first; beyond, texts are shuffled.
BROADCAST_ROWS = 1_000_000
#: Numbers of removed lines (4 bytes each) that may be broadcast in all; documents may hold any number of them.
BROADCAST_NUMBERS = 4_000_000
#: Groups of more lines than this are cut again before lines are compared, up to so many times.
GROUP_LINES, LEVELS = 64, 3
#: Lines of a group (and signs of them) that the choice of its cuts looks at; whatever the cuts, the result is the same.
SAMPLE_LINES, SAMPLE_CHARS = 128, 4_000_000
MEETING = "key long, short_id long, n int"


@dataclass(frozen=True)
class Limits:
    """``max_edits`` between lines of at least ``min_chars`` signs; shorter lines are compared exactly."""

    max_edits: int = 2
    min_chars: int = 12


def segments(size: int, parts: int) -> list[tuple[int, int]]:
    """Start and length of the segments of a line: as even as can be, longer ones last."""
    short, longer = divmod(size, parts)
    lengths = [short] * (parts - longer) + [short + 1] * longer
    return [(sum(lengths[:k]), n) for k, n in enumerate(lengths)]


def probe_places(size: int, other: int, parts: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(segment, start, length) of the substrings in which a line must look for the segments of a line of size ``other``."""
    longer, edits, places = size - other, len(parts) - 1, []
    for k, (at, n) in enumerate(parts):
        left, right = k, edits - k                           # edits that may lie before and behind the segment
        first = max(0, at - left, at + longer - right)
        last = min(size - n, at + left, at + longer + right)
        places += [(k, p, n) for p in range(first, last + 1)]
    return places


def probe_plan(size: int, edits: int) -> list[tuple[int, int, int, int]]:
    """(indexed length, segment, start, length) of every substring that a line of this size must look up."""
    return [(other, *place) for other in range(max(edits + 1, size - edits), size + 1)
            for place in probe_places(size, other, segments(other, edits + 1))]


def cut_points(lines: list[str], parts: int) -> list[int] | None:
    """Where to cut lines of one length into ``parts`` segments that tell most of them apart; None if no cuts do.

    The number of pairs that agree in a segment is to be small for the segment
    where it is largest: for a growing number, segments are made as short as
    it allows, from the left, until the last one keeps to it too.
    """
    size, pairs = len(lines[0]), len(lines) * (len(lines) - 1) // 2
    signs = np.frombuffer("".join(lines).encode("utf-32-le"), np.uint32).reshape(len(lines), size)
    telling = np.flatnonzero((signs != signs[0]).any(axis=0))

    def agreeing(group: np.ndarray) -> int:
        n = np.bincount(group)
        return int((n * (n - 1)).sum()) // 2

    most = 0
    while most * 2 < pairs:
        cuts, group = [], np.zeros(len(lines), np.int64)
        for at in telling:
            if at >= size - (parts - 1 - len(cuts)):
                break
            group = np.unique(group << 32 | signs[:, at], return_inverse=True)[1]
            if len(cuts) < parts - 1 and agreeing(group) <= most:
                cuts.append(int(at) + 1)
                group = np.zeros(len(lines), np.int64)
        if len(cuts) == parts - 1:
            for at in telling[telling >= cuts[-1]]:
                group = np.unique(group << 32 | signs[:, at], return_inverse=True)[1]
            if agreeing(group) <= most:
                return cuts
        most = most * 2 or 1
    return None


def edit_distance(a: str, b: str, most: int) -> int:
    """The edit distance of two texts if it is at most ``most``, else ``most`` + 1.

    Bit-parallel over a band of 2 * most + 1 diagonals.  Bit t of the vertical
    differences in column j is row j - most + t, so the band moves down by a
    row with each sign of ``b``; what lies outside counts as one more than
    its neighbour.  The value of the last cell is followed along its own
    diagonal, where it never falls, so the walk ends as soon as it is too large.
    """
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > most:
        return most + 1
    n = 0
    while n < len(a) and a[n] == b[n]:
        n += 1
    a, b = a[n:], b[n:]
    n = len(a)
    while n and a[n - 1] == b[n - 1 - len(a)]:
        n -= 1
    a, b = a[:n], b[:len(b) - len(a) + n]
    full, bottom = (1 << (2 * most + 1)) - 1, 1 << (2 * most)
    own = 1 << (most + len(a) - len(b))
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << (i + most)
    plus, minus, score = full ^ ((1 << (most + 1)) - 1), 0, 0      # column 0: row i has value i
    for j, c in enumerate(b):
        plus, minus = plus >> 1 | bottom, minus >> 1
        match = where.get(c, 0) >> j & full
        equal = ((match & plus) + plus ^ plus | match | minus) & full   # rows whose diagonal step costs nothing
        score += not equal & own
        if score > most:
            return most + 1
        right_up = (minus | full & ~(equal | plus)) << 1 | 1
        right_down = (equal & plus) << 1
        plus, minus = (right_down | ~(equal | right_up)) & full, equal & right_up
    return score


def rows_of(docs: DataFrame) -> DataFrame:
    """doc_id, text and the number of the row."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"), docs[ROW].alias("row"))


def lines_of(text: str | None) -> list[str]:
    return (text or "").split("\n")


def blank(line: str) -> bool:
    return not line or line.isspace()


OCCURRENCE = "line_id binary, size int, doc_id long, row long, line int"


def occurrences(docs: DataFrame) -> DataFrame:
    """Every line with a word: a 128-bit digest, its place, and its size in signs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            for at in range(0, b.num_rows, 2000):
                part = b.slice(at, 2000)
                out = [(xxhash.xxh3_128_digest(x), len(x), d, r, k)
                       for d, t, r in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist())
                       for k, x in enumerate(lines_of(t)) if not blank(x)]
                if out:
                    kinds = (pa.binary(), pa.int32(), pa.int64(), pa.int64(), pa.int32())
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=[x.split()[0] for x in OCCURRENCE.split(", ")])

    return map_batches(rows_of(docs), run, OCCURRENCE)


def each_line(batches: Iterator[pa.RecordBatch], min_chars: int, forget: int = 200_000) -> Iterator[tuple[str, bytes]]:
    """Lines of at least ``min_chars`` signs and their digests, each about once a task (a bounded number is remembered)."""
    import xxhash

    seen: set[bytes] = set()
    for b in batches:
        for t in b.column(0).to_pylist():
            for x in lines_of(t):
                if len(x) >= min_chars and (i := xxhash.xxh3_128_digest(x)) not in seen and not x.isspace():
                    seen.add(i)
                    yield x, i
        if len(seen) > forget:
            seen.clear()


def short_id(line_id: bytes) -> int:
    """Part of a digest, with the low bit free to mark an index entry."""
    return int.from_bytes(line_id[:8], "little") & ~1


def key_batch(key: list[int], ids: list[int]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.array(x, np.uint64).view(np.int64)) for x in (key, ids)], names=["key", "short_id"])


def live(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by key, the lines whose key holds another line and an index entry, and how many lines it holds."""

    def kept(key: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
        start = np.r_[True, key[1:] != key[:-1]]
        group = np.cumsum(start) - 1
        me = ids & ~np.int64(1)
        first = me[np.flatnonzero(start)][group]
        two = np.bincount(group, me != first) > 0                        # more than one line
        index = np.bincount(group, ids & 1) > 0                          # one of them as an index entry
        take = (two & index)[group]
        pairs = np.unique(np.stack([key[take], me[take]]), axis=1)
        _, place, n = np.unique(pairs[0], return_inverse=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1]), pa.array(n[place], pa.int32())], names=["key", "short_id", "n"])

    held_k, held_i, n = [], [], 0
    for b in batches:
        if not b.num_rows:
            continue
        k, i = b.column(0).to_numpy(), b.column(1).to_numpy()
        held_k.append(k)
        held_i.append(i)
        n += len(k)
        if n >= 200_000 and held_k[0][0] != k[-1]:
            key, ids = np.concatenate(held_k), np.concatenate(held_i)
            cut = int(np.searchsorted(key, key[-1]))
            yield kept(key[:cut], ids[:cut])
            held_k, held_i, n = [key[cut:]], [ids[cut:]], len(key) - cut
    if n:
        yield kept(np.concatenate(held_k), np.concatenate(held_i))


def lines_that_meet(keys: DataFrame) -> DataFrame:
    return map_batches(keys.repartition("key").sortWithinPartitions("key"), live, MEETING)


def meetings(docs: DataFrame, limits: Limits) -> DataFrame:
    """``key, short_id, n``: lines that share a segment with another line where the edit limit allows it, n in all."""
    edits = limits.max_edits

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh64_intdigest
        plans: dict[int, list] = {}
        key, ids = [], []
        for x, i in each_line(batches, max(limits.min_chars, edits + 1)):
            n = len(x)
            if n not in plans:
                plans[n] = ([((n << 4) + k, p, p + m) for k, (p, m) in enumerate(segments(n, edits + 1))],
                            [((o << 4) + k, p, p + m) for o, k, p, m in probe_plan(n, edits)])
            own, probes = plans[n]
            me = short_id(i)
            key += [digest(x[a:b], seed) for seed, a, b in own]
            ids += [me | 1] * len(own)                                   # the low bit marks an index entry
            key += [digest(x[a:b], seed) for seed, a, b in probes]
            ids += [me] * len(probes)
            if len(key) > 100_000:
                yield key_batch(key, ids)
                key.clear()
                ids.clear()
        if key:
            yield key_batch(key, ids)

    return lines_that_meet(map_batches(docs.select(docs["text"].cast("string").alias("text")), keys, "key long, short_id long"))


def split_groups(large: DataFrame, line: DataFrame, edits: int, name: str) -> tuple[DataFrame, DataFrame]:
    """Lines of large groups that still meet when their group is cut anew, and the groups for which no cuts are found.

    The shortest lines of a group are those indexed in it (the others probe,
    and meet each other under keys of their own lengths), so they are cut.
    Cuts come from a bounded number of lines a group; the lines themselves
    stay spread over all tasks.
    """
    met = large.select("key", "short_id").join(line, "short_id").select("key", "short_id", "text")
    place = Window.partitionBy("key").orderBy(F.length("text"), "short_id")
    sample = met.withColumn("place", F.row_number().over(place)).where(F.col("place") <= SAMPLE_LINES)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = ((k, x) for b in batches for k, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        for key, group in groupby(rows, lambda r: r[0]):
            some: list[str] = []
            for _, x in group:
                if not some or len(x) == len(some[0]) and len(some) * len(x) < SAMPLE_CHARS:
                    some.append(x)
            size = len(some[0])
            cuts = cut_points(some, edits + 1) if len(some) > 1 else [at for at, _ in segments(size, edits + 1)[1:]]
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.int64()), pa.array([size], pa.int32()), pa.array([cuts], pa.list_(pa.int32()))], names=["key", "size", "cuts"])

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for b in batches:
            key, ids = [], []
            for old, me, x, size, cuts in zip(*[c.to_pylist() for c in b.columns]):
                bounds = [0, *cuts, size]
                parts = [(p, q - p) for p, q in zip(bounds, bounds[1:])]
                own = list(enumerate(parts)) if len(x) == size else []
                for k, p, m, mark in [(k, p, m, 1) for k, (p, m) in own] + [(*place, 0) for place in probe_places(len(x), size, parts)]:
                    key.append(xxhash.xxh64_intdigest(x[p:p + m], (old + k + 1) % (1 << 64)))
                    ids.append(me % (1 << 64) | mark)
            yield key_batch(key, ids)

    cuts = stored(map_batches(sample.select("key", "text", "place").repartition("key").sortWithinPartitions("key", "place").select("key", "text"),
                              choose, "key long, size int, cuts array<int>"), f"{name}-cuts")
    cut = bounded_broadcast(cuts.where(F.col("cuts").isNotNull()), BROADCAST_ROWS // 4)
    again = map_batches(met.join(cut, "key").select("key", "short_id", "text", "size", "cuts"), keys, "key long, short_id long")
    rest = large.join(bounded_broadcast(cuts.where(F.col("cuts").isNull()), BROADCAST_ROWS // 4), "key", "left_semi")
    return stored(lines_that_meet(again), f"{name}-meetings"), rest


def near_links(docs: DataFrame, limits: Limits, name: str) -> DataFrame:
    """Links ``a, b`` (line digests) that connect all lines within the edit limit."""
    met = stored(meetings(docs, limits), f"{name}-meetings")

    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            short = np.array([short_id(i) for i in ids], np.uint64).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(short), pa.array(ids, pa.binary()), pa.array(lines, pa.string())], names=["short_id", "line_id", "text"])

        lines: list[str] = []
        ids: list[bytes] = []
        for x, i in each_line(batches, limits.min_chars):
            lines.append(x)
            ids.append(i)
            if len(lines) >= 5000:
                yield out()
                lines.clear()
                ids.clear()
        if lines:
            yield out()

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def linked(group: dict[bytes, str]) -> Iterator[tuple[bytes, bytes]]:
            left = sorted(group.items(), key=lambda x: len(x[1]))
            queue: list = []
            while left:                                                  # what is reached leaves the group
                if not queue:
                    queue.append(left.pop())
                i, x = queue.pop()
                rest = []
                for item in left:
                    if edit_distance(x, item[1], limits.max_edits) <= limits.max_edits:
                        queue.append(item)
                        yield (min(i, item[0]), max(i, item[0]))
                    else:
                        rest.append(item)
                left = rest

        key, group, found = None, {}, set()
        for b in batches:
            for k, i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if k != key:
                    found.update(linked(group))
                    key, group = k, {}
                group[i] = x
            if len(found) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])
                found.clear()
        found.update(linked(group))
        if found:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])

    rows = docs.select(docs["text"].cast("string").alias("text"))
    wanted = bounded_broadcast(stored(met.select("short_id").distinct(), f"{name}-met"), BROADCAST_ROWS)
    line = map_batches(rows, texts, "short_id long, line_id binary, text string").join(wanted, "short_id", "left_semi").dropDuplicates(["line_id"])
    large = met.where(F.col("n") > GROUP_LINES)
    if not large.isEmpty():
        line, small = stored(line, f"{name}-texts"), [met.where(F.col("n") <= GROUP_LINES)]
        for level in range(LEVELS):
            again, whole = split_groups(large, line, limits.max_edits, f"{name}-level{level}")
            small += [again.where(F.col("n") <= GROUP_LINES), whole]
            large = again.where(F.col("n") > GROUP_LINES)
            if large.isEmpty():
                break
        met = reduce(DataFrame.unionByName, [*small, large])
    meeting = met.join(line, "short_id").select("key", "line_id", "text")
    return map_batches(meeting.repartition("key").sortWithinPartitions("key"), verify, "a binary, b binary").distinct()


def duplicate_lines(docs: DataFrame, limits: Limits = Limits(), name: str = "lines") -> tuple[DataFrame, DataFrame]:
    """The occurrences of lines, and ``row, removed`` (numbers of the lines that go, from 0) where any go.

    ``docs`` must have row numbers (``numbered``).
    A line goes if an earlier one (by doc_id, row, place) is in its class:
    equal, or reached over links of up to ``max_edits`` edits.
    """
    places = stored(occurrences(docs), f"{name}-places")
    place = F.struct("doc_id", "row", "line")
    each = places.groupBy("line_id").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    links = near_links(docs, limits, name)
    reached = components(links, name)
    classed = each.join(reached, each["line_id"] == reached["node"], "left").select("line_id", "first", "n", F.coalesce("root", "line_id").alias("root"))
    lowest = classed.groupBy("root").agg(F.min("first").alias("stays"), F.sum("n").alias("all")).where(F.col("all") > 1)
    doomed = classed.join(lowest, "root").select(F.col("line_id").alias("of"), "stays")
    gone = places.join(doomed, places["line_id"] == doomed["of"]).where((F.col("row") != F.col("stays.row")) | (F.col("line") != F.col("stays.line")))
    return places, gone.groupBy("row").agg(F.sort_array(F.collect_list("line")).alias("removed"))   # a document's lines


def dedup_lines(docs: DataFrame, limits: Limits = Limits(), keep: tuple[str, ...] = ("doc_id",), name: str = "lines") -> DataFrame:
    """The columns in ``keep``, ``n_lines``, ``removed`` (line numbers) and ``text`` without them, per input row.

    Rows are numbered once, in a stored copy of the columns used;
    columns not in ``keep`` are ignored, except doc_id and text.  Blank lines
    neither count as duplicates nor go.  A null text counts as empty and
    comes back empty; null ids come before others, so their lines stay; of
    repeated rows the first in reading order keeps its lines; an empty table
    gives an empty result.  Lines travel as digests; texts only of lines that
    share a segment with another.
    """
    docs = numbered(docs, list(dict.fromkeys([*keep, "doc_id", "text"])), name)
    gone = stored(duplicate_lines(docs, limits, name)[1], f"{name}-gone")
    if (gone.agg(F.sum(F.size("removed"))).first()[0] or 0) <= BROADCAST_NUMBERS:
        gone = bounded_broadcast(gone, BROADCAST_ROWS // 4)
    rows = docs.select(*keep, docs["text"].cast("string").alias("own text"), docs[ROW].alias("own row"))
    both = rows.join(gone, rows["own row"] == gone["row"], "left")
    text = F.coalesce("own text", F.lit(""))
    cut = both.select(*[rows[c] for c in keep], text.alias("own text"), F.split(text, "\n", -1).alias("own lines"), F.coalesce("removed", F.array().cast("array<int>")).alias("removed"))
    # An array of one element binds the lines, so that a text is split once and not for each line.
    joined = F.transform(F.array("own lines"), lambda own: F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.size(own) - 1), "removed"), lambda i: F.get(own, i)), "\n"))[0]
    left = F.when(F.size("removed") == 0, F.col("own text")).otherwise(joined)
    return cut.select(*keep, F.size("own lines").alias("n_lines"), "removed", left.alias("text"))
