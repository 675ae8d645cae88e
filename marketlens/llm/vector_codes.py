"""Vector codes: each vector part is replaced by the number of its nearest codebook entry.

The codebooks are learned in rounds (assign, then replace every entry by the
mean of its parts) with adaptive distance bounds: beside a part's entry, the
state keeps an upper bound of its distance, the b closest other entries with
ordered lower bounds, and one outer bound for all entries beyond them.  When
the entries have moved, most parts keep their entry by these bounds alone;
the uncertain ones are decided by integer distances, first to the b entries,
then to all.  b is set anew after each round from how many bounds were needed.

The state is a table in the shared folder, one for each round; what reaches
the driver is bounded by the size of the codebooks.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import map_batches, stored
from marketlens.operators.broadcast import bounded_broadcast

#: Largest integer component; squared distances of 64 components this far apart still fit a long.
LIMIT = 1 << 27
#: Bounds closer than this (relative, and in absolute units) count as uncertain.
SLACK = 1e-9
B_FIRST, B_LEAST, B_MOST = 16, 4, 64
#: Share of a part's vectors that may outrun the b bounds before b grows; b shrinks to what the rest needed.
BEYOND = 0.01
ROWS_AT_ONCE = 4096
#: Sums by label are broadcast up to so many labels, counted first.
BROADCAST_LABELS = 100_000


@dataclass(frozen=True)
class Codes:
    """``rows``: vec_id, label, code, error (and the columns of the vectors' table that were asked for); ``codebooks``: parts x entries x width."""

    rows: DataFrame
    codebooks: np.ndarray
    bounds: list[list[int]]     # b of each part, by round
    scanned: list[list[float]]  # share of each part's vectors that met all entries, by round after the first

    @property
    def sha256(self) -> str:
        return hashlib.sha256(",".join(map(str, self.codebooks.reshape(-1).tolist())).encode()).hexdigest()


def integer_vectors(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, label and x (floors of the scaled components) of the vectors without null or non-finite components."""
    e = F.col("embedding")
    bad = F.exists(e, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    scaled = F.transform(e, lambda v: F.floor(v.cast("double") * scale))
    far = F.exists(scaled, lambda v: F.abs(v) > LIMIT)
    checked = F.when(far, F.raise_error(F.lit(f"a component is beyond {LIMIT} after scaling"))).otherwise(scaled)
    return vectors.where(e.isNotNull() & ~F.coalesce(bad, F.lit(True))).select("vec_id", "label", checked.cast("array<int>").alias("x"))


def state_type(bs: list[int]) -> np.dtype:
    n = len(bs)
    return np.dtype([("entry", "u1", n), ("used", "u2", n), ("upper", "f8", n), ("outer", "f8", n),
                     *[(f"near{p}", "i2", (b,)) for p, b in enumerate(bs)], *[(f"low{p}", "f8", (b,)) for p, b in enumerate(bs)]])


def squares(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of every row to every entry."""
    top = max(int(np.abs(x).max(initial=0)), int(np.abs(entries).max(initial=0)))
    if 4 * max(1, x.shape[1]) * top * top < 1 << 53:      # every number below is an exact float
        xf, ef = x.astype(np.float64), entries.astype(np.float64)
        return ((xf * xf).sum(1)[:, None] - 2 * xf @ ef.T + (ef * ef).sum(1)[None]).astype(np.int64)
    out = np.zeros((len(x), len(entries)), np.int64)
    for j in range(x.shape[1]):
        out += (x[:, j, None] - entries[None, :, j]) ** 2
    return out


def scan(x: np.ndarray, entries: np.ndarray, b: int) -> tuple[np.ndarray, ...]:
    """Nearest entry, distance, the b next ones with distances, and the distance beyond them, by meeting all entries."""
    n, k = len(x), len(entries)
    d = squares(x, entries)
    entry = d.argmin(1)                                    # the lowest number of equal ones
    own = d[np.arange(n), entry]
    order = np.argsort(d, axis=1, kind="stable")
    order = order[order != entry[:, None]].reshape(n, k - 1)
    near, low = np.full((n, b), -1, np.int16), np.full((n, b), np.inf)
    have = min(b, k - 1)
    near[:, :have] = order[:, :have]
    low[:, :have] = np.sqrt(np.take_along_axis(d, order[:, :have], 1))
    outer = np.sqrt(d[np.arange(n), order[:, b]].astype(np.float64)) if k - 1 > b else np.full(n, np.inf)
    return entry, own, near, low, outer


def surely_below(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    return upper * (1 + SLACK) + SLACK < lower


def first_state(x: np.ndarray, entries: np.ndarray, bs: list[int]) -> np.ndarray:
    out = np.zeros(len(x), state_type(bs))
    w = entries.shape[2]
    for p, b in enumerate(bs):
        entry, own, out[f"near{p}"], out[f"low{p}"], out["outer"][:, p] = scan(x[:, p * w:(p + 1) * w], entries[p], b)
        out["entry"][:, p], out["upper"][:, p] = entry, np.sqrt(own)
    return out


def next_state(x: np.ndarray, old: np.ndarray, entries: np.ndarray, moved: np.ndarray, bs: list[int]) -> np.ndarray:
    """The state after the entries have moved by ``moved`` (parts x entries); ``used`` tells how many bounds were needed, b + 1 for a scan of all."""
    out = np.zeros(len(x), state_type(bs))
    w = entries.shape[2]
    for p, b in enumerate(bs):
        part, c, shift = x[:, p * w:(p + 1) * w], entries[p], moved[p]
        entry = old["entry"][:, p].astype(np.int64)
        upper = old["upper"][:, p] + shift[entry]
        near, low = old[f"near{p}"].astype(np.int64), old[f"low{p}"]
        low = np.where(near >= 0, low - shift[near], np.inf)
        outer = old["outer"][:, p] - shift.max(initial=0)
        if near.shape[1] > b:                             # fewer bounds from now on: the rest joins the outer one
            outer = np.minimum(outer, low[:, b:].min(1))
            near, low = near[:, :b], low[:, :b]
        elif near.shape[1] < b:
            more = b - near.shape[1]
            near, low = np.pad(near, ((0, 0), (0, more)), constant_values=-1), np.pad(low, ((0, 0), (0, more)), constant_values=np.inf)
        nearest = np.minimum(low.min(1, initial=np.inf), outer)
        unsure = np.flatnonzero(~surely_below(upper, nearest))
        own = ((part[unsure] - c[entry[unsure]]) ** 2).sum(1)
        upper[unsure] = np.sqrt(own)
        still = ~surely_below(upper[unsure], nearest[unsure])
        unsure, own = unsure[still], own[still]
        used = np.zeros(len(x), np.uint16)
        used[unsure] = (~surely_below(upper[unsure, None], low[unsure])).sum(1)
        # Integer distances to the own entry and the b near ones.
        ids = np.concatenate([entry[unsure, None], near[unsure]], axis=1)
        d = ((part[unsure][:, None, :] - c[ids]) ** 2).sum(2)
        d[:, 1:][near[unsure] < 0] = np.iinfo(np.int64).max
        order = np.lexsort((ids, d), axis=1)
        ids, d = np.take_along_axis(ids, order, 1), np.take_along_axis(d, order, 1)
        inside = surely_below(np.sqrt(d[:, 0].astype(np.float64)), outer[unsure])
        rows = unsure[inside]
        entry[rows], upper[rows] = ids[inside, 0], np.sqrt(d[inside, 0])
        known = d[inside, 1:] < np.iinfo(np.int64).max
        near[rows] = np.where(known, ids[inside, 1:], -1)
        low[rows] = np.where(known, np.sqrt(d[inside, 1:]), np.inf)
        rest = unsure[~inside]
        if len(rest):
            entry[rest], own, near[rest], low[rest], outer[rest] = scan(part[rest], c, b)
            upper[rest], used[rest] = np.sqrt(own), b + 1
        # Ordered again: entries moved by different steps.
        order = np.argsort(low, axis=1, kind="stable")
        out[f"near{p}"], out[f"low{p}"] = np.take_along_axis(near, order, 1), np.take_along_axis(low, order, 1)
        out["entry"][:, p], out["used"][:, p], out["upper"][:, p], out["outer"][:, p] = entry, used, upper, outer
    return out


def matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def records(column: pa.Array, kind: np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def packed(state: np.ndarray) -> pa.Array:
    size, data = state.dtype.itemsize, state.tobytes()
    return pa.array([data[i:i + size] for i in range(0, len(data), size)], pa.binary())


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return (b.slice(at, ROWS_AT_ONCE) for b in batches for at in range(0, b.num_rows, ROWS_AT_ONCE))


def cells_of(state: DataFrame, kind: np.dtype, parts: int, entries: int, width: int) -> dict[int, int]:
    """Sums by (part, entry, position), with counts at the position behind the last, and counts of how many bounds were needed."""
    stride, histogram = width + 1, parts * entries * (width + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(histogram + parts * (B_MOST + 2), np.int64)
        sums = total[:histogram].reshape(parts, entries, stride)
        needed = total[histogram:].reshape(parts, B_MOST + 2)
        for b in slices(batches):
            x, rec = matrix(b.column(0), parts * width), records(b.column(1), kind)
            for p in range(parts):
                entry = rec["entry"][:, p]
                sums[p, :, width] += np.bincount(entry, minlength=entries)
                for j in range(width):
                    sums[p, :, j] += np.bincount(entry, weights=x[:, p * width + j], minlength=entries).astype(np.int64)
                needed[p] += np.bincount(rec["used"][:, p], minlength=B_MOST + 2)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at], pa.int64())], names=["cell", "n"])

    found = map_batches(state.select("x", "state"), run, "cell long, n long").groupBy("cell").agg(F.sum(F.col("n").cast("decimal(20,0)")).alias("n"))
    return {int(r.cell): int(r.n) for r in found.collect()}           # at most parts * (entries * (width + 1) + bounds) cells


def encode_vectors(vectors: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024, name: str = "codes") -> Codes:
    """Codes of all vectors (columns vec_id, embedding, label; others are ignored).

    Vectors that are null, or hold a null or non-finite component, are
    dropped.  The width is that of most kept vectors (the larger at a tie)
    that ``parts`` divides; vectors of another length, empty ones too, have
    no code and are dropped.  The codebooks start as the parts of the
    ``entries`` smallest vec_ids (equal ids by their components, null ids
    last); fewer vectors give fewer entries.  Equal distances go to the
    lower entry, an entry without parts stays.  Null and repeated ids and
    labels are carried row by row; an empty table gives no rows and empty
    codebooks.  A component beyond 2^27 after scaling is an error.
    """
    clean = stored(integer_vectors(vectors, scale), f"{name}-vectors", "zstd")
    sizes = clean.groupBy(F.size("x").alias("n")).count().where((F.col("n") > 0) & (F.col("n") % parts == 0))
    most = sizes.orderBy(F.desc("count"), F.desc("n")).first()
    if most is None:
        nothing = clean.where(F.lit(False)).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return Codes(nothing, np.zeros((parts, 0, 0), np.int64), [], [])
    dims = most.n
    width = dims // parts
    clean = clean.where(F.size("x") == dims)
    seeds = clean.orderBy(F.asc_nulls_last("vec_id"), "x").limit(entries).collect()
    books = np.array([r.x for r in seeds], np.int64).reshape(len(seeds), parts, width).transpose(1, 0, 2)
    k = books.shape[1]
    bs, bounds, scanned = [min(B_FIRST, max(1, k - 1))] * parts, [], []
    state, kind, moved = clean, None, None
    schema = "vec_id " + dict(clean.dtypes)["vec_id"] + ", label " + dict(clean.dtypes)["label"] + ", x array<int>, state binary"
    for _ in range(rounds):
        state, kind = assigned(state, kind, books, moved, bs, schema, name), state_type(bs)
        bounds.append(list(bs))
        cells = cells_of(state, kind, parts, k, width)
        sums = np.array([cells.get(i, 0) for i in range(parts * k * (width + 1))], dtype=object).reshape(parts, k, width + 1)
        count = sums[:, :, width:]
        means = np.where(count > 0, sums[:, :, :width] // np.where(count > 0, count, 1), books.astype(object)).astype(np.int64)
        moved = np.sqrt(((means - books) ** 2).sum(2)) * (1 + SLACK)
        books = means
        needed = np.array([cells.get(i, 0) for i in range(parts * k * (width + 1), parts * k * (width + 1) + parts * (B_MOST + 2))]).reshape(parts, -1)
        if len(bounds) > 1:
            scanned.append([float(h[b + 1] / h.sum()) for h, b in zip(needed, bs)])
            bs = [next_b(h, b, k) for h, b in zip(needed, bs)]
    return Codes(final(state, kind, books, moved, bs, name), books, bounds, scanned)


def next_b(needed: np.ndarray, b: int, k: int) -> int:
    """Twice b if too many vectors outran it, else as many bounds as all but a share of them needed."""
    if needed[b + 1] > BEYOND * needed.sum():
        wanted = 2 * b
    else:
        wanted = int(np.searchsorted(np.cumsum(needed[:b + 1]), (1 - BEYOND) * needed.sum()))
    return max(1, min(max(wanted, B_LEAST), B_MOST, k - 1))


def assigned(state: DataFrame, kind: np.dtype | None, books: np.ndarray, moved: np.ndarray | None, bs: list[int], schema: str, name: str) -> DataFrame:
    """One assignment of every part, written as the next state."""
    dims = books.shape[0] * books.shape[2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = matrix(b.column(2), dims)
            new = first_state(x, books, bs) if kind is None else next_state(x, records(b.column(3), kind), books, moved, bs)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), packed(new)], names=["vec_id", "label", "x", "state"])

    return stored(map_batches(state.select("vec_id", "label", "x", *(["state"] if kind is not None else [])), run, schema), f"{name}-state", "zstd")


def final(state: DataFrame, kind: np.dtype, books: np.ndarray, moved: np.ndarray, bs: list[int], name: str) -> DataFrame:
    """The last assignment, as codes and exact errors."""
    parts, _, width = books.shape
    types = dict(state.dtypes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            x = matrix(b.column(2), parts * width)
            entry = next_state(x, records(b.column(3), kind), books, moved, bs)["entry"]
            chosen = books[np.arange(parts), entry].reshape(len(x), parts * width)
            error = ((x - chosen) ** 2).sum(1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([r.tobytes().hex() for r in entry]), pa.array(error, pa.int64())], names=["vec_id", "label", "code", "error"])

    return stored(map_batches(state, run, f"vec_id {types['vec_id']}, label {types['label']}, code string, error long"), f"{name}-coded", "zstd")


def with_label_errors(coded: DataFrame) -> DataFrame:
    """``label_error``: the errors of all rows of a label, rows without a label together."""
    totals = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    totals = bounded_broadcast(totals, BROADCAST_LABELS)
    return coded.join(totals, coded["label"].eqNullSafe(totals["of"])).drop("of")
