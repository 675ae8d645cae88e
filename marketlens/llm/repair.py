"""Conversation structure repair: the cheapest edits that make a conversation read (system?)(user assistant)+.

Rows are numbered by one global sort, so a partition of the sorted table holds
whole conversations and, at its two ends, pieces of conversations that may go
on in its neighbours.  Per piece, a cost DP runs backward over the four states
of the pattern; the arcs that keep its cost are ranked by the first 2, 4, 8 ...
steps of their least edit string, and the same doubling of pointers reads the
least path from the start.

Pieces at the ends of partitions meet by min-plus matrices: the costs behind a
piece come from the pieces after it, its entry state from those before it.  So
a conversation of any length is spread over tasks; only its matrices, one for
each piece, meet in one, and its text streams through one task to be hashed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlens.llm.common import map_batches, stored
from marketlens.operators.broadcast import bounded_broadcast

#: What edits cost.
RELABEL, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: States by what the output ends with: nothing, a system row, a user row, an assistant row.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after a user or assistant row is put behind a state, and that row's role.
AFTER = np.array([USER, USER, ASSISTANT, USER])
PUT = ("user", "user", "assistant", "user")
#: The state after a kept row, by its initial (s, u, a, other) and the state before; -1: it can't be kept.
KEPT = np.array([[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1] * 4])
LETTERS = b"\0DIKR"
FAR = 1 << 50
SPACES = " \t\n\x0b\x0c\r"
#: Rows that are ranked together.
BLOCK = 20_000
#: Pieces at the ends of partitions (two for each) are broadcast up to so many, counted first.
BROADCAST_PIECES = 100_000

COUNTS = ("blank", "duplicate", "truncated", "illegal")
RESULT = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def placed(rows: DataFrame, name: str) -> DataFrame:
    """Rows in order under a partition (seg) and position (pos), equal rows as one with their number n.

    ``first``: no earlier row of the conversation has its role and text;
    ``cut``: its last character other than white space ends no sentence.
    """
    key = ["conv_id", "turn", "role", "text"]
    every = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")]).groupBy(*key).agg(F.count(F.lit(1)).alias("n"))
    digest = F.sha2(F.col("text").cast("binary"), 256)
    every = every.withColumn("digest", digest)
    firsts = (every.groupBy("conv_id", "role", "digest").agg(F.min(F.struct("turn")).alias("least"))
              .select(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"), F.col("least.turn").alias("t"), F.lit(True).alias("first")))
    # A first row is found by its own turn: no key of this join is shared by many rows.
    same = every["conv_id"].eqNullSafe(firsts["c"]) & (every["role"] == firsts["r"]) & (every["digest"] == firsts["d"]) & every["turn"].eqNullSafe(firsts["t"])
    end = F.rtrim("text", F.lit(SPACES))
    told = every.join(firsts, same, "left").select(
        *key, "n", F.coalesce("first", F.lit(False)).alias("first"), (end == "").alias("blank"), (~F.substring(end, -1, 1).isin(".", "!", "?")).alias("cut"))
    ordered = told.orderBy(F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text")
    return stored(ordered.select(F.spark_partition_id().alias("seg"), F.monotonically_increasing_id().alias("pos"), *told.columns), f"{name}-placed", "zstd")


class Piece:
    """The rows of one conversation in one partition; each step stands for a row, or for the further copies of one (only ever deleted)."""

    def __init__(self, conv, seg, rows: dict[str, list]):
        self.conv, self.seg, self.rows = conv, seg, rows
        role, n = rows["role"], rows["n"]
        initial = [{"s": 0, "u": 1, "a": 2}.get(r[:1], 3) for r in role]
        steps = []
        for i, (c, copies, first, blank, cut) in enumerate(zip(initial, n, rows["first"], rows["blank"], rows["cut"])):
            steps.append((i, c, blank or not first, cut and not blank and first, 1))
            if copies > 1:
                steps.append((i, c, True, False, copies - 1))
        self.row, self.initial, self.forced, self.cut, self.times = map(np.array, zip(*steps))
        told = zip(n, rows["first"], rows["blank"], rows["cut"])
        blank = sum(k for k, _, b, _ in told if b)
        self.counts = dict(
            blank=blank, duplicate=int(self.times[self.forced].sum()) - blank, truncated=int(self.cut.sum()),
            illegal=sum(a + b not in ("su", "ua", "au") for a, b in zip((r[:1] for r in role), (r[:1] for r in role[1:]))) + sum(n) - len(n))

    def costs(self, end: list[int]) -> np.ndarray:
        """Cost from every (step, state) to the end, ``end`` being the costs behind the last step."""
        out = np.empty((len(self.row) + 1, 4), np.int64)
        e = out[-1] = end
        for i in range(len(self.row) - 1, -1, -1):
            if self.forced[i]:
                t = [min(FAR, v + DELETE * int(self.times[i])) for v in e]
            else:
                extra = TRUNCATED if self.cut[i] else 0
                keep = KEPT[self.initial[i]]
                t = [min(e[s] + DELETE, e[AFTER[s]] + RELABEL + extra, e[keep[s]] + extra if keep[s] >= 0 else FAR) for s in range(4)]
            out[i] = e = inserted(t)
        return out


def inserted(t: list[int]) -> list[int]:
    """Costs once rows may also be inserted before the next step."""
    user = min(t[USER], t[ASSISTANT] + INSERT)
    return [min(t[START], user + INSERT), min(t[SYSTEM], user + INSERT), user, min(t[ASSISTANT], t[USER] + INSERT)]


#: Costs behind the last row: an output that ends with nothing or an assistant row is whole.
WHOLE = inserted([0, FAR, FAR, 0])


def read_paths(pieces: list[Piece], costs: list[np.ndarray], last: list[bool], starts: list[list[int]]) -> list[list[tuple[np.ndarray, int]]]:
    """For each piece and entry state: the nodes (4 * step + state) of its least optimal path, and the state behind it.

    A node's arcs that keep the optimal cost carry different letters, and a
    letter leads to one node.  Ranks of nodes by their first 2^k steps order
    the arcs; the pointers of each round are kept and give the node after
    any number of steps.
    """
    sizes = np.array([c.size for c in costs])
    base = np.cumsum(sizes) - sizes
    letter, jump = [], []
    for piece, c, ends, at in zip(pieces, costs, last, base.tolist()):
        n = len(piece.row)
        arcs = np.full((n + 1, 4, 4), -1, np.int64)                    # by letter: the node it leads to
        node = at + 4 * np.arange(n + 1)[:, None]
        forced, extra = piece.forced[:, None], np.where(piece.cut, TRUNCATED, 0)[:, None]
        state = np.arange(4)[None, :]
        here, there = c[:-1], c[1:]
        at_next = node[:-1] + 4
        arcs[:-1, :, 0] = np.where(here == there + DELETE * np.where(piece.forced, piece.times, 1)[:, None], at_next + state, -1)
        arcs[:, :, 1] = np.where(c == c[:, AFTER] + INSERT, node + AFTER[None, :], -1)
        if not ends:
            arcs[-1] = -1                                               # the next piece goes on from there
        keep = KEPT[piece.initial]
        arcs[:-1, :, 2] = np.where(~forced & (keep >= 0) & (here == np.take_along_axis(there, np.maximum(keep, 0), 1) + extra), at_next + keep, -1)
        arcs[:-1, :, 3] = np.where(~forced & (here == there[:, AFTER] + RELABEL + extra), at_next + AFTER[None, :], -1)
        arcs = arcs.reshape(-1, 4)
        found = arcs >= 0
        best = np.where(found.any(1), found.argmax(1), -1)              # the least letter
        letter.append(best + 1)
        jump.append(np.where(best >= 0, np.take_along_axis(arcs, np.maximum(best, 0)[:, None], 1)[:, 0], at + np.arange(len(arcs))))
    rank, pointer = np.concatenate(letter), np.concatenate(jump)
    length = (rank > 0).astype(np.int64)
    pointers = [pointer]
    while True:
        further = length[pointer]
        if not further.any():
            break
        length = length + further
        rank = np.unique(rank * (int(rank.max()) + 1) + rank[pointer], return_inverse=True)[1]
        pointer = pointer[pointer]
        pointers.append(pointer)
    begin = np.array([at + s for at, states in zip(base.tolist(), starts) for s in states])
    steps = length[begin]
    nodes, t = np.repeat(begin, steps), np.arange(int(steps.sum())) - np.repeat(np.cumsum(steps) - steps, steps)
    for k, p in enumerate(pointers):
        nodes = np.where((t >> k) & 1, p[nodes], nodes)
    exits = pointers[-1][begin]
    paths, out = iter(zip(np.split(nodes, np.cumsum(steps)[:-1]), exits.tolist())), []
    flat = np.concatenate(letter)
    for piece, at, states in zip(pieces, base.tolist(), starts):
        own = []
        for _ in states:
            path, end = next(paths)
            own.append((path - at, (end - at) % 4, flat[path]))
        out.append(own)
    return out


def edits(piece: Piece, path: np.ndarray, letters: np.ndarray) -> tuple[str, list[str]]:
    """The audit of a path and the rows it leaves, as ``role:text``."""
    audit, rows, role, text = [], [], piece.rows["role"], piece.rows["text"]
    for node, code in zip(path.tolist(), letters.tolist()):
        step, state, letter = node // 4, node % 4, chr(LETTERS[code])
        if letter == "D":
            audit.append("D" * int(piece.times[step]))
            continue
        audit.append(letter)
        if letter == "I":
            rows.append(f"{PUT[state]}:")
        else:
            i = piece.row[step]
            rows.append(f"{role[i] if letter == 'K' else PUT[state]}:{text[i]}")
    return "".join(audit), rows


def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Piece, bool]]:
    """The pieces of sorted rows, and whether each is the first or the last of its partition."""
    pending, begun, key = None, None, None

    def close(rows, key, edge):
        return Piece(key[1], key[0], rows), edge

    for batch in batches:
        columns = {name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)}
        convs, segs = columns["conv_id"], columns["seg"]
        at = 0
        for i in range(batch.num_rows + 1):
            if i < batch.num_rows and key == (segs[i], convs[i]):
                continue
            if key is not None and i > at:
                for name in pending:
                    pending[name].extend(columns[name][at:i])
            if i == batch.num_rows:
                break
            if key is not None:
                yield close(pending, key, begun != key[0] or segs[i] != key[0])
                begun = key[0]
            key, at = (segs[i], convs[i]), i
            pending = {name: [] for name in ("turn", "role", "text", "n", "first", "blank", "cut")}
    if key is not None:
        yield close(pending, key, True)


def in_pieces(rows: DataFrame) -> DataFrame:
    """Rows dealt by partition number, in order."""
    return rows.repartition("seg").sortWithinPartitions("seg", "pos")


def gaps(turns: list) -> tuple[int | None, int | None, int]:
    """Least and greatest turn, and how many there are; rows are in the order of turns."""
    own = [t for t in turns if t is not None]
    return (own[0], own[-1], len(set(own))) if own else (None, None, 0)


def blocks(pieces: Iterator) -> Iterator[list]:
    """Lists of pieces of about BLOCK rows."""
    block, size = [], 0
    for item in pieces:
        block.append(item)
        size += len(item[0].row)
        if size >= BLOCK:
            yield block
            block, size = [], 0
    if block:
        yield block


EDGE = "conv_id long, seg int, blank long, duplicate long, truncated long, illegal long, least long, most long, turns long, initials string, matrix binary"


def table_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(schema), schema)], schema=schema)


def arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in ddl.split(", ")])


BOTH = f"edge boolean, {RESULT}, seg int, least long, most long, turns long, initials string, matrix binary"


def first_pass(rows: DataFrame, name: str) -> DataFrame:
    """Results of conversations inside a partition, and for the pieces at its ends their counts and cost matrix."""
    schema = arrow(BOTH)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(runs(batches)):
            out, inner = [], [p for p, edge in block if not edge]
            costs = [p.costs(WHOLE) for p in inner]
            for p, c, [(path, _, letters)] in zip(inner, costs, read_paths(inner, costs, [True] * len(inner), [[START]] * len(inner)) if inner else []):
                least, most, turns = gaps(p.rows["turn"])
                audit, left = edits(p, path, letters)
                sha = hashlib.sha256("\n".join(left).encode("utf-8", "replace")).hexdigest()
                out.append((False, p.conv, most - least + 1 - turns if turns else 0, *[p.counts[c] for c in COUNTS], int(c[0, START]), audit, sha, *[None] * 6))
            for p in (p for p, edge in block if edge):
                ends = np.full((4, 4), FAR, np.int64)
                for s in range(4):
                    ends[:, s] = p.costs([0 if s == e else FAR for e in range(4)])[0]
                least, most, turns = gaps(p.rows["turn"])
                initials = (p.rows["role"][0][:1] or "\0") + (p.rows["role"][-1][:1] or "\0")
                out.append((True, p.conv, None, *[p.counts[c] for c in COUNTS], None, None, None, p.seg, least, most, turns, initials, ends.tobytes()))
            yield table_of(out, schema)

    return stored(map_batches(in_pieces(rows), run, BOTH), f"{name}-first", "zstd")


def by_conversation(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("conv_id").sortWithinPartitions(F.asc_nulls_first("conv_id"), *order)


def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[dict]]:
    """Lists of the rows of a conversation (few for each: one for each partition it reaches)."""
    group: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if group and group[0]["conv_id"] != row["conv_id"]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


ENDS = "conv_id long, seg int, behind binary, last boolean, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"


def joined_edges(edges: DataFrame, name: str) -> DataFrame:
    """For each piece the costs behind it; the totals of the conversation on its last piece."""
    schema = arrow(ENDS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            out, behind = [], list(WHOLE)
            for row in reversed(group):
                out.append([row["conv_id"], row["seg"], np.array(behind, np.int64).tobytes(), row is group[-1], *[None] * 6])
                matrix = np.frombuffer(row["matrix"], np.int64).reshape(4, 4)
                behind = [int(v) for v in np.minimum(FAR, (matrix + np.array(behind)[None, :]).min(1))]
            told = [r for r in group if r["turns"]]
            turns = sum(r["turns"] for r in told) - sum(a["most"] == b["least"] for a, b in zip(told, told[1:]))
            span = told[-1]["most"] - told[0]["least"] + 1 - turns if told else 0
            met = sum(a["initials"][1] + b["initials"][0] not in ("su", "ua", "au") for a, b in zip(group, group[1:]))
            out[0][4:] = [span, *[sum(r[c] for r in group) + (met if c == "illegal" else 0) for c in COUNTS], behind[START]]
            yield table_of(out, schema)

    return stored(map_batches(by_conversation(edges.select(*[f.name for f in arrow(EDGE)]), "seg"), run, ENDS), f"{name}-ends")


def second_pass(rows: DataFrame, ends: DataFrame, name: str) -> DataFrame:
    """For each piece and entry state, the state behind its least path; then each piece's entry state."""
    schema = arrow("conv_id long, seg int, behind binary, last boolean, exits binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, behind, last, _ in with_ends(batches):
            paths = read_paths([piece], [piece.costs(behind)], [last], [[START, SYSTEM, USER, ASSISTANT]])[0]
            yield table_of([(piece.conv, piece.seg, np.array(behind, np.int64).tobytes(), last, bytes(end for _, end, _ in paths))], schema)

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups(batches):
            state, out = START, []
            for row in group:
                out.append((row["conv_id"], row["seg"], row["behind"], row["last"], state))
                state = row["exits"][state]
            yield table_of(out, arrow("conv_id long, seg int, behind binary, last boolean, entry int"))

    exits = map_batches(with_rows(rows, ends.withColumn("entry", F.lit(0))), run, "conv_id long, seg int, behind binary, last boolean, exits binary")
    return stored(map_batches(by_conversation(exits, "seg"), enter, "conv_id long, seg int, behind binary, last boolean, entry int"), f"{name}-entries")


def with_rows(rows: DataFrame, ends: DataFrame) -> DataFrame:
    """The rows of the pieces at the ends of partitions, with the costs behind them."""
    e = bounded_broadcast(ends.select(F.col("conv_id").alias("c"), F.col("seg").alias("s"), "behind", "last", "entry"), BROADCAST_PIECES)
    return in_pieces(rows.join(e, (rows["seg"] == e["s"]) & rows["conv_id"].eqNullSafe(e["c"])).drop("c", "s"))


def with_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[Piece, list[int], bool, int]]:
    """Pieces with the costs behind them, whether they are the last, and their entry state."""
    told: dict = {}

    def noted() -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            keys = zip(*(b.column(names.index(c)).to_pylist() for c in ("seg", "conv_id", "behind", "last", "entry")))
            told.update({(seg, conv): rest for seg, conv, *rest in keys})
            yield b.select([n for n in names if n not in ("behind", "last", "entry")])

    for piece, _ in runs(noted()):
        behind, last, entry = told.pop((piece.seg, piece.conv))
        yield piece, np.frombuffer(behind, np.int64).tolist(), last, entry


def third_pass(rows: DataFrame, entries: DataFrame, ends: DataFrame) -> DataFrame:
    """The audit and hash of the conversations at the ends of partitions: pieces of the output in order, streamed."""
    pieces = arrow("conv_id long, seg int, audit string, left binary, n_left long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece, behind, last, entry in with_ends(batches):
            path, _, letters = read_paths([piece], [piece.costs(behind)], [last], [[entry]])[0][0]
            audit, left = edits(piece, path, letters)
            yield table_of([(piece.conv, piece.seg, audit, "\n".join(left).encode("utf-8", "replace"), len(left))], pieces)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = arrow("conv_id long, audit string, repaired_sha256 string")
        begun, conv, audit, sha, any_left = False, None, [], None, False
        for b in batches:
            for i in range(b.num_rows):                # a piece at a time: the hash needs them in order, but not together
                own, piece, left, n = (b.column(k)[i].as_py() for k in (0, 2, 3, 4))
                if not begun or own != conv:
                    if begun:
                        yield table_of([(conv, "".join(audit), sha.hexdigest())], schema)
                    begun, conv, audit, sha, any_left = True, own, [], hashlib.sha256(), False
                audit.append(piece)
                if n:
                    sha.update((b"\n" if any_left else b"") + left)
                    any_left = True
        if begun:
            yield table_of([(conv, "".join(audit), sha.hexdigest())], schema)

    found = map_batches(by_conversation(map_batches(with_rows(rows, entries), run, "conv_id long, seg int, audit string, left binary, n_left long"), "seg"),
                        joined, "conv_id long, audit string, repaired_sha256 string").withColumnRenamed("conv_id", "c")
    totals = ends.where("last").select("conv_id", "gaps", *COUNTS, "cost")
    return totals.join(found, totals["conv_id"].eqNullSafe(found["c"])).drop("c")


def repair_conversations(rows: DataFrame, name: str = "repair") -> DataFrame:
    """Structure faults and the cheapest repair of every conversation (columns conv_id, turn, role, text; others are ignored).

    Rows are taken by turn, null turns first, equal turns by role and text.
    A null role or text counts as one space, a null conv_id is a
    conversation of its own, an empty role has no initial and can't be kept.
    Of equal rows the first is judged by its text, the others are
    duplicates.  Among cheapest edits those with the ASCII-least audit are
    taken (D, I, K and R for delete, insert, keep and relabel).  Very long
    texts and conversations are carried whole; an empty table gives no rows.
    """
    numbered = placed(rows, name)
    first = first_pass(numbered, name)
    ends = joined_edges(first.where("edge"), name)
    entries = second_pass(numbered, ends, name)
    columns = [f.name for f in arrow(RESULT)]
    return first.where("not edge").select(*columns).unionByName(third_pass(numbered, entries, ends).select(*columns))


def with_all(repaired: DataFrame, conversations: DataFrame) -> DataFrame:
    """One row for every conv_id of ``conversations``; one that has no rows left gets zeros, no audit and the hash of nothing."""
    ids = conversations.select(F.col("conv_id").cast("long").alias("c")).distinct()
    every = ids.join(repaired, ids["c"].eqNullSafe(repaired["conv_id"]), "left")
    numbers = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", *COUNTS, "cost")]
    return every.select(F.col("c").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"),
                        F.coalesce("repaired_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("repaired_sha256"))
