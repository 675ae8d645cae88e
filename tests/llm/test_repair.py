"""Conversation repair against plain search over all edit strings of least cost."""

import hashlib
import random
import re

import pytest

from marketlens.llm import repair

BLANK = " \t\n\x0b\x0c\r"


def order(row):
    return (row[0] is not None, row[0] or 0, row[1], row[2])


def plain(rows):
    """rows: (turn, role, text) of one conversation, in any order."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows), key=order)
    turns = [t for t, _, _ in rows if t is not None]
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(BLANK)
        faults.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    best = {}

    def options(i, state):                       # letter, cost, next, left
        put = "assistant" if state == "u" else "user"
        yield "I", 5, (i, put[0]), f"{put}:"
        if i < len(rows):
            _, role, text = rows[i]
            yield "D", 2, (i + 1, state), None
            if faults[i] in ("", "truncated"):
                more = 5 if faults[i] else 0
                c = role[:1]
                if c and (state, c) in {("", "s"), ("", "u"), ("s", "u"), ("a", "u"), ("u", "a")}:
                    yield "K", more, (i + 1, c), f"{role}:{text}"
                yield "R", 1 + more, (i + 1, put[0]), f"{put}:{text}"

    # Least (cost, audit) to the end, settled in rounds until nothing changes.
    for i in range(len(rows), -1, -1):
        for state in ("", "s", "u", "a"):
            best[i, state] = (0, "", ()) if i == len(rows) and state in ("", "a") else (10**9, "", ())
        changed = True
        while changed:
            changed = False
            for state in ("", "s", "u", "a"):
                for letter, cost, then, left in options(i, state):
                    if then in best:
                        c, audit, out = best[then]
                        new = (cost + c, letter + audit, ((left,) if left is not None else ()) + out)
                        if new[:2] < best[i, state][:2]:
                            best[i, state], changed = new, True
    cost, audit, left = best[0, ""]
    initials = "".join(x.split(":")[0][:1] for x in left)
    assert re.fullmatch("(s?(ua)+)?", initials)
    pairs = zip(rows, rows[1:])
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit, hashlib.sha256("\n".join(left).encode()).hexdigest())


def table(spark, rows, parts=3):
    full = [(c, t, r, x, 7, "x", 1, True) for c, t, r, x in rows]
    return spark.createDataFrame(full, "conv_id long, turn long, role string, text string, seg int, audit string, n long, first boolean").repartition(parts)


def found(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


def expected(rows):
    by = {}
    for c, *rest in rows:
        by.setdefault(c, []).append(rest)
    return {c: plain(own) for c, own in by.items()}


ROLES = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "student"]
TEXTS = ["Yes.", "No!", "open", "", " \t", "a\n", "Why? \n", None, "Fine.\x1c", "x" * 50]


def made(rng, conversations, longest):
    rows = []
    for c in range(conversations):
        n = rng.randint(1, longest)
        for _ in range(n):
            text = rng.choice(TEXTS) if rng.random() < 0.4 else f"{rng.random()}."
            rows.append((c, rng.choice([None, *range(n)]), rng.choice(ROLES), text))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_small_conversations_equal_plain_search(spark, seed):
    rows = made(random.Random(seed), 120, 9)
    rows += [(None, 0, "system", "Be kind."), (None, 2, "user", "Hi."), (None, 3, "assistant", "Hello.")] + [(500, 1, "user", "Same.")] * 7
    assert found(repair.repair_conversations(table(spark, rows), name="t")) == expected(rows)


def test_long_conversations_cross_partitions(spark):
    rng = random.Random(9)
    rows = made(rng, 3, 400) + [(77, t, ("user", "assistant")[t % 2], f"Turn {t}." if t % 11 else "cut") for t in range(900)]
    rows += [(78, None, "assistant", "Same.")] * 300 + [(79, 1, "user", "word " * 200_000 + ".")]
    df = table(spark, rows)
    kept = spark.conf.get("spark.sql.adaptive.enabled"), spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        placed = repair.placed(df, "t")
        assert placed.where("conv_id = 77").select("seg").distinct().count() > 2
        assert found(repair.repair_conversations(df, name="t")) == expected(rows)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", kept[0])
        spark.conf.set("spark.sql.shuffle.partitions", kept[1])


def test_empty_table_and_conversations_without_rows(spark):
    none = table(spark, [(1, 1, "user", "x")]).where("false")
    assert repair.repair_conversations(none, name="t").collect() == []
    ids = table(spark, [(1, 1, "user", "x"), (None, 1, "user", "x")])
    empty = hashlib.sha256(b"").hexdigest()
    assert found(repair.with_all(repair.repair_conversations(none, name="t"), ids)) == {c: (0, 0, 0, 0, 0, 0, "", empty) for c in (1, None)}


def test_least_audit_among_equal_costs(spark):
    """Deleting comes before inserting, inserting before keeping, keeping before relabelling."""
    rows = [(1, 0, "user", "A."), (1, 1, "user", "B."), (2, 0, "system", "S."), (3, 0, "user", "cut"), (4, 0, "assistant", "A."), (4, 1, "user", "B.")]
    got = {k: v[5:7] for k, v in found(repair.repair_conversations(table(spark, rows), name="t")).items()}
    assert got == {1: (1, "KR"), 2: (2, "D"), 3: (2, "D"), 4: (2, "RR")}
