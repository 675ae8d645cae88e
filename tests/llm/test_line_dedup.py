import random

import numpy as np
import pytest
import xxhash

from marketlens.llm import line_dedup
from marketlens.llm.line_dedup import Limits, edit_distance


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return row[-1]


def test_banded_distance_equals_the_table():
    rng = random.Random(1)
    for _ in range(4000):
        most = rng.randint(0, 4)
        a = [rng.choice("abc") for _ in range(rng.randint(0, 14))]
        b = list(a)
        for _ in range(rng.randint(0, 5)):
            if b and rng.random() < 0.5:
                b.pop(rng.randrange(len(b)))
            else:
                b.insert(rng.randrange(len(b) + 1), rng.choice("abc"))
        assert edit_distance("".join(a), "".join(b), most) == min(plain_distance(a, b), most + 1)


def test_near_lines_always_share_a_probe():
    rng = random.Random(4)
    for _ in range(3000):
        edits = rng.randint(1, 3)
        a = "".join(rng.choice("abcdef") for _ in range(rng.randint(edits + 2, 30)))
        b = list(a)
        for _ in range(edits):
            k = rng.randrange(len(b) + 1)
            b[k:k + rng.randint(0, 1)] = rng.choice(["", "z", "a"])
        b = "".join(b)
        short, long_ = sorted((a, b), key=len)
        if len(short) <= edits:
            continue
        own = {(len(short), k, short[p:p + n]) for k, (p, n) in enumerate(line_dedup.segments(len(short), edits + 1))}
        assert own & {(o, k, long_[p:p + n]) for o, k, p, n in line_dedup.probe_plan(len(long_), edits)}


def brute(rows, limits):
    """Kept texts by the rule in the docstring, from all pairs of distinct lines; rows are in reading order."""
    first = {}
    ranked = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, k))
    place = {k: n for n, k in enumerate(ranked)}
    for k, (_, text) in enumerate(rows):
        for n, x in enumerate((text or "").split("\n")):
            if x.strip():
                first[x] = min(first.get(x, (place[k], n)), (place[k], n))
    root = {x: x for x in first}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    long_ = sorted(x for x in first if len(x) >= limits.min_chars)
    for i, x in enumerate(long_):
        for y in long_[i + 1:]:
            if edit_distance(x, y, limits.max_edits) <= limits.max_edits:
                root[find(x)] = find(y)
    stays = {}
    for x, p in first.items():
        stays[find(x)] = min(stays.get(find(x), p), p)
    out = []
    for k, (i, text) in enumerate(rows):
        lines = (text or "").split("\n")
        out.append((i, "\n".join(x for n, x in enumerate(lines) if not x.strip() or stays[find(x)] == (place[k], n))))
    return out


@pytest.mark.parametrize("parts", [1, 4])
def test_equals_all_pairs(spark, stored_docs, edge_rows, parts):
    rng = random.Random(9)
    lines = [x for _, t in edge_rows for x in (t or "").split("\n") if 12 <= len(x) < 300]
    more = []
    for k in range(60):
        x = list(rng.choice(lines))
        for _ in range(rng.randint(0, 4)):
            p = rng.randrange(len(x))
            x[p:p + rng.randint(0, 1)] = rng.choice("abcxyz ")
        more.append((500 + k, "".join(x) + "\n\nown line number " + "abcdefghij"[k % 10] * 9 + str(k) * 5))
    docs = stored_docs(edge_rows + more, parts)
    rows = [(r.doc_id, r.text) for r in docs.collect()]        # in reading order
    got = line_dedup.dedup_lines(docs).collect()
    key = lambda r: (str(r[0]), r[1])
    assert sorted(((r.doc_id, r.text) for r in got), key=key) == sorted(brute(rows, Limits()), key=key)


def test_one_common_line_and_empty_table(spark, stored_docs):
    docs = stored_docs([(k, f"A line that stands everywhere.\nOwn words {'abcdefghijklmnopqrstuvwxyz'[k % 26] * (8 + k)}") for k in range(40)])
    got = {r.doc_id: r for r in line_dedup.dedup_lines(docs).collect()}
    assert got[0].removed == [] and all(got[k].removed == [0] for k in range(1, 40))
    assert line_dedup.dedup_lines(stored_docs([])).count() == 0


def test_many_removed_lines_are_not_broadcast(spark, stored_docs, monkeypatch):
    docs = stored_docs([(k, "\n".join(["A line that stands everywhere."] * 50)) for k in range(3)])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in line_dedup.dedup_lines(docs)._jdf.queryExecution().executedPlan().toString()
        monkeypatch.setattr(line_dedup, "BROADCAST_NUMBERS", 100, raising=False)
        found = line_dedup.dedup_lines(docs)
        assert "BroadcastHashJoin" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.doc_id, len(r.removed)) for r in found.collect()) == [(0, 49), (1, 50), (2, 50)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def template_lines(count, digits=10, seed=3):
    rng = random.Random(seed)
    out = {f"Order number {rng.randrange(10 ** digits):0{digits}d} has been shipped from the main warehouse to the customer" for _ in range(count)}
    return sorted(out)


def with_near_copies(lines, step, seed=5):
    """Every ``step``-th line also with two edits, each a dropped, changed or added sign."""
    rng = random.Random(seed)
    out = list(lines)
    for x in lines[::step]:
        y = list(x)
        for _ in range(2):
            p = rng.randrange(len(y))
            y[p:p + rng.randint(0, 1)] = rng.choice(["", "7", "x"])
        out.append("".join(y))
    return sorted(set(out))


def test_cuts_lie_where_lines_differ():
    cuts = line_dedup.cut_points(template_lines(128), 3)
    assert len(cuts) == 2 and 14 <= cuts[0] < cuts[1] <= 22
    assert line_dedup.cut_points(["a" * 20 + c for c in "bcdefg"], 3) is None
    assert line_dedup.cut_points(["\U0001f600" * 3 + x + "é" * 9 for x in ("abc", "bcd", "cde", "def")], 3) == [4, 5]


@pytest.mark.parametrize("digits", [3, 5, 10])
def test_lines_of_one_template_equal_all_pairs(spark, stored_docs, monkeypatch, digits):
    monkeypatch.setattr(line_dedup, "GROUP_LINES", 8)
    lines = with_near_copies(template_lines(250, digits), 5)
    random.Random(1).shuffle(lines)
    docs = stored_docs([(k, x) for k, x in enumerate(lines)], 3)
    got = line_dedup.dedup_lines(docs).collect()
    assert sorted((r.doc_id, r.text) for r in got) == sorted(brute(list(enumerate(lines)), Limits()))


def test_large_groups_are_cut_before_lines_are_compared(spark, stored_docs):
    lines = template_lines(3000)
    docs = stored_docs([(k, "\n".join(lines[k::300])) for k in range(300)], 4)
    met = line_dedup.stored(line_dedup.meetings(docs, Limits()), "m")
    ids = np.array([line_dedup.short_id(xxhash.xxh3_128_digest(x)) for x in lines], np.uint64).view(np.int64)
    line = spark.createDataFrame(list(zip(ids.tolist(), lines)), "short_id long, text string")
    large = met.where("n > 64")
    assert large.groupBy("key").count().where("count = 3000").count() >= 2
    again, whole = line_dedup.split_groups(large, line, 2, "s")
    assert whole.isEmpty() and (again.agg({"n": "max"}).first()[0] or 0) < 64
