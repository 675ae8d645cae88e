"""Vector codes against rounds that meet every entry."""

import hashlib
import math

import numpy as np
import pytest

from marketlens.llm import vector_codes as V


def plain(rows, parts=4, entries=256, rounds=4):
    """rows: (vec_id, embedding, label); whole-integer arithmetic, all entries met."""
    kept = []
    for i, e, label in rows:
        if e is not None and e and all(v is not None and math.isfinite(v) for v in e):
            kept.append((i, [math.floor(1024 * float(np.float32(v))) for v in e], label))
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    if not kept:
        return [], hashlib.sha256(b"").hexdigest()
    w = len(kept[0][1]) // parts
    x = np.array([r[1] for r in kept], dtype=np.int64).reshape(len(kept), parts, w)
    books = x[:entries].transpose(1, 0, 2).copy()

    def nearest():
        d = ((x[:, :, None, :] - books[None]) ** 2).sum(3)
        return d.argmin(2), d.min(2)

    for _ in range(rounds):
        at, _ = nearest()
        for p in range(parts):
            for j in range(books.shape[1]):
                own = x[at[:, p] == j, p]
                if len(own):
                    books[p, j] = own.sum(0) // len(own)
    at, d = nearest()
    error = d.sum(1).tolist()
    totals = {}
    for (_, _, label), e in zip(kept, error):
        totals[label] = totals.get(label, 0) + e
    out = [(i, bytes(a.tolist()).hex(), e, totals[label]) for (i, _, label), a, e in zip(kept, at, error)]
    return out, hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def table(spark, rows):
    full = [(i, e, label, "x", 7, 7) for i, e, label in rows]
    return spark.createDataFrame(full, "vec_id long, embedding array<float>, label int, state string, x int, error int").repartition(3)


def check(spark, rows, **how):
    codes = V.encode_vectors(table(spark, rows), name="t", **how)
    got = [(r.vec_id, r.code, r.error, r.label_error) for r in V.with_label_errors(codes.rows).collect()]
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want, sha = plain(rows, **how)
    assert sorted(got, key=key) == sorted(want, key=key)
    assert codes.sha256 == sha
    return codes


@pytest.mark.parametrize("seed", range(3))
def test_equals_meeting_every_entry(spark, seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(40, 16)) * 0.2
    rows = [(i, (centres[rng.integers(40)] + rng.normal(size=16) * 0.05).tolist(), int(rng.integers(3))) for i in range(3000)]
    codes = check(spark, rows)
    assert any(share < 1 for last in codes.scanned for share in last)     # bounds spare some vectors the scan of all entries


def test_b_follows_what_was_needed():
    few = np.zeros(V.B_MOST + 2, int)
    few[[0, 2, 9]] = 900, 95, 5
    assert V.next_b(few, 16, 256) == V.B_LEAST
    many = np.zeros(V.B_MOST + 2, int)
    many[[0, 17]] = 50, 50
    assert V.next_b(many, 16, 256) == 32 and V.next_b(many, 16, 20) == 19


def test_states_keep_their_bounds_when_b_changes():
    rng = np.random.default_rng(3)
    x, books = rng.integers(-500, 500, (400, 8)), rng.integers(-500, 500, (2, 60, 4))
    state = V.first_state(x, books, [8, 8])
    for bs in ([4, 16], [16, 4], [59, 1]):
        new = books + rng.integers(-40, 40, books.shape)
        state = V.next_state(x, state, new, np.sqrt(((new - books) ** 2).sum(2)) * (1 + V.SLACK), bs)
        books = new
        for p in range(2):
            d = V.squares(x[:, 4 * p:4 * p + 4], books[p])
            assert (state["entry"][:, p] == d.argmin(1)).all()
            far = np.sqrt(d)
            assert (state["upper"][:, p] * (1 + 1e-6) >= far.min(1)).all()
            near = state[f"near{p}"].astype(int)
            assert (np.where(near >= 0, state[f"low{p}"] <= np.take_along_axis(far, np.maximum(near, 0), 1) * (1 + 1e-6), True)).all()
            listed = np.zeros(far.shape, bool)
            np.put_along_axis(listed, state["entry"][:, p, None].astype(int), True, 1)
            for k in range(near.shape[1]):
                listed[np.flatnonzero(near[:, k] >= 0), near[near[:, k] >= 0, k]] = True
            assert (np.where(listed, np.inf, far).min(1) * (1 + 1e-6) >= state["outer"][:, p]).all()


def test_ties_repeats_few_rows_and_edges(spark):
    nan, inf = float("nan"), float("inf")
    same = [0.25, -0.25, 0.5, 0.0]
    rows = [(1, same, 1), (1, same, 1), (2, [-0.0001, 0.0, 0.1, 3.0], None), (3, None, 1), (4, [0.1, None, 0.2, 0.3], 2), (5, [nan, 0.0, 0.0, 0.0], 2),
            (6, [0.0, inf, 0.0, 0.0], 2), (7, [0.0, -inf, 0.0, 0.0], 2), (None, [1.0, 1.0, 1.0, 1.0], None), (8, [], 3), (9, [0.1], 3)]
    kept = [r for r in rows if r[0] not in (8, 9)]
    want, sha = plain(kept)
    codes = V.encode_vectors(table(spark, rows), name="t")
    got = [(r.vec_id, r.code, r.error, r.label_error) for r in V.with_label_errors(codes.rows).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and codes.sha256 == sha


def test_one_hot_vector(spark):
    check(spark, [(i, [0.5] * 8 if i % 3 else [i / 100] * 8, i % 2) for i in range(1500)])


def test_empty_table(spark):
    codes = V.encode_vectors(table(spark, [(1, [0.0] * 4, 1)]).where("false"), name="t")
    assert V.with_label_errors(codes.rows).collect() == [] and codes.sha256 == hashlib.sha256(b"").hexdigest()


def test_components_out_of_range_are_an_error(spark):
    with pytest.raises(Exception, match="beyond"):
        V.encode_vectors(table(spark, [(1, [1e9, 0.0, 0.0, 0.0], 1)]), name="t")
