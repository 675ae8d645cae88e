import random
import re

import numpy as np
import pytest
import xxhash

from marketlens.llm import simhash
from marketlens.llm.common import LOWER


def plain(text, size=4):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().translate(LOWER))
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + size]) for i in range(len(words) - size + 1)] or [b" ".join(words)]
    h = [xxhash.xxh64(s, seed=42).intdigest() for s in shingles]
    return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))


def groups(prints, max_bits):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, x in enumerate(prints):
        for j in range(i):
            if (x ^ prints[j]).bit_count() <= max_bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def test_fingerprints_and_components(spark, stored_docs, edge_rows):
    rows = edge_rows
    prints = [plain(t) for _, t in rows]
    group = groups(prints, 4)
    lowest = {g: min((rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None), default=None) for g in group}
    got = simhash.near_duplicates(stored_docs(rows)).collect()
    expected = sorted((str(i), f"{p:016x}", lowest[g]) for (i, _), p, g in zip(rows, prints, group))
    assert sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in got) == sorted(expected, key=lambda r: r)
    stays = [r for r in got if r.stays]
    assert len(stays) == len(set(group)) and {r.component_id for r in stays} == set(lowest.values())


@pytest.mark.parametrize("max_bits", [0, 2, 4, 5])
def test_no_link_is_lost(spark, max_bits):
    rng = random.Random(max_bits)
    prints = [rng.getrandbits(64) for _ in range(150)] + [0, 2**64 - 1]
    for _ in range(500):                                        # chains and clusters around each other
        x = rng.choice(prints)
        for k in rng.sample(range(64), rng.randint(1, 6)):
            x ^= 1 << k
        prints.append(x)
    prints = sorted(set(prints))
    signed = np.array(prints, np.uint64).view(np.int64).tolist()
    found = simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3), max_bits).collect()
    place = {x: k for k, x in enumerate(signed)}
    assert all((prints[place[r.a]] ^ prints[place[r.b]]).bit_count() <= max_bits for r in found)
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for r in found:
        root[find(place[r.a])] = find(place[r.b])
    ours, theirs = [find(k) for k in range(len(prints))], groups(prints, max_bits)
    assert len(set(zip(ours, theirs))) == len(set(ours)) == len(set(theirs))


def test_dense_group_emits_a_forest():
    x = np.array([1 << k for k in range(40)], np.uint64)
    a, b = simhash.links_of(np.zeros(40, np.int64), x, 4)
    assert len(a) == 39


def test_golay_anchors_cover_every_word():
    flat, first, size = simhash.near_patterns(3)
    assert size.min() == size.max() == 1 and len(flat) == 2048   # a perfect code: one anchor within 3 bits


def test_empty_table(spark, stored_docs):
    assert simhash.near_duplicates(stored_docs([])).count() == 0
