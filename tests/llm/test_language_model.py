import collections
import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import ef_trie, language_model
from marketlens.llm.common import LOWER


def brute(rows, held, prior):
    docs = [re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().translate(LOWER)) for _, t in rows]
    one, two = collections.Counter(), collections.Counter()
    for w, h in zip(docs, held):
        if not h:
            s = [b"", *w, b""]
            one.update(s[1:])
            two.update(zip(s, s[1:]))
    n, v = sum(one.values()), len(one)
    share = lambda w: (one[w] + 0.1) / (n + 0.1 * (v + 1))
    out = []
    for (i, _), w, h in zip(rows, docs, held):
        s = [b"", *w, b""]
        base = sum(math.log10(share(x)) for x in s[1:])
        score = sum(math.log10((two[a, b] + prior * share(b)) / (one[a] + prior)) for a, b in zip(s, s[1:]))
        out.append((str(i), h, len(w) + 1, sum(one[x] > 0 for x in s[1:]), n, base, score))
    return sorted(out)


@pytest.mark.parametrize("model", [language_model.Model(), language_model.Model(prior=7, block_bytes=3000, shard_bytes=6400)])
def test_equals_brute_force(spark, stored_docs, edge_rows, model):
    held = [i is not None and i % 4 == 0 for i, _ in edge_rows]
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
                 for r in language_model.score(stored_docs(edge_rows), F.col("doc_id") % 4 == 0, model).collect())
    for g, e in zip(got, brute(edge_rows, held, model.prior), strict=True):
        assert g[:5] == e[:5]
        assert math.isclose(g[5], e[5], rel_tol=1e-9)
        assert abs(g[6] - e[6]) <= 2 * ef_trie.STEP * g[2]


def test_no_training_texts_and_empty_table(spark, stored_docs):
    got = {r.doc_id: r for r in language_model.score(stored_docs([(1, "a b"), (2, None)]), F.lit(True)).collect()}
    assert (got[1].n_tokens, got[1].n_known, got[1].train_tokens, got[2].n_tokens) == (3, 0, 0, 1)
    assert got[1].base_score == got[1].score == 0
    assert language_model.score(stored_docs([]), F.lit(False)).count() == 0


def test_elias_fano_levels():
    rng = np.random.default_rng(0)
    for n, top in ((0, 1), (1, 5), (5, 1000), (1000, 3000), (3000, 2**64 - 1), (20_000, 10**6)):
        v = np.unique(rng.integers(0, top, n, np.uint64))
        e, _ = ef_trie.EliasFano.load(np.frombuffer(ef_trie.EliasFano.of(v).dump(), np.uint8), 0)
        assert len(v) == 0 or (e.get(np.arange(len(v))) == v).all()
        q = np.r_[rng.integers(0, top, 2000, np.uint64), v]
        place, equal = e.successor(q)
        assert (place == np.searchsorted(v, q)).all() and (equal == np.isin(q, v)).all()


def test_trie_answers_every_bigram():
    rng = np.random.default_rng(1)
    pairs = sorted({(int(a), int(b)) for a, b in zip(rng.integers(0, 200, 5000), rng.integers(0, 300, 5000))})
    context, word = (np.array(x, np.uint64) * np.uint64(1 << 50) + np.uint64(k) for k, x in enumerate(zip(*pairs)))
    p = rng.random(len(pairs)) + 1e-9
    trie = ef_trie.Trie(np.frombuffer(ef_trie.Trie.build(context, word >> np.uint64(24), p / 2), np.uint8))
    codes = trie.find(context, word >> np.uint64(24))
    assert (abs(np.log10(ef_trie.probabilities(codes) / (p / 2))) <= ef_trie.STEP).all()
    every = [(a, b) for a in range(205) for b in range(0, 305, 7)]
    asked = trie.find(*((np.array(x, np.uint64) * np.uint64(1 << 50) + np.uint64(k)) >> np.uint64(24 * k) for k, x in enumerate(zip(*every))))
    assert ((asked != ef_trie.NONE) == np.array([x in set(pairs) for x in every])).all()
