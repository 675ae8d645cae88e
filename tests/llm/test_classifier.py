import random

import numpy as np

from marketlens.llm import classifier


WORDS = [a + b for a in "stone river cloud maple silver harbor winter lantern".split() for b in ("", "s", "ing", "ed")]


def prose(rng, n):
    return "\n".join(" ".join(rng.choice(WORDS) for _ in range(10)).capitalize() + "." for _ in range(n // 10 + 1))


def labelled(n, seed):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        text, mark = prose(rng, rng.randint(20, 200)), rng.random() < 0.8
        if not mark:
            junk = rng.choice(["###", "!!", " | "])
            text = " ".join(w + junk for w in text.split())
        rows.append((k, text))
        labels.append((k, int(mark)))
    return rows, labels


def test_held_out_accuracy(spark, stored_docs):
    rows, labels = labelled(400, 1)
    docs = stored_docs(rows)
    marks = spark.createDataFrame(labels, "doc_id long, quality int")
    ranker = classifier.train(docs, marks.where("doc_id % 3 != 1"))
    got = {r.doc_id: r for r in classifier.score(docs, ranker).collect()}
    held = [(i, q) for i, q in labels if i % 3 == 1]
    assert sum(got[i].predicted == q for i, q in held) / len(held) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_edges(spark, stored_docs, edge_rows):
    rows, labels = labelled(60, 2)
    docs = stored_docs(edge_rows + [(1000 + i, t) for i, t in rows])
    marks = spark.createDataFrame([(1000 + i, q) for i, q in labels] + [(None, 1), (1001, None), (1002, 7), (1003, 0), (1003, 1), (99_999, 0)], "doc_id long, quality int")
    got = classifier.score(docs, classifier.train(docs, marks, max_labelled=50)).collect()
    assert len(got) == len(edge_rows) + 60
    empty = {r.score for r in got if r.doc_id in (1, 2)}
    assert len(empty) == 1 and 0 <= empty.pop() <= 1


def test_without_labels_every_score_is_half(spark, stored_docs, edge_rows):
    docs = stored_docs(edge_rows)
    none = spark.createDataFrame([], "doc_id long, quality int")
    one = spark.createDataFrame([(7, 1), (8, 1)], "doc_id long, quality int")
    for marks in (none, one):
        assert {r.score for r in classifier.score(docs, classifier.train(docs, marks)).collect()} == {0.5}
    empty = stored_docs([])
    assert classifier.score(empty, classifier.train(empty, one)).count() == 0


def test_pairs_are_ranked():
    rng = np.random.default_rng(0)
    x = rng.random((300, classifier.N_FEATURES)) * 0.01
    y = (rng.random(300) < 0.7).astype(int)
    x[:, 3] += y * 0.5
    r = classifier.fit(x, y)
    s = r.scores(x)
    assert s[y == 1].min() > s[y == 0].max()
    assert ((s >= 0.5) == (y == 1)).mean() > 0.98
