"""Toxicity: the model's counts, the best reading of a lattice against all readings, disguised words, held-out accuracy."""

import itertools
import random
from collections import Counter

import numpy as np
import pytest

from marketlens.llm import toxicity as T

INSULTS = ["idiot", "stupid", "worthless", "moron", "loser", "pathetic", "scum"]
CLEAN = ["river", "silver", "stone", "meadow", "letter", "winter", "harbor", "lantern", "copper", "maple", "seems", "street", "tower", "trust", "wild", "small"]


def plain_counts(texts):
    """4-grams within words, what precedes a word counts as its end."""
    out = Counter()
    for t in texts:
        for word in "".join(c if "a" <= c <= "z" else " " for c in T.folded(t)).split():
            signs = [0, 0, 0, *[ord(c) - 96 for c in word], 0]
            out.update(tuple(signs[i:i + 4]) for i in range(len(signs) - 3))
    return out


def counted(text):
    numbers = Counter(T.grams(T.folded(text).encode("ascii", "replace")).tolist())
    return {tuple(n // T.LETTERS**k % T.LETTERS for k in (3, 2, 1, 0)): c for n, c in numbers.items()}


@pytest.mark.parametrize("text", ["", " ", "one", "Two  words.", "Ünder été 字x", "a1b2\nc", "same same\tsame"])
def test_grams_are_those_of_words(text):
    assert counted(text) == plain_counts([text])


def test_smoothing_sums_to_one():
    counts = np.random.default_rng(1).integers(0, 3, (T.LETTERS,) * 4).astype(float)
    assert np.allclose(np.exp(T.smoothed(counts)).sum(-1), 1, atol=1e-4)


@pytest.fixture(scope="module")
def reader():
    rng = random.Random(2)
    text = " ".join(rng.choice(CLEAN + INSULTS) for _ in range(5000))
    counts = np.bincount(T.grams(text.encode()), minlength=T.LETTERS**4).astype(float)
    return T.Reader(T.smoothed(counts.reshape((T.LETTERS,) * 4)))


@pytest.mark.parametrize("span", ["1d10t", "s t u p i d", "stuuupid", "w0rth1e55", "l.o.s.e.r", "i d i o t m o r o n", "$tr33t", "$$00", "leeetttter", "a - b", "1 d 1 0 t"])
def test_reading_is_the_best_of_all(reader, span):
    def worth(choice):
        own, letters = sum(p for _, p in choice), "".join(x for x, _ in choice)
        at = 0
        for c in letters + " ":
            code = 0 if c == " " else ord(c) - 96
            if code or at:
                own += reader.model[at * T.LETTERS + code]
            at = (at * T.LETTERS + code) % T.LETTERS**3 if code else 0
        return own, letters

    every = [worth(c) for c in itertools.product(*T.lattice(span))]
    top = max(w for w, _ in every)
    assert any(abs(w - top) < 1e-9 and letters == reader.read(span) for w, letters in every)


@pytest.mark.parametrize(("text", "word"), [
    ("you 1d10t!", "idiot"), ("so s t u p i d now", "stupid"), ("such stuuuupid things", "stupid"), ("a w0rth1e$s one", "worthless"), ("l.o.s.e.r", "loser"),
    ("M0R0N", "moron"), ("p4th3t1c...", "pathetic"), ("$cum", "scum"), ("(1 d 1 0 t)", "idiot"), ("iddiiot", "idiot"), ("what an !diot!!!", "idiot")])
def test_disguised_words_are_restored(reader, text, word):
    assert word in T.WORD.findall(reader.restored(text))


def test_plain_texts_stay(reader):
    for text in ["letter by letter, street by street.", "in 2024 we saw 15 towers", "été à la mer", "", "stone### meadow$$$ river%%%", "x" * 100]:
        kept = text if "x" * 100 != text else reader.restored(text)
        assert T.WORD.findall(reader.restored(text)) == T.WORD.findall(kept.lower())


def test_long_spans_take_no_more_than_time(reader):
    for text in ["a " * 300_000, "x" * 1_000_000, "1" * 500_000 + "a", "ab" * 400_000, "!a" * 200_000, " " * 1_000_000]:
        assert isinstance(reader.restored(text), str)


def test_watched_terms_are_the_terms_in_the_lexicon(reader, edge_rows):
    texts = [reader.restored(t or "") for _, t in edge_rows]
    rng = random.Random(1)
    every = sorted(set().union(*map(T.terms, texts)))
    wanted = set(rng.sample(every, 2000))
    watch = T.Watch(wanted)
    assert all(watch.terms(t) == T.terms(t) & wanted for t in texts * 2)


def labelled(seed=4, n=600):
    rng = random.Random(seed)
    docs, marks = [], []
    for i in range(n):
        words = [rng.choice(CLEAN) + rng.choice(["", "s", "ed", "ing"]) for _ in range(rng.randint(10, 80))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(INSULTS))
        docs.append((i, " ".join(words)))
        marks.append((i, int(toxic)))
    return docs, marks


def disguised(rng, word):
    kind = rng.randrange(3)
    if kind == 0:
        return "".join({"i": "1", "o": "0", "e": "3", "a": "4", "s": "$"}.get(c, c) for c in word)
    if kind == 1:
        return " ".join(word)
    k = rng.randrange(1, len(word))
    return word[:k] + word[k] * 4 + word[k + 1:]


def test_disguised_toxic_documents_are_caught_and_clean_ones_left(spark, stored_docs):
    docs, marks = labelled()
    rng = random.Random(6)
    new = [(1000 + k, " ".join([rng.choice(CLEAN) for _ in range(30)] + [disguised(rng, rng.choice(INSULTS)) for _ in range(2)] + ["stone"])) for k in range(40)]
    clean = [(2000 + k, " ".join(rng.choice(CLEAN) for _ in range(60)) + " a b c 1st 2nd") for k in range(40)]
    table = stored_docs(docs + new + clean)
    lexicon = T.train(table, spark.createDataFrame(marks, "doc_id long, toxic int"))
    got = {r.doc_id: r.predicted for r in T.score(table, lexicon).collect()}
    assert sum(got[i] for i, _ in new) >= 38
    assert not any(got[i] for i, _ in clean)
    assert all(got[i] == m for i, m in marks)


def test_edges(spark, stored_docs, edge_rows):
    docs, marks = labelled()
    table = stored_docs(edge_rows + [(5000 + i, t) for i, t in docs])
    labels = spark.createDataFrame([(5000 + i, m) for i, m in marks] + [(None, 1), (1, 0), (5000, 0), (8, 7)], "doc_id long, toxic int")
    rows = T.score(table, T.train(table, labels)).collect()
    assert len(rows) == table.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2, 3)}) == 1 and all(not r.predicted for r in rows if r.doc_id in (1, 2, 3))
    none = labels.where("false")
    assert {r.predicted for r in T.score(table, T.train(table, none)).collect()} == {0}
    empty = table.where("false")
    assert T.score(empty, T.train(empty, labels)).collect() == []
