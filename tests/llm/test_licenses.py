import random
import re

from marketlens.llm import licenses

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(text, threshold=0.8):
    words = WORD.findall((text or "").translate(LOW))
    places, labels = [], set()
    for phrase, label in licenses.PHRASES.items():
        p = phrase.split()
        found = [i for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
        places += found
        labels |= {label} if found else set()
    base, best = set(labels), 0.0
    starts = range(0, max(len(words) - licenses.BLOCK // 2 - 1, 0) + 1, licenses.BLOCK // 2)
    for label, template in licenses.TEMPLATES:
        tokens = set(template.split())
        for s in starts:
            share = len(tokens & set(words[s:s + licenses.BLOCK])) / len(tokens)
            if share >= threshold:
                labels.add(label)
                best = max(best, share)
    return (len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(base)), ",".join(sorted(labels)),
            1.0 if places else round(best, 9))


def rows(edge_rows):
    rng = random.Random(1)
    out = list(edge_rows)
    for k in range(60):
        label, template = licenses.TEMPLATES[k % len(licenses.TEMPLATES)]
        words = template.split()
        for _ in range(rng.randint(0, len(words) // 3)):
            words.pop(rng.randrange(len(words)))
        fill = lambda n: [rng.choice("the of public software license version stone river and".split()) for _ in range(n)]
        out.append((500 + k, " ".join(fill(rng.randint(0, 90)) + [w.upper() if rng.random() < 0.2 else w for w in words] + fill(rng.randint(0, 90)))))
    return out + [
        (700, "Under the MIT License; under the mit license. CC-BY-NC"), (701, "xunder the mit license"), (702, "under the mit licenses"),
        (703, "APACHE license,\nversion (2)"), (704, "cc by nc cc by nc cc by cc by nc"), (704, "cc by nc cc by nc cc by cc by nc"), (None, "cc_by nc"),
        (705, "under the mit é license"), (706, "Under the Kit license"), (707, "cc by ncK"), (709, "\u212a under the m\u0130t license"), (710, "-- under the mit license --"), (711, "..."), (708, "this wor\u212a is licensed under the gnu general public license version"),
    ]


def test_equals_brute_force(spark, stored_docs, edge_rows):
    given = rows(edge_rows)
    got = sorted((str(r.doc_id), r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, round(r.score, 9)) for r in licenses.scan(stored_docs(given)).collect())
    expected = sorted((str(i), *brute(t)) for i, t in given)
    key = lambda r: tuple(str(x) for x in r)
    assert sorted(got, key=key) == sorted(expected, key=key)


def test_no_python_in_the_plan(spark, stored_docs, edge_rows):
    plan = licenses.scan(stored_docs(edge_rows))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_empty_table(spark, stored_docs):
    assert licenses.scan(stored_docs([])).count() == 0
