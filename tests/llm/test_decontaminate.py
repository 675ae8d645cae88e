import random

from marketlens.llm import decontaminate as D


def plain(item, text):
    """Smallest edit distance of the item to any run of the text."""
    row = [0] * (len(text) + 1)
    for i, x in enumerate(item):
        new = [i + 1]
        for j, y in enumerate(text):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[j] + 1))
        row = new
    return min(row)


def words(t):
    return (t or "").encode().translate(D.WORDS).split()


def test_search_distance_equals_the_table():
    rng = random.Random(1)
    for _ in range(3000):
        a = [rng.randrange(4) for _ in range(rng.randint(1, 9))]
        b = [rng.randrange(4) for _ in range(rng.randint(0, 20))]
        assert D.closest(a, b) == plain(a, b)


VOCABULARY = [f"{a}{b}" for a in "ba ke lo mi nu pra sti tor".split() for b in "da fe gi ho ju kan lem mot ris val wex zur".split()]


def item(rng, n):
    return [rng.choice(VOCABULARY) for _ in range(n)]


def planted(rng, items, edits, per_item=6):
    rows, truth = [], {}
    for k, x in enumerate(items):
        for _ in range(per_item):
            y = list(x)
            for _ in range(int(edits * len(x))):
                p = rng.randrange(len(y))
                y[p:p + rng.randint(0, 1)] = [rng.choice(VOCABULARY)] * rng.randint(0, 1)
            i = len(rows)
            text = " ".join(item(rng, rng.randint(0, 150))) + ".\n" + " ".join(y).upper() + "! " + ", ".join(item(rng, rng.randint(0, 150)))
            rows.append((i, text))
            truth[i] = k
    return rows, truth


def found(spark, stored_docs, rows, items):
    bench = spark.createDataFrame([(k, " ".join(x), 1, "x") for k, x in enumerate(items)], "item_id long, text string, key long, words string")
    return {r.doc_id: set(r.item_ids) for r in D.decontaminate(stored_docs(rows), bench).collect()}


def test_every_exact_passage_is_found_and_clean_texts_are_left(spark, stored_docs):
    rng = random.Random(3)
    items = [item(rng, n) for n in (5, 6, 9, 14, 20, 33, 59, 120, 400)]
    rows, truth = planted(rng, items, 0)
    clean = [(1000 + k, " ".join(item(rng, 300))) for k in range(20)]
    got = found(spark, stored_docs, rows + clean, items)
    assert all(k in got[i] for i, k in truth.items())
    for i, t in rows + clean:
        for k, x in enumerate(items):
            assert k not in got[i] or plain([w.encode() for w in x], words(t)) <= int(0.2 * len(x) + 1e-9)
    assert not any(got[i] for i, _ in clean)


def test_recall_with_edits(spark, stored_docs):
    rng = random.Random(4)
    items = [item(rng, n) for n in (20, 26, 33, 41, 59)]
    rows, _ = planted(rng, items, 0.1, per_item=40)
    true = {(i, k) for i, t in rows for k, x in enumerate(items) if plain([w.encode() for w in x], words(t)) <= int(0.2 * len(x) + 1e-9)}
    got = found(spark, stored_docs, rows, items)
    pairs = {(i, k) for i, ks in got.items() for k in ks}
    assert pairs <= true
    recall = len(pairs & true) / len(true)
    print("recall", recall)
    assert len(true) >= 190 and recall >= 0.9


def test_edges(spark, stored_docs, edge_rows):
    bench = spark.createDataFrame([(1, "the stones rivering cloud"), (2, None), (None, " ".join(words_ for words_ in "stone river cloud maple silver harbor".split())), (3, ""),
                                   (4, edge_rows[8][1]), (4, edge_rows[8][1]), (5, edge_rows[8][1])], "item_id long, text string")
    got = D.decontaminate(stored_docs(edge_rows), bench).collect()
    assert len(got) == len(edge_rows)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(list(r.item_ids))
    assert by[7] == by[8] == [[4, 5]] and all(x == [4, 5] for x in by[9]) and by[13] == [[4, 5]] and by[1] == [[]] and sorted(by[None]) == [[], [4, 5]]
    none = spark.createDataFrame([], "item_id long, text string")
    assert not any(r.contaminated for r in D.decontaminate(stored_docs(edge_rows), none).collect())
    assert D.decontaminate(stored_docs([]), bench).count() == 0


def test_long_items_at_the_edit_limit_are_all_found(spark, stored_docs):
    rng = random.Random(6)
    items = [item(rng, n) for n in (20, 50, 80, 150, 250, 400)]
    for edits in (0.15, 0.2):
        rows, truth = planted(rng, items, edits, per_item=10)
        got = found(spark, stored_docs, rows, items)
        for k, x in enumerate(items):
            of = [i for i, own in truth.items() if own == k]
            print("words", len(x), "edits", edits, "recall", sum(k in got[i] for i in of) / len(of))
        assert all(k in got[i] for i, k in truth.items())
        for i, t in rows:
            assert all(plain([w.encode() for w in items[k]], words(t)) <= int(0.2 * len(items[k]) + 1e-9) for k in got[i] if len(items[k]) <= 80)
