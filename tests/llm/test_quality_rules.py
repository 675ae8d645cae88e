import re

from marketlens.llm import quality_rules

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)} if len(windows) < 3000 else None
    seen, dups = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dups += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dups, None if covered is None else len(covered))


def test_base_counts(spark, stored_docs, edge_rows):
    rows = edge_rows + [(50, "a b c a b c a"), (51, "x x x x"), (52, "é\u2003ü 字 | & <b> #1"), (53, "l\nl\n \n\nl\r\nl"), (54, "v\x0bw\x0cy\x1cz")]
    got = sorted(quality_rules.apply_rules(stored_docs(rows)).collect(), key=str)
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(tuple(r)[1:6])
    for i, t in rows:
        e = base(t)
        assert any(g[:4] == e[:4] and (e[4] is None or g[4] == e[4]) for g in by[i]), (i, e, by[i])
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_line_rules():
    rules = quality_rules.Rules()
    ok = lambda s: quality_rules.line_ok(s.encode(), rules)
    assert ok("A plain sentence stands here.") and ok('He said "yes."') and ok("Is it so?") and ok("好的。")
    assert ok("A sentence ends. The next is cut off in the")
    assert not ok("Home") and not ok("Home | About | Contact.") and not ok("We use cookies on this site.")
    assert not ok("SO!! MANY!! BANGS!! HERE!!") and not ok("a### b$$$ c%%% d&&&.")


def test_verdicts(spark, stored_docs):
    good = "\n".join(" ".join(f"word{k}{chr(97 + j)}" for j in range(10)).capitalize() + "." for k in "one two three four five six seven".split())
    menu = "\n".join(f"Home{k} | News{k} | About{k} | Contact{k} | More{k}" for k in range(20))
    rows = [(1, good), (2, menu), (3, good + "\n" + menu), (4, good + "\nShare"), (5, good.replace(".", "")), (6, "same words " * 60)]
    got = {r.doc_id: r for r in quality_rules.apply_rules(stored_docs(rows), with_text=True).collect()}
    assert {i: r.kept for i, r in got.items()} == {1: True, 2: False, 3: False, 4: True, 5: False, 6: False}
    assert got[4].clean_text == good and got[1].clean_text == good


def test_empty_table(spark, stored_docs):
    assert quality_rules.apply_rules(stored_docs([])).count() == 0
