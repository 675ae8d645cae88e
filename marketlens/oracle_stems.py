"""The English (Porter2) stemmer restated as SQL over a table of distinct words.

One step is one relation; suffixes and word lists are fixed values of the
published algorithm, held here apart from the engine's.
"""

from __future__ import annotations

STOP = """i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her hers herself it its itself they
them their theirs themselves what which who whom this that these those am is are was were be been being have has had having do does did doing
a an the and but if or because as until while of at by for with about against between into through during before after above below to from up
down in out on off over under again further then once here there when where why how all any both each few more most other some such no nor not
only own same so than too very s t can will just don should now""".split()
ODD = {"skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "idly": "idl", "gently": "gentl", "ugly": "ugli",
       "early": "earli", "only": "onli", "singly": "singl", "sky": "sky", "news": "news", "howe": "howe", "atlas": "atlas", "cosmos": "cosmos",
       "bias": "bias", "andes": "andes"}
STAY = ["inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed"]
SECOND = {"ization": "ize", "ational": "ate", "fulness": "ful", "ousness": "ous", "iveness": "ive", "tional": "tion", "biliti": "ble", "lessli": "less",
          "entli": "ent", "ation": "ate", "alism": "al", "aliti": "al", "ousli": "ous", "iviti": "ive", "fulli": "ful", "enci": "ence", "anci": "ance",
          "abli": "able", "izer": "ize", "ator": "ate", "alli": "al", "bli": "ble"}
THIRD = {"ational": "ate", "tional": "tion", "alize": "al", "icate": "ic", "iciti": "ic", "ical": "ic", "ness": "", "ful": ""}
FOURTH = ["ement", "ance", "ence", "able", "ible", "ment", "ant", "ent", "ism", "ate", "iti", "ous", "ive", "ize", "al", "er", "ic"]

SHORT_END = "regexp_matches({x}, '(^[aeiouy][^aeiouy]$)|([^aeiouy][aeiouy][^aeiouywxY]$)')"


def cases(word: str, table: dict[str, str], least: str, more: str = "") -> str:
    """The longest suffix decides; it is replaced if it stands in its region, else the word stays."""
    rows = [f"WHEN {word} LIKE '%{s}' THEN CASE WHEN length({word}) - {len(s)} >= {least} THEN left({word}, length({word}) - {len(s)}) || '{to}' ELSE {word} END"
            for s, to in sorted(table.items(), key=lambda x: -len(x[0]))]
    return f"CASE {more}{' '.join(rows)} ELSE {word} END"


def stemming(words: str) -> str:
    """CTEs that end in ``stemmed(word, stem)`` for the words of a query, without stop words."""
    listed = lambda v: ", ".join(f"'{x}'" for x in v)
    odd = ", ".join(f"('{w}', '{x}')" for w, x in ODD.items())
    cut = lambda n: f"left(b, length(b) - {n})"
    second = cases("c", SECOND, "r1", "WHEN c LIKE '%ogi' THEN CASE WHEN c LIKE '%logi' AND length(c) - 3 >= r1 THEN left(c, length(c) - 1) ELSE c END ")
    plain_li = "regexp_matches(c, '(" + "|".join(k for k in SECOND if k.endswith("li")) + ")$')"
    third = cases("d", THIRD, "r1", "WHEN d LIKE '%ative' THEN CASE WHEN length(d) - 5 >= r2 THEN left(d, length(d) - 5) ELSE d END ")
    fourth = cases("e", {s: "" for s in FOURTH}, "r2", "WHEN regexp_matches(e, 'ion$') THEN CASE WHEN regexp_matches(e, '[st]ion$') AND length(e) - 3 >= r2 THEN left(e, length(e) - 3) ELSE e END ")
    return rf"""stem_word AS (SELECT word FROM ({words}) WHERE word NOT IN ({listed(STOP)})),
stem_own AS (SELECT * FROM (VALUES {odd}) own(word, stem)),
stem_0 AS (
  SELECT word, regexp_replace(regexp_replace(word, '^y', 'Y'), '([aeiouy])y', '\1Y', 'g') AS w FROM stem_word
  WHERE length(word) > 2 AND word NOT IN (SELECT word FROM stem_own)),
stem_r AS (
  SELECT word, w, length(w) - length(CASE WHEN regexp_matches(w, '^(gener|commun|arsen)') THEN regexp_extract(w, '^(gener|commun|arsen)(.*)$', 2)
                                          ELSE regexp_extract(w, '[aeiouy][^aeiouy](.*)$', 1) END) AS r1 FROM stem_0),
stem_rr AS (SELECT *, length(w) - length(regexp_extract(substr(w, r1 + 1), '[aeiouy][^aeiouy](.*)$', 1)) AS r2 FROM stem_r),
stem_a AS (
  SELECT *, CASE WHEN w LIKE '%sses' THEN left(w, length(w) - 2)
    WHEN w LIKE '%ied' OR w LIKE '%ies' THEN left(w, length(w) - CASE WHEN length(w) > 4 THEN 2 ELSE 1 END)
    WHEN w LIKE '%us' OR w LIKE '%ss' THEN w WHEN regexp_matches(w, '[aeiouy].+s$') THEN left(w, length(w) - 1) ELSE w END AS a FROM stem_rr),
stem_b0 AS (
  SELECT *, a IN ({listed(STAY)}) AS stays, regexp_extract(a, '(eedly|ingly|edly|eed|ing|ed)$') AS ending FROM stem_a),
stem_b1 AS (
  SELECT *, left(a, length(a) - length(ending)) AS b FROM stem_b0),
stem_b AS (
  SELECT word, r1, r2, stays, a, CASE WHEN stays OR ending = '' THEN a
    WHEN ending LIKE 'eed%' THEN CASE WHEN length(b) >= r1 THEN b || 'ee' ELSE a END
    WHEN NOT regexp_matches(b, '[aeiouy]') THEN a WHEN regexp_matches(b, '(at|bl|iz)$') THEN b || 'e'
    WHEN regexp_matches(b, '(bb|dd|ff|gg|mm|nn|pp|rr|tt)$') THEN {cut(1)} WHEN {SHORT_END.format(x='b')} AND r1 >= length(b) THEN b || 'e' ELSE b END AS b
  FROM stem_b1),
stem_c AS (SELECT *, CASE WHEN regexp_matches(b, '.[^aeiouy][yY]$') THEN {cut(1)} || 'i' ELSE b END AS c FROM stem_b),
stem_d AS (
  SELECT *, CASE WHEN c LIKE '%li' AND NOT {plain_li}
      THEN CASE WHEN length(c) - 2 >= r1 AND regexp_matches(c, '[cdeghkmnrt]li$') THEN left(c, length(c) - 2) ELSE c END ELSE {second} END AS d FROM stem_c),
stem_e AS (SELECT *, {third} AS e FROM stem_d),
stem_f AS (SELECT *, {fourth} AS f FROM stem_e),
stem_g AS (
  SELECT *, CASE WHEN f LIKE '%e' AND (length(f) - 1 >= r2 OR length(f) - 1 >= r1 AND NOT {SHORT_END.format(x="left(f, length(f) - 1)")}) THEN left(f, length(f) - 1)
    WHEN f LIKE '%ll' AND length(f) - 1 >= r2 THEN left(f, length(f) - 1) ELSE f END AS g FROM stem_f),
stemmed AS (
  SELECT word, replace(CASE WHEN stays THEN a ELSE g END, 'Y', 'y') AS stem FROM stem_g
  UNION ALL SELECT word, word FROM stem_word WHERE length(word) <= 2 AND word NOT IN (SELECT word FROM stem_own)
  UNION ALL SELECT word, stem FROM stem_own JOIN stem_word USING (word))"""
