"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from marketlens.llm import licenses, quality_rules


def quoted(values) -> str:
    return "[" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + "]"


OP2 = r"""
WITH said AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n,
    length('<|im_start|>' || replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '<\n') || chr(10)
           || replace(replace(text, '\', '\\'), '<|', '<\|') || '<|im_end|>' || chr(10)) AS size
  FROM said),
summed AS (SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY i) AS upto, role = 'assistant' OR i = n AS ends FROM placed)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(upto) FILTER (ends))::BIGINT AS formatted_chars, (count(*) FILTER (ends))::BIGINT AS n_examples
FROM summed GROUP BY conv_id
"""


def op5() -> str:
    phrase = "SELECT * FROM (VALUES " + ", ".join(f"('{label}', string_split('{p}', ' '))" for p, label in licenses.PHRASES.items()) + ") p(label, parts)"
    template = "SELECT * FROM (VALUES " + ", ".join(f"('{label}', list_distinct(string_split('{t}', ' ')))" for label, t in licenses.TEMPLATES) + ") t(label, tokens)"
    half = licenses.BLOCK // 2
    return rf"""
WITH phrases AS ({phrase}), templates AS ({template}),
cut AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
places AS (
  SELECT doc_id, label, unnest(list_filter(range(0, greatest(len(words) - len(parts) + 1, 0)), lambda i: words[i + 1:i + len(parts)] = parts)) AS place
  FROM cut, phrases WHERE list_has_all(words, parts)),
base AS (SELECT doc_id, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list_distinct(list(label)) AS labels FROM places GROUP BY doc_id),
parts AS (
  SELECT doc_id, words[s + 1:s + {licenses.BLOCK}] AS words
  FROM (SELECT doc_id, words, unnest(range(0, greatest(len(words) - {half} - 1, 0) + 1, {half})) AS s FROM cut)),
notices AS (
  SELECT doc_id, label, len(list_intersect(words, tokens)) / len(tokens) AS share FROM parts, templates
  WHERE len(list_intersect(words, tokens)) >= ceil(0.8 * len(tokens))),
found AS (SELECT doc_id, list_distinct(list(label)) AS labels, max(share) AS share FROM notices GROUP BY doc_id)
SELECT cut.doc_id, len(words)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
  array_to_string(list_sort(coalesce(base.labels, [])), ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(found.labels, [])))), ',') AS labels,
  CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(share, 0.0) END::DOUBLE AS score
FROM cut LEFT JOIN base USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def op7() -> str:
    rules = quality_rules.Rules()
    closers = quoted(c.decode() for c in quality_rules.CLOSERS)
    inner = quoted(c.decode() for c in quality_rules.INNER_CLOSERS)
    furniture = quoted(c.decode() for c in quality_rules.BOILERPLATE)
    return rf"""
WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
cut AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words FROM texts),
windows AS (
  SELECT doc_id, i, words[i + 1:i + 3] AS w FROM (SELECT doc_id, words, unnest(range(0, greatest(len(words) - 2, 0))) AS i FROM cut)),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, w) AS n FROM windows) WHERE n > 1),
repeats AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, range(0, 3) r(k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM texts),
judged AS (
  SELECT doc_id, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS n, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) > 1 AS dup,
    (list_bool_or([ends_with(regexp_replace(line, '["'')\]}} \t\x0b\x0c\r”’»]+$', ''), c) FOR c IN {closers}])
      OR list_bool_or([contains(line, c) FOR c IN {inner}]))
    AND len(regexp_extract_all(line, '[#*$%&|<>]')) <= {rules.max_symbols} * strlen(line)
    AND NOT (len(regexp_extract_all(line, '\||»|›| > ')) >= {rules.nav_separators}
             AND len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) <= (len(regexp_extract_all(line, '\||»|›| > ')) + 1) * {rules.nav_words + 1})
    AND len(regexp_extract_all(line, '!!')) <= {rules.max_bangs} * len(regexp_extract_all(line, '[^\x20\x09-\x0D]+'))
    AND NOT list_bool_or([contains(lower(line), c) FOR c IN {furniture}]) AS ok
  FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
left_over AS (
  SELECT doc_id, count(*) FILTER (dup) AS n_dup_lines, count(*) FILTER (dup OR NOT ok) AS n_removed_lines, sum(n) FILTER (dup OR NOT ok) AS lost
  FROM judged GROUP BY doc_id),
counted AS (
  SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(list_sum([length(w) FOR w IN words]), 0)::BIGINT AS word_chars,
    len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(string_split(text, chr(10)))::BIGINT AS n_lines,
    coalesce(n_removed_lines, 0)::BIGINT AS n_removed_lines, (len(words) - coalesce(lost, 0))::BIGINT AS left_words
  FROM cut LEFT JOIN repeats USING (doc_id) LEFT JOIN left_over USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND left_words >= {rules.min_left} * n_words AS kept, n_lines, n_removed_lines, left_words
FROM counted
"""


def op11(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Every round meets all entries; no bounds."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS x FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(embedding) > 0),
cells AS MATERIALIZED (
  SELECT r, (i // (n // {parts}))::INT AS p, (i % (n // {parts}))::INT AS i, v
  FROM (SELECT r, len(x) AS n, unnest(x) AS v, unnest(range(len(x))) AS i FROM kept)),
books0 AS MATERIALIZED (
  SELECT p, j, i, v FROM cells JOIN (SELECT r, (row_number() OVER (ORDER BY vec_id NULLS LAST, x) - 1)::INT AS j FROM kept) USING (r) WHERE j < {entries})"""]
    for n in range(rounds + 1):
        steps.append(f"""met{n} AS (SELECT c.r, c.p, b.j, sum((c.v - b.v) * (c.v - b.v)) AS d FROM cells c JOIN books{n} b USING (p, i) GROUP BY ALL),
near{n} AS MATERIALIZED (SELECT r, p, min(d) AS d, arg_min(j, d * {entries} + j) AS j FROM met{n} GROUP BY r, p)""")
        if n < rounds:
            steps.append(f"""sums{n} AS (SELECT n.p, n.j, c.i, sum(c.v) AS s, count(*) AS n FROM near{n} n JOIN cells c USING (r, p) GROUP BY ALL),
books{n + 1} AS MATERIALIZED (
  SELECT b.p, b.j, b.i, CASE WHEN n IS NULL THEN b.v ELSE ((s - ((s % n) + n) % n) // n)::BIGINT END AS v FROM books{n} b LEFT JOIN sums{n} USING (p, j, i))""")
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY p, j, i)) FROM books{rounds}) AS codebooks_sha256
FROM kept JOIN (SELECT r, string_agg(format('{{:02x}}', j), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM near{rounds} GROUP BY r) USING (r)
"""


def op13() -> str:
    """A backward walk over each conversation; costs and least audits of the four states (nothing, system, user, assistant) are carried."""
    blank = r"[^\x20\x09-\x0D]"
    crc = """list_reduce(list_prepend(4294967295, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)), lambda x, _: xor(x >> 1, 3988292384 * (x & 1))))"""
    state = lambda k: f"b[{k}]"  # noqa: E731

    def least(k: int) -> str:
        """The best way on from state k over the row: delete, keep or relabel."""
        after = {1: 3, 2: 3, 3: 4, 4: 3}[k]
        kept = {1: [("s", 2), ("u", 3)], 2: [("u", 3)], 3: [("a", 4)], 4: [("u", 3)]}[k]
        ways = [f"{{'c': {state(k)}.c + 2, 'p': 'D' || {state(k)}.p, 'h': {state(k)}.h}}"]
        line = lambda role: f"[{role} || ':' || r.text]"  # noqa: E731
        put = "'assistant'" if after == 4 else "'user'"
        ways.append(f"CASE WHEN r.fault IN ('', 'truncated') THEN {{'c': {state(after)}.c + 1 + r.extra, 'p': 'R' || {state(after)}.p, 'h': list_concat({line(put)}, {state(after)}.h)}} END")
        ways += [f"CASE WHEN r.fault IN ('', 'truncated') AND r.role[1] = '{c}' THEN {{'c': {state(to)}.c + r.extra, 'p': 'K' || {state(to)}.p, 'h': list_concat({line('r.role')}, {state(to)}.h)}} END" for c, to in kept]
        return f"list_min([{', '.join(ways)}])"

    put = lambda to, of: f"{{'c': {of}.c + 5, 'p': 'I' || {of}.p, 'h': list_concat(['{to}:'], {of}.h)}}"  # noqa: E731
    inserted = f"""[list_min([t[1], {put('user', 'u')}]), list_min([t[2], {put('user', 'u')}]), u, list_min([t[4], {put('user', 't[3]')}])]"""
    first = lambda c, p, h: f"{{'c': {c}, 'p': '{p}', 'h': {h}}}"  # noqa: E731
    whole = f"[{first(0, '', '[]::VARCHAR[]')}, {first(10, 'II', ['user:', 'assistant:'])}, {first(5, 'I', ['assistant:'])}, {first(0, '', '[]::VARCHAR[]')}]"
    return rf"""
WITH RECURSIVE told AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor({crc}, 4294967295) % 20 AS k FROM conversations),
damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN k = 1 THEN '' WHEN k = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
  FROM told WHERE k != 0),
ordered AS (
  SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i, count(*) OVER (PARTITION BY conv_id) AS n FROM damaged),
judged AS MATERIALIZED (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '{blank}') THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN regexp_extract(text, '({blank})[ 	-]*$', 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS extra FROM ordered),
walk AS (
  SELECT conv_id, n AS i, {whole} AS b FROM (SELECT DISTINCT conv_id, n FROM ordered)
  UNION ALL
  SELECT conv_id, i, {inserted} AS b FROM (
    SELECT conv_id, i, t, list_min([t[3], {put('assistant', 't[4]')}]) AS u FROM (
      SELECT w.conv_id, w.i - 1 AS i, CASE WHEN r.fault IN ('blank', 'duplicate') THEN list_transform(b, lambda x: {{'c': x.c + 2, 'p': 'D' || x.p, 'h': x.h}})
        ELSE [{', '.join(least(k) for k in (1, 2, 3, 4))}] END AS t
      FROM walk w JOIN judged r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.i = w.i))),
counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (i > 1 AND before[1] || role[1] NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT e.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b[1].c, 0)::BIGINT AS cost, coalesce(b[1].p, '') AS audit, sha256(coalesce(array_to_string(b[1].h, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id
LEFT JOIN (SELECT conv_id, b FROM walk WHERE i = 0) w ON w.conv_id IS NOT DISTINCT FROM e.conv_id
"""


def llm_oracle_sql() -> dict[str, str]:
    return {"op2_chat_format": OP2, "op5_license_scan": op5(), "op7_quality_rules": op7(), "op11_vector_codes": op11(), "op13_conversation_repair": op13()}
