"""DuckDB SQL for the queries that SQL can express, by the plain way: all windows, all pairs that share something, all variants."""

from __future__ import annotations

import string

from foliate.llm import line_dedup, near_dedup, repeats, rules

#: Words of a text.
_WORDS = "regexp_extract_all({0}, '[^ \\t-\\r]+')"
_BLANK = "[ \\t-\\r]*"


def _rules() -> str:
    bits = " + ".join(f"CASE WHEN {rule} THEN {rules.BIT[name]} ELSE 0 END" for name, rule in rules.RULES)
    mask, own = rules.mask(rules.CURRENT), rules.POLICIES[rules.CURRENT]
    sole = " ".join(f"WHEN b = {rules.BIT[r]} THEN '{r}'" for r in own)
    bit = " ".join(f"WHEN b = {rules.BIT[r]} THEN count(*) FILTER (WHERE (b & {rules.BIT[r]}) > 0) OVER ()" for r in own)
    alone = " ".join(f"WHEN b = {rules.BIT[r]} THEN count(*) FILTER (WHERE b = {rules.BIT[r]}) OVER ()" for r in own)
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS.format('t')} AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \\t-\\r]')) AS lines FROM d),
g AS (SELECT r, unnest(range(1, len(ws) - 1)) AS i,
  unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) AS gram FROM w WHERE len(ws) >= 3),
c AS (SELECT r, count(DISTINCT i + o) AS n FROM (SELECT *, count(*) OVER (PARTITION BY r, gram) AS k FROM g) AS g1, (VALUES (0), (1), (2)) AS s(o)
  WHERE k > 1 GROUP BY r),
m AS (
  SELECT doc_id, len(ws) AS n_words, CAST(coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words, len(lines) AS n_lines,
      len(list_filter(ws, lambda x: regexp_matches(x, '\\pL'))) AS n_alpha_words,
    length(regexp_replace(t, '[^\\pL]', '', 'g')) AS n_letters, length(regexp_replace(t, '[^\\p{{Lu}}]', '', 'g')) AS n_upper,
      length(regexp_replace(t, '[^!]', '', 'g')) AS n_shouts,
    len(list_filter(lines, lambda x: regexp_matches(x, '(\\.\\.\\.|…){_BLANK}$'))) AS n_ellipsis_lines,
      len(list_filter(lines, lambda x: regexp_matches(x, '^{_BLANK}[-*•]'))) AS n_bullet_lines
  FROM w LEFT JOIN c USING (r)),
f AS (SELECT *, {bits} AS fail_bits FROM m),
j AS (SELECT *, fail_bits & {mask} AS b, (fail_bits & {rules.mask('base')}) <> 0 AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND b = 0 AS kept, CAST(fail_bits AS BIGINT) AS fail_bits,
  CASE {sole} END AS sole_rule, CASE {alone} ELSE 0 END AS sole_rule_docs, CASE {bit} ELSE 0 END AS rule_docs FROM j"""


def _near() -> str:
    k, share = near_dedup.SHINGLE, near_dedup.SHARE
    lower = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(lower)} AS ws FROM documents),
s AS MATERIALIZED (
  SELECT DISTINCT doc_id, md5(g) AS g FROM (
    SELECT doc_id,
      unnest(CASE WHEN len(ws) >= {k} THEN list_transform(range(1, len(ws) - {k - 2}), lambda i: array_to_string(ws[i:i + {k - 1}], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] END) AS g
      FROM w) AS e),
n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * p.k >= {share} * (x.n + y.n - p.k)),
reach AS (SELECT doc_id AS node, doc_id AS root FROM documents UNION SELECT l.b, reach.root FROM reach JOIN l ON l.a = reach.node WHERE l.b > reach.root),
c AS (SELECT node, min(root) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept FROM documents d LEFT JOIN n USING (doc_id) JOIN c ON c.node = d.doc_id"""


def _repeats() -> str:
    k = repeats.WINDOW
    return f"""
WITH w AS MATERIALIZED (SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS ws FROM documents),
v AS MATERIALIZED (
  SELECT doc_id, unnest(range(1, len(ws) - {k - 2})) AS i,
    unnest(list_transform(range(1, len(ws) - {k - 2}), lambda i: md5(array_to_string(ws[i:i + {k - 1}], ' ')))) AS g FROM w WHERE len(ws) >= {k}),
f AS (SELECT g, min(doc_id) AS first FROM v GROUP BY 1),
gone AS (SELECT DISTINCT v.doc_id, v.i + o AS i FROM v JOIN f USING (g), range(0, {k}) AS s(o) WHERE f.first < v.doc_id),
word AS (SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY 1)
SELECT w.doc_id, len(ws) AS n_words, len(ws) - coalesce(kept.n, 0) AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256 FROM w LEFT JOIN kept USING (doc_id)"""


def _lines() -> str:
    k = line_dedup.NEAR_WORDS
    return f"""
WITH l AS MATERIALIZED (
  SELECT doc_id, i, raw, {_WORDS.format('raw')} AS ws
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS raw, unnest(range(0, len(string_split(text, chr(10))))) AS i FROM documents) AS e),
y AS MATERIALIZED (SELECT doc_id, i, ws, array_to_string(ws, ' ') AS line FROM l WHERE len(ws) > 0),
f AS MATERIALIZED (SELECT line, len(any_value(ws)) AS n, any_value(ws) AS ws, min((doc_id, i)) AS place FROM y GROUP BY 1),
v AS MATERIALIZED (
  SELECT line, place, unnest(range(1, n + 1)) AS spot,
    unnest(list_transform(range(1, n + 1), lambda j: array_to_string(list_concat(ws[1:j - 1], ws[j + 1:]), ' '))) AS less FROM f WHERE n >= {k}),
changed AS (SELECT line FROM (SELECT line, place, min(place) OVER (PARTITION BY less, spot) AS earliest FROM v) AS g WHERE earliest < place),
grown AS (SELECT CASE WHEN v.place > f.place THEN v.line ELSE f.line END AS line FROM v JOIN f ON f.line = v.less AND f.n >= {k - 1}),
near AS (SELECT DISTINCT line FROM (SELECT line FROM changed UNION ALL SELECT line FROM grown) AS u),
gone AS (SELECT y.doc_id, y.i FROM y JOIN f USING (line) WHERE (y.doc_id, y.i) > f.place OR line IN (SELECT line FROM near)),
kept AS (SELECT doc_id, string_agg(raw, chr(10) ORDER BY i) AS t, count(*) AS n FROM l ANTI JOIN gone USING (doc_id, i) GROUP BY 1),
c AS (SELECT doc_id, count(*) AS n FROM l GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(c.n, 0) AS INT) AS n_lines, CAST(coalesce(c.n, 0) - coalesce(kept.n, 0) AS INT) AS n_removed, CASE
  WHEN d.text IS NOT NULL THEN coalesce(kept.t, '') END AS text
FROM documents d LEFT JOIN c USING (doc_id) LEFT JOIN kept USING (doc_id)"""


ORACLES = {"op2_rules": _rules(), "op4_near_dedup": _near(), "op6_repeats": _repeats(), "op10_line_dedup": _lines()}
