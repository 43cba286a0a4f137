"""Pieces of DuckDB SQL for the queries' checks: ids, captions, references, headings, distances. They hold for any text, not for certain ones."""

from __future__ import annotations

from foliate.functions.text import CAPTION_TYPES, SECTION_KEYWORDS

PAIR = "FROM el a JOIN el b ON a.doc_id = b.doc_id AND a.page_num = b.page_num"
DIST = "sqrt(pow((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2, 2) + pow((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2, 2))"
VISUAL = "('table', 'image', 'chart', 'graph', 'formula')"
TEXT = "('text_block', 'list_block')"


def near(limit: float, where: str = "true", kinds_a: str = "true", kinds_b: str = "true") -> str:
    """Rows a.*, b.*, dist of pairs of a page at most limit apart, by cells as wide as the limit."""
    x, y = "floor((x0 + x1) / 2 / {0})".format(limit), "floor((y0 + y1) / 2 / {0})".format(limit)
    return f"""(SELECT a, b, dist FROM (
        SELECT a, b, sqrt(pow((a.x0 + a.x1) / 2 - (b.x0 + b.x1) / 2, 2) + pow((a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2, 2)) AS dist
        FROM (SELECT el AS a, doc_id, page_num, {x} AS cx, {y} AS cy FROM el WHERE {kinds_a}) AS p
       
          JOIN (SELECT el AS b, doc_id, page_num, {x} + dx AS cx, {y} + dy AS cy FROM el, (VALUES (-1), (0), (1)) AS i(dx), (VALUES (-1), (0), (1)) AS j(dy) WHERE {kinds_b}) AS q
        USING (doc_id, page_num, cx, cy)) AS pairs
      WHERE dist <= {limit} AND {where})"""


def uuid(namespace: str, name: str) -> str:
    """The version 5 UUID of a name."""
    return f"""list_transform([sha1(from_hex('{namespace.replace('-', '')}') || CAST({name} AS BLOB))],
      lambda h: substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
        || translate(substr(h, 17, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr(h, 18, 3) || '-' || substr(h, 21, 12))[1]"""


def strip(c: str) -> str:
    return f"regexp_replace({c}, '^\\s+|\\s+$', '', 'g')"


def plain(c: str) -> str:
    return f"translate({c}, '–—‒―  ', '----  ')"


def _part(x: str) -> str:
    return f"""(regexp_matches({x}, '^[0-9]+(\\.[0-9]+)*\\pL?$|^[0-9]+\\pL\\.\\pL$|^\\pL$')
      OR ({x} <> '' AND regexp_matches(upper({x}), '^(XC|XL|L?X{{0,3}})(IX|IV|V?I{{0,3}})$')))"""


def label(kind: str, token: str) -> str:
    """The label of a visual type's word and the token after it; null if the token is no number."""
    words: dict[str, set] = {}
    for w, name in CAPTION_TYPES.items():
        words.setdefault(name, set()).add(w.rstrip("."))
    names = " ".join(f"WHEN lower({kind}) IN ({', '.join(repr(w) for w in sorted(ws))}) THEN '{n}'" for n, ws in words.items())
    first, second = f"split_part({token}, '-', 1)", f"split_part({token}, '-', 2)"
    levels = f"regexp_extract({token}, '^[0-9]+(\\.[0-9]+)*')"
    return f"""CASE WHEN {_part(first)} THEN CASE {names} END || ' ' || {first} || CASE WHEN {_part(second)} THEN '-' || {second} ELSE '' END
      WHEN {levels} <> '' THEN CASE {names} END || ' ' || {levels} END"""


_KINDS = "|".join(sorted({t.rstrip(".") for t in CAPTION_TYPES}, key=lambda t: (-len(t), t)))
_TOKEN = r"([\pL\pN]+(?:[.\-][\pL\pN]+)*)"


def caption_label(c: str) -> str:
    found = f"regexp_extract({strip(plain(c))}, '(?i)^({_KINDS})\\s*\\.?\\s*{_TOKEN}', ['kind', 'token'])"
    return f"list_transform([{found}], lambda f: CASE WHEN f.kind <> '' THEN {label('f.kind', 'f.token')} END)[1]"


def caption_references(c: str) -> str:
    """The labels that a text mentions, each once, in order."""
    pattern = f"(?i)\\b({_KINDS})(?:\\s+\\.?|\\.)\\s*{_TOKEN}"
    both = f"list_zip(regexp_extract_all({plain(c)}, '{pattern}', 1), regexp_extract_all({plain(c)}, '{pattern}', 2))"
    labels = f"list_filter(list_transform({both}, lambda x: {label('x[1]', 'x[2]')}), lambda x: x IS NOT NULL)"
    return f"list_transform([{labels}], lambda l: list_filter(l, lambda x, i: list_position(l, x) = i))[1]"


REFERRING = {
    "table": r"(?i)(?:table|tbl)\.?\s*([0-9]+(?:\.[0-9]+)?)",
    "figure": r"(?i)(?:figure|fig)\.?\s*([0-9]+(?:\.[0-9]+)?[a-z]?)",
    "equation": r"(?i)(?:equation|eq|eqn)\.?\s*([0-9]+(?:\.[0-9]+)?)",
}


def element_labels(c: str) -> str:
    """Labels such as table:3 of all references in a text."""
    parts = [f"list_transform(regexp_extract_all({c}, '{p}', 1), lambda n: '{k}:' || lower(n))" for k, p in REFERRING.items()]
    return f"list_concat({', '.join(parts)})"


#: lab(doc_id, t, label) of visual elements, src(doc_id, s, label) of what texts and captions mention.
LABELS = f"""lab AS (
  SELECT DISTINCT doc_id, t, label FROM (
    SELECT doc_id, element_id AS t, unnest({element_labels('content')}) AS label FROM el WHERE element_type IN {VISUAL}
    UNION ALL SELECT doc_id, element_id, CASE WHEN element_type = 'formula' THEN 'equation' WHEN element_type = 'table' THEN 'table' ELSE 'figure' END || ':' || n
   
      FROM (SELECT *, coalesce({', '.join(f"nullif(regexp_extract(content, '{p}', 1), '')" for p in REFERRING.values())}) AS n FROM el WHERE element_type IN {VISUAL}) AS own
      WHERE n IS NOT NULL) AS found),
src AS (SELECT doc_id, element_id AS s, unnest({element_labels('content')}) AS label FROM el WHERE element_type IN ('text_block', 'list_block', 'caption'))"""


def mentions(c: str, nouns: str, leads: str | None) -> str:
    """Whether a text has a noun with a number, or one of the leads and a noun."""
    t = f"regexp_replace(lower({c}), '\\s+', ' ', 'g')"
    return f"(regexp_matches({t}, '\\b(?:{nouns})\\.?\\s?[0-9]') OR regexp_matches({t}, '\\b(?:{leads}) (?:{nouns})\\b'))"


MENTIONS_TABLE = mentions("b.content", "table", "see|as shown in|refer to|from|the following")
MENTIONS_FORMULA = mentions("b.content", "equation|formula|eq|eqn", "see|as shown in|refer to|from|in|following")
MENTIONS_VISUAL = "regexp_matches(lower(b.content), '\\b(figure|chart|graph|diagram|illustration|image|plot|screenshot)\\b|\\bfig\\.\\w')"

#: num(el.*, level, number, title): numbered headings among all texts (level null: none), by the first word and what follows it.
NUMBERED = f"""num AS (
  SELECT * EXCLUDE (t, w, rest, sec, cha, app, lev),
    CASE WHEN sec <> '' THEN len(string_split(sec, '.')) WHEN cha <> '' OR app <> '' THEN 1
         WHEN regexp_matches(w, '^[A-Z]\\.[0-9]+$') AND rest <> '' THEN 2 WHEN lev <> '' THEN len(string_split(lev, '.')) END AS level,
    CASE WHEN sec <> '' THEN sec WHEN cha <> '' THEN cha WHEN app <> '' THEN app
         WHEN regexp_matches(w, '^[A-Z]\\.[0-9]+$') AND rest <> '' THEN w WHEN lev <> '' THEN lev END AS number,
    CASE WHEN sec <> '' OR cha <> '' THEN coalesce(nullif(regexp_replace(substr(rest, len(sec || cha) + 1), '^\\s*[:.]?\\s*', ''), ''), t)
         WHEN app <> '' THEN coalesce(nullif(regexp_replace(substr(rest, 2), '^\\s*[:.]?\\s*', ''), ''), 'Appendix ' || app)
         WHEN rest <> '' THEN rest WHEN lev <> '' THEN t END AS title,
    lower(rtrim(lower(t), '.:;!? ')) IN ({', '.join(repr(k) for k in SECTION_KEYWORDS)}) AS keyword,
    (t = '' OR regexp_matches(t, '^[0-9]+(\\s*[-–]\\s*[0-9]+)?$') OR regexp_matches(lower(t), '^page\\s+[0-9]')) AS page_number, t AS stripped
  FROM (
    SELECT *, CASE WHEN lower(w) = 'section' THEN regexp_extract(rest, '^[0-9]+(\\.[0-9]+)*') ELSE '' END AS sec, CASE
      WHEN lower(w) = 'chapter' THEN regexp_extract(rest, '^[0-9]+') ELSE '' END AS cha,
      CASE WHEN lower(w) = 'appendix' THEN regexp_extract(rest, '^(\\pL)([^\\pL\\pN]|$)', 1) ELSE '' END AS app, regexp_extract(w, '^([0-9]+(\\.[0-9]+)*)\\.?$', 1) AS lev
    FROM (SELECT *, regexp_extract(t, '^\\S+') AS w, {strip("regexp_replace(t, '^\\S+', '')")} AS rest FROM (SELECT *, {strip("coalesce(content, '')")} AS t FROM el) AS a) AS b) AS c)"""

#: sec(doc_id, element_id, ord, level, number, title, path, parent ord): the fold over each document's headings, one heading a step.
SECTIONS = NUMBERED + """, heads AS (
  SELECT doc_id, element_id, row_number() OVER (PARTITION BY doc_id ORDER BY page_num, reading_order, y0, x0, element_id) - 1 AS ord,
    CASE WHEN element_type = 'section_header' THEN greatest(1, coalesce(level, 1)) ELSE coalesce(level, 1) END AS level, number,
    CASE WHEN element_type = 'section_header' THEN coalesce(content, '') ELSE coalesce(title, stripped) END AS title
  FROM num WHERE element_type = 'section_header' OR element_type = 'text_block' AND NOT page_number AND (level IS NOT NULL OR keyword)),
tree AS (SELECT h.*, (SELECT max(p.ord) FROM heads p WHERE p.doc_id = h.doc_id AND p.ord < h.ord AND p.level < h.level) AS parent FROM heads h),
fold AS (
  SELECT doc_id, CAST(-1 AS BIGINT) AS ord, CAST([] AS VARCHAR[]) AS paths, CAST([] AS STRUCT(a VARCHAR, n BIGINT)[]) AS taken,
    CAST(NULL AS VARCHAR) AS path FROM (SELECT DISTINCT doc_id FROM heads) AS d
  UNION ALL
  SELECT doc_id, ord, list_append(paths, path), CASE WHEN above <> '' OR number IS NULL THEN list_append(taken, {'a': above, 'n': n}) ELSE taken END, path
  FROM (
    SELECT *, CASE WHEN number IS NOT NULL THEN number ELSE CASE WHEN above = '' THEN '0' ELSE above END || '.' || free END AS path,
      CASE WHEN number IS NOT NULL THEN greatest(free, coalesce(TRY_CAST(regexp_extract(number, '[^.]*$') AS BIGINT) + 1, 1)) ELSE free + 1 END AS n
    FROM (
      SELECT *, coalesce(list_max(list_transform(list_filter(taken, lambda t: t.a = above), lambda t: t.n)), 1) AS free
      FROM (
        SELECT f.doc_id, f.ord + 1 AS ord, f.paths, f.taken, t.number,
          CASE WHEN t.number IS NOT NULL THEN CASE WHEN contains(t.number, '.') THEN regexp_replace(t.number, '\\.[^.]*$', '') ELSE '' END
               WHEN t.parent IS NULL THEN '' ELSE f.paths[t.parent + 1] END AS above
        FROM fold f JOIN tree t ON t.doc_id = f.doc_id AND t.ord = f.ord + 1) AS s1) AS s2) AS s3),
sec AS (SELECT t.*, f.path FROM tree t JOIN fold f ON f.doc_id = t.doc_id AND f.ord = t.ord)"""
