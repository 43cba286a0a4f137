"""Registered queries, each with the SQL that DuckDB checks it by where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.functions import ids, text
from foliate.operators import chunks, graph, hierarchy, normalise, projection, tables, validation, vectors
from foliate.operators import elements as el_ops
from foliate.plans import converted, sql
from foliate.plans.derived import WITH, elements, read
from foliate.plans.sql import DIST, PAIR, TEXT, VISUAL
from foliate.session import materialised
from foliate.streaming import incremental

FLAGSHIP = "relates_to_topk"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    """Register a function by its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


def _vectors(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "embeddings").select(F.col("vec_id").alias("id"), "embedding", "label")


# --- vectors -----------------------------------------------------------------

_V = "v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e, label FROM embeddings)"


@query(f"""
WITH {_V},
s AS (SELECT a.vec_id AS a, b.vec_id AS b, list_cosine_similarity(a.e, b.e) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND a.label <> b.label),
r AS (SELECT *, row_number() OVER (PARTITION BY a ORDER BY round(score, 12) DESC, b) AS rank FROM s WHERE round(score, 12) >= 0.3)
SELECT a, b, round(score, 4) AS score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 3
""")
def relates_to_topk(spark, d):
    found = vectors.top_k(_vectors(spark, d), 3, 0.3, "label")
    return found.select("a", "b", F.round("score", 4).alias("score"), F.col("rank").cast("long").alias("rank"))


@query(f"""
WITH {_V}
SELECT a.vec_id AS a, b.vec_id AS b, round(list_cosine_similarity(a.e, b.e), 4) AS score
FROM v a JOIN v b ON a.vec_id < b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.35
""")
def similarity_pairs(spark, d):
    return vectors.similar_pairs(_vectors(spark, d), 0.35).select("a", "b", F.round("score", 4).alias("score"))


@query("SELECT a.vec_id AS a, b.vec_id AS b FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id")
def sibling_pairs(spark, d):
    return vectors.siblings(_vectors(spark, d), "id", "label")


@query(f"""
WITH {_V}, n AS (SELECT vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm FROM v)
SELECT vec_id, round(e[1] / norm, 5) AS first, round(e[64] / norm, 5) AS last FROM n
""")
def l2_normalize(spark, d):
    n = read(spark, d, "embeddings").withColumn("n", vectors.l2_normalize(F.col("embedding")))
    return n.select("vec_id", F.round(F.col("n")[0], 5).alias("first"), F.round(F.col("n")[63], 5).alias("last"))


@query(f"""
WITH {_V},
s AS (SELECT q.vec_id AS query, v.vec_id AS id, v.label, round(list_cosine_similarity(q.e, v.e), 12) AS score
      FROM v q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0 AND v.label < 5),
r AS (SELECT *, row_number() OVER (PARTITION BY query ORDER BY score DESC, id) AS rank FROM s)
SELECT query, id, label, round(score, 4) AS score, CAST(rank AS BIGINT) AS rank FROM r WHERE rank <= 10
""")
def vector_search_filtered(spark, d):
    """Every row whose id is divisible by 50 searches all rows with a label under 5."""
    v = _vectors(spark, d)
    kept = v.where("label < 5")
    found = vectors.top_k(kept, 10, -1.0, queries=v.where("id % 50 = 0"))
    named = found.select(F.col("a").alias("query"), F.col("b").alias("id"), F.round("score", 4).alias("score"), F.col("rank").cast("long").alias("rank"))
    return named.join(kept.select("id", "label"), "id").select("query", "id", "label", "score", "rank")


@query(f"""
WITH RECURSIVE {_V},
e AS (SELECT a.vec_id AS f, b.vec_id AS t FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.35),
w AS (SELECT vec_id AS id, 0 AS hop FROM v WHERE vec_id % 50 = 0 UNION SELECT e.t, w.hop + 1 FROM w JOIN e ON e.f = w.id WHERE w.hop < 2)
SELECT CAST(id AS BIGINT) AS id, CAST(min(hop) AS INT) AS hop FROM w GROUP BY id
""")
def graph_expand_2hop(spark, d):
    v = _vectors(spark, d)
    edges = vectors.similar_pairs(v, 0.35).select(F.col("a").alias("source_id"), F.col("b").alias("target_id"))
    return vectors.expand(v.where("id % 50 = 0").select("id"), edges, 2)


# --- ids ---------------------------------------------------------------------


@query(f"{WITH} SELECT element_id AS short_id, {sql.uuid(ids.ELEMENT, "doc_id || ':' || page_num || ':' || reading_order || ':' || element_type")} AS element_id FROM el")
def element_ids(spark, d):
    named = ids.element_id(F.col("doc_id"), F.col("page_num"), F.col("reading_order"), F.col("element_type"))
    return elements(spark, d).select(F.col("element_id").alias("short_id"), named.alias("element_id"))


@query(f"""
SELECT vec_id, {sql.uuid(ids.RETRIEVAL_CHUNK, "'doc:' || label || '|seq:' || lpad(CAST(vec_id AS STRING), 6, '0') || '|types:image,text'")} AS chunk_id FROM embeddings
""")
def chunk_ids(spark, d):
    named = ids.retrieval_chunk_id(F.col("label"), F.col("vec_id"), F.array(F.lit("text"), F.lit("image")))
    return read(spark, d, "embeddings").select("vec_id", named.alias("chunk_id"))


@query(f"""
{WITH}, n AS (SELECT element_id AS s, lead(element_id) OVER (PARTITION BY doc_id, page_num ORDER BY reading_order) AS t FROM el)
SELECT s AS source_id, t AS target_id, {sql.uuid(ids.RELATIONSHIP, "s || ':' || t || ':precedes'")} AS relationship_id FROM n WHERE t IS NOT NULL
""")
def relationship_ids(spark, d):
    edges = graph.sequential(elements(spark, d)).where("relationship_type = 'precedes'")
    return graph.with_ids(edges).select("source_id", "target_id", "relationship_id")


# --- texts -------------------------------------------------------------------


@query(f"{WITH} SELECT element_id, {sql.caption_label('content')} AS label FROM el WHERE element_type IN ('caption', 'table', 'image', 'chart', 'graph', 'formula')")
def caption_label(spark, d):
    shown = elements(spark, d).where("element_type IN ('caption', 'table', 'image', 'chart', 'graph', 'formula')")
    return shown.select("element_id", text.caption_label(F.col("content")).alias("label"))


@query(f"{WITH} SELECT element_id, coalesce(array_to_string({sql.caption_references('content')}, ','), '') AS labels FROM el WHERE element_type IN {TEXT}")
def caption_refs(spark, d):
    found = F.array_join(text.caption_references(F.col("content")), ",")
    return elements(spark, d).where(f"element_type IN {TEXT}").select("element_id", found.alias("labels"))


#: ix(document, label, chunk_id): the last visual of each label.
_INDEX = f"""ix AS (
  SELECT document, label, max_by(chunk_id, ordinal) AS chunk_id
 
    FROM (SELECT doc_id AS document, element_id AS chunk_id, ordinal, {sql.caption_label('content')} AS label FROM el WHERE element_type IN ('table', 'image', 'chart', 'graph')) AS c
  WHERE label IS NOT NULL GROUP BY 1, 2)"""


def _index(e: DataFrame) -> DataFrame:
    refs = e.select(
        F.col("doc_id").alias("document"), F.col("element_id").alias("chunk_id"), F.col("element_id").alias("self_ref"),
        F.col("ordinal").alias("sequence_number"),
    )
    shown = e.where("element_type IN ('table', 'image', 'chart', 'graph')")
    return chunks.caption_index(
        refs, shown.select(F.col("doc_id").alias("document"), F.col("element_id").alias("self_ref"), "ordinal", F.col("content").alias("caption")),
    )


@query(f"{WITH}, {_INDEX} SELECT document, label, chunk_id FROM ix")
def caption_index(spark, d):
    return _index(elements(spark, d))


@query(f"""
{WITH}, {_INDEX},
h AS (SELECT doc_id AS document, element_id AS own, unnest({sql.caption_references('content')}) AS label FROM el WHERE element_type IN {TEXT})
SELECT own AS chunk_id, string_agg(DISTINCT chunk_id, ',' ORDER BY chunk_id) AS refers_to FROM h JOIN ix USING (document, label) WHERE chunk_id <> own GROUP BY own
""")
def xref_refers_to(spark, d):
    e = elements(spark, d)
    c = e.where(f"element_type IN {TEXT}").select(F.col("doc_id").alias("document"), F.col("element_id").alias("chunk_id"), F.col("content").alias("chunk_text"))
    found = chunks.cross_references(c, _index(e)).where(F.size("refers_to") > 0)
    return found.select("chunk_id", F.array_join("refers_to", ",").alias("refers_to"))


@query(f"""
{WITH}, {sql.NUMBERED}
SELECT element_id, CAST(coalesce(level, 0) AS INT) AS level, number, CASE WHEN level IS NOT NULL THEN title END AS title, coalesce(keyword, false) AS keyword
FROM num WHERE element_type IN ('section_header', 'text_block', 'list_block')
""")
def section_numbering(spark, d):
    e = elements(spark, d).where("element_type IN ('section_header', 'text_block', 'list_block')")
    n = e.withColumn("n", text.section_numbering(F.col("content")))
    keyword = F.coalesce(text.is_section_keyword(F.col("content")), F.lit(False))
    return n.select("element_id", F.coalesce("n.level", F.lit(0)).alias("level"), "n.number", "n.title", keyword.alias("keyword"))


# --- order -------------------------------------------------------------------


@query(f"""
{WITH}, b AS (
  SELECT *, ordinal % 3 = 0 AS told, coalesce(x0 + y0 + x1 + y1, 0) = 0 AS bare, (x0 + x1) / 2 AS centre, CASE
    WHEN greatest(x0, y0, x1, y1) <= 1 THEN 0.3 ELSE 200.0 END AS width FROM el)
SELECT element_id, CAST(row_number() OVER (PARTITION BY doc_id, page_num ORDER BY CASE WHEN told THEN 0 ELSE 1 END, CASE WHEN told THEN ordinal END NULLS LAST,
    CASE WHEN told THEN NULL WHEN bare THEN 0 ELSE CAST(trunc(centre / width) AS INT) END, CASE WHEN told THEN NULL WHEN bare THEN 0.0 ELSE y0 END,
    CASE WHEN told THEN NULL WHEN bare THEN 0.0 ELSE centre END, ordinal) - 1 AS BIGINT) AS reading_order FROM b
""")
def reading_order(spark, d):
    e = elements(spark, d).drop("reading_order").withColumn("item_order", F.when(F.col("ordinal") % 3 == 0, F.col("ordinal")))
    return el_ops.reading_order(e).select("element_id", F.col("reading_order").cast("long").alias("reading_order"))


@query("""
SELECT CAST(l_suppkey AS STRING) AS doc_id, CAST(1 + l_partkey % 20 AS INT) AS page_num,
  CAST(max(l_linenumber) - min(l_linenumber) + 1 - count(DISTINCT l_linenumber) AS BIGINT) AS gaps, CAST(count(*) - count(DISTINCT l_linenumber) AS BIGINT) AS duplicates
FROM lineitem GROUP BY 1, 2
""")
def reading_order_gaps(spark, d):
    page = (1 + F.col("l_partkey") % 20).cast("int")
    items = read(spark, d, "lineitem").select(F.col("l_suppkey").cast("string").alias("doc_id"), page.alias("page_num"), F.col("l_linenumber").alias("item_order"))
    return validation.order_gaps(items)


_NEXT = "n AS (SELECT element_id AS s, lead(element_id) OVER (PARTITION BY doc_id, page_num ORDER BY reading_order) AS t FROM el)"


@query(f"""
{WITH}, {_NEXT}
SELECT s AS source_id, t AS target_id, 'precedes' AS relationship_type FROM n WHERE t IS NOT NULL UNION ALL SELECT t, s, 'follows' FROM n WHERE t IS NOT NULL
""")
def rel_sequential(spark, d):
    return graph.sequential(elements(spark, d)).select("source_id", "target_id", "relationship_type")


@query(f"{WITH} SELECT doc_id, page_num, string_agg(element_id, ',' ORDER BY reading_order) AS element_ids FROM el GROUP BY 1, 2 UNION ALL SELECT DISTINCT doc_id, 21, '' FROM el")
def page_elements(spark, d):
    """Pages with a size or elements; page 21 of each document is empty."""
    e = elements(spark, d)
    found = el_ops.page_elements(e, e.select("doc_id", F.lit(21).alias("page_num")).distinct())
    return found.select("doc_id", "page_num", F.array_join("element_ids", ",").alias("element_ids"))


# --- space -------------------------------------------------------------------


@query(f"""
{WITH} SELECT a.element_id AS source_id, b.element_id AS target_id, round(1 - dist, 6) AS weight FROM {sql.near(0.08, 'a.element_id < b.element_id')} AS p
""")
def rel_nearby(spark, d):
    return graph.nearby(elements(spark, d)).select("source_id", "target_id", "weight")


@query(f"{WITH} SELECT a.element_id AS source_id, b.element_id AS target_id FROM {sql.near(0.08, 'a.ordinal < b.ordinal')} AS p")
def proximity_pairs(spark, d):
    return graph.proximity(elements(spark, d)).select("source_id", "target_id")


@query(f"""
{WITH}, p AS (
  SELECT a.element_id AS caption_id, b.element_id AS parent_id, (a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2 AS dist, b.ordinal {PAIR}
  WHERE a.element_type = 'caption' AND b.element_type IN {VISUAL} AND (b.y0 + b.y1) / 2 <= (a.y0 + a.y1) / 2),
r AS (SELECT *, row_number() OVER (PARTITION BY caption_id ORDER BY dist, ordinal) AS n FROM p)
SELECT caption_id, parent_id, round(dist, 4) AS dist FROM r WHERE n = 1 AND dist <= 0.3
""")
def caption_parent(spark, d):
    return graph.caption_parents(elements(spark, d)).select("caption_id", "parent_id", F.round("dist", 4).alias("dist"))


_PARENTS = f"""p AS (
  SELECT a.element_id AS c, b.element_id AS v, a.ordinal AS o, (a.y0 + a.y1) / 2 - (b.y0 + b.y1) / 2 AS dist, b.ordinal {PAIR}
  WHERE a.element_type = 'caption' AND b.element_type IN {VISUAL} AND (b.y0 + b.y1) / 2 <= (a.y0 + a.y1) / 2),
r AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY dist, ordinal) AS n FROM p),
f AS (SELECT element_id AS c, doc_id, ordinal FROM el WHERE element_type = 'caption'),
l AS (SELECT f.c, CASE WHEN f.ordinal % 10 = 0 THEN concat(f.doc_id, '-000001') ELSE r.v END AS v FROM f LEFT JOIN r ON r.c = f.c AND n = 1 AND dist <= 0.3)"""


@query(f"""
{WITH}, {_PARENTS}
SELECT v AS source_id, c AS target_id, 'has_caption' AS relationship_type FROM l WHERE v IS NOT NULL UNION ALL SELECT c, v, 'describes' FROM l WHERE v IS NOT NULL
""")
def caption_links(spark, d):
    """Some captions name their parent, others stand under it."""
    e = elements(spark, d)
    named = F.when((F.col("element_type") == "caption") & (F.col("ordinal") % 10 == 0), F.concat("doc_id", F.lit("-000001")))
    return graph.caption_links(e.withColumn("parent_element_id", named)).select("source_id", "target_id", "relationship_type")


_MATES = f"{PAIR} AND a.element_id <> b.element_id"


@query(f"""
{WITH}, q AS (
  SELECT a.element_id AS a, b.element_id AS b, b.element_type AS kind, {DIST} AS dist, {sql.MENTIONS_TABLE} AS told {_MATES}
  WHERE a.element_type = 'table' AND b.element_type IN ('caption', 'text_block', 'list_block', 'footnote'))
SELECT a AS source_id, b AS target_id, 'has_caption' AS relationship_type FROM q WHERE kind = 'caption' AND dist IS NOT NULL AND (dist <= 0.15 OR told)
UNION ALL SELECT b, a, 'describes' FROM q WHERE kind IN {TEXT} AND dist <= 0.2 AND told
UNION ALL SELECT a, b, 'refers_to' FROM q WHERE kind = 'footnote' AND dist <= 0.15
""")
def table_edges(spark, d):
    return graph.table_edges(materialised(elements(spark, d))).select("source_id", "target_id", "relationship_type")


@query(f"""
{WITH}, q AS (
  SELECT a.element_id AS a, b.element_id AS b, b.element_type AS kind, abs(a.reading_order - b.reading_order) AS apart, {DIST} AS dist,
    {sql.MENTIONS_FORMULA} AS told {_MATES}
  WHERE a.element_type = 'formula' AND b.element_type IN ('caption', 'text_block', 'footnote'))
SELECT b AS source_id, a AS target_id, 'explains' AS relationship_type FROM q WHERE kind = 'text_block' AND dist IS NOT NULL AND (dist <= 0.15 OR apart <= 3 AND told)
UNION ALL SELECT b, a, 'has_formula' FROM q WHERE kind = 'caption' AND dist IS NOT NULL AND (dist <= 0.15 OR told)
UNION ALL SELECT a, b, 'refers_to' FROM q WHERE kind = 'footnote' AND dist <= 0.15
""")
def formula_edges(spark, d):
    return graph.formula_edges(materialised(elements(spark, d))).select("source_id", "target_id", "relationship_type")


@query(f"""
{WITH}, q AS (
  SELECT a.element_id AS a, b.element_id AS b, b.element_type AS kind, {DIST} AS dist, {sql.MENTIONS_VISUAL} AS told,
    {sql.strip('lower(b.content)')} = 'notes on the page' AND a.ordinal % 7 = 0 AS same {_MATES}
  WHERE a.element_type IN ('image', 'chart', 'graph'))
SELECT a AS source_id, b AS target_id, 'has_caption' AS relationship_type FROM q
  WHERE kind = 'caption' AND dist IS NOT NULL AND (dist <= 0.15 OR told OR coalesce(same, false))
UNION ALL SELECT b, a, 'describes' FROM q WHERE kind IN {TEXT} AND dist <= 0.2 AND told
UNION ALL SELECT a, b, 'nearby' FROM q WHERE kind NOT IN ('caption', 'text_block', 'list_block') AND dist <= 0.15
""")
def visual_edges(spark, d):
    """Some visuals carry the text of a caption."""
    e = elements(spark, d).withColumn("caption", F.when(F.col("ordinal") % 7 == 0, F.lit(" Notes on the page")))
    return graph.visual_edges(materialised(e)).select("source_id", "target_id", "relationship_type")


# --- graph -------------------------------------------------------------------


@query(f"""
{WITH} SELECT doc_id, section_path, count(*) AS members, string_agg(element_id, ',' ORDER BY page_num, reading_order) AS member_ids
FROM el WHERE section_path <> '' GROUP BY 1, 2 HAVING count(*) >= 2
""")
def rel_same_section(spark, d):
    found = graph.same_section(elements(spark, d))
    return found.select("doc_id", "section_path", F.col("detail").cast("long").alias("members"), F.array_join("member_ids", ",").alias("member_ids"))


#: d(s, t, apart): texts and visual elements of a section, at most two places apart on a page.
_DESCRIBES = f"""d AS (
  SELECT a.element_id AS s, b.element_id AS t, abs(a.reading_order - b.reading_order) AS apart
  FROM (SELECT *, reading_order + o AS at FROM el, (VALUES (-2), (-1), (1), (2)) AS i(o) WHERE element_type IN {TEXT} AND section_path <> '') a
  JOIN el b ON b.doc_id = a.doc_id AND b.page_num = a.page_num AND b.section_path = a.section_path AND b.reading_order = a.at AND b.element_type IN {VISUAL})"""


@query(f"{WITH}, {_DESCRIBES} SELECT s AS source_id, t AS target_id, CAST(apart AS BIGINT) AS apart FROM d")
def rel_describes(spark, d):
    return graph.describes(elements(spark, d)).select("source_id", "target_id", F.col("detail").cast("long").alias("apart"))


@query(f"{WITH}, {sql.LABELS} SELECT DISTINCT s AS source_id, t AS target_id FROM src JOIN lab USING (doc_id, label) WHERE s <> t")
def rel_refers_to(spark, d):
    return graph.references(elements(spark, d)).select("source_id", "target_id")


def _contained(e: DataFrame) -> DataFrame:
    section = F.concat_ws("/", "doc_id", "section_path")
    return e.where("section_path <> ''").select(
        "doc_id", "page_num", section.alias("source_id"), F.col("element_id").alias("target_id"), F.lit("contains").alias("relationship_type"),
        F.lit(1.0).alias("weight"), F.lit(None).cast("string").alias("detail"),
    )


@query(f"{WITH} SELECT element_id AS source_id, concat(doc_id, '/', section_path) AS target_id, 'belongs_to' AS relationship_type FROM el WHERE section_path <> ''")
def rel_belongs_to(spark, d):
    return graph.belongs_to(_contained(elements(spark, d))).select("source_id", "target_id", "relationship_type")


@query(f"{WITH} SELECT a.element_id AS source_id, b.element_id AS target_id FROM {sql.near(0.08, 'a.element_id < b.element_id')} AS p")
def rel_dedup(spark, d):
    """Neighbours twice, turned round, and of each element with itself."""
    e = materialised(elements(spark, d))
    pairs = graph.nearby(e)
    turned = graph.proximity(e).select(
        "doc_id", "page_num", F.col("target_id").alias("source_id"), F.col("source_id").alias("target_id"), "relationship_type", "weight", "detail",
    )
    own = e.select(
        "doc_id", "page_num", F.col("element_id").alias("source_id"), F.col("element_id").alias("target_id"),
        F.lit("nearby").alias("relationship_type"), F.lit(1.0).alias("weight"), F.lit(None).cast("string").alias("detail"),
    )
    out = pairs.withColumn("rank", F.lit(0))
    for rank, p in ((1, turned), (2, pairs), (0, own)):
        out = out.unionByName(p.withColumn("rank", F.lit(rank)))
    return graph.deduplicated(out).select("source_id", "target_id")


@query(f"""
{WITH} SELECT least(a.element_id, b.element_id) AS a, greatest(a.element_id, b.element_id) AS b, count(*) AS told
FROM {sql.near(0.15, "a.element_id <> b.element_id", "element_type IN ('image', 'chart', 'graph')", "element_type NOT IN ('caption', 'text_block', 'list_block')")} AS p
  GROUP BY 1, 2
""")
def rel_undirected(spark, d):
    """Neighbours of visual elements, each pair once, and how often it was found."""
    found = graph.visual_edges(materialised(elements(spark, d))).where("relationship_type = 'nearby'")
    often = found.groupBy(F.least("source_id", "target_id").alias("a"), F.greatest("source_id", "target_id").alias("b")).agg(F.count("*").alias("told"))
    once = graph.undirected(found).select(F.least("source_id", "target_id").alias("a"), F.greatest("source_id", "target_id").alias("b"))
    return once.join(often, ["a", "b"])


#: e(source_id, target_id, relationship_type, weight): the edges of all generators.
_ALL = f"""{_NEXT}, {sql.LABELS}, {_DESCRIBES}, e AS (
  SELECT s AS source_id, t AS target_id, 'precedes' AS relationship_type, 1.0 AS weight FROM n WHERE t IS NOT NULL
  UNION ALL SELECT t, s, 'follows', 1.0 FROM n WHERE t IS NOT NULL
  UNION ALL SELECT a.element_id, b.element_id, 'nearby', round(1 - dist, 6) FROM {sql.near(0.08, 'a.element_id < b.element_id')} AS p
  UNION ALL SELECT id, id, 'same_section_as', 1.0 FROM (
    SELECT doc_id, {sql.uuid(ids.DNS, f"'{ids.SAME_SECTION}' || section_path")} AS id FROM el WHERE section_path <> '' GROUP BY doc_id,
      section_path HAVING count(*) >= 2) AS g
  UNION ALL SELECT DISTINCT s, t, 'refers_to', 1.0 FROM src JOIN lab USING (doc_id, label) WHERE s <> t
  UNION ALL SELECT s, t, 'describes', 1.0 FROM d)"""


@query(f"{WITH}, {_ALL} SELECT relationship_type, count(*) AS n FROM e GROUP BY 1")
def rel_summary(spark, d):
    return graph.summary(graph.all_edges(elements(spark, d)))


@query(f"""
{WITH}, {_ALL},
c AS (SELECT concat(doc_id, '/', section_path) AS s, element_id AS t FROM el WHERE section_path <> ''),
x AS (SELECT * FROM e UNION ALL SELECT s, t, 'contains', 1.0 FROM c UNION ALL SELECT t, s, 'belongs_to', 1.0 FROM c)
SELECT source_id, target_id, relationship_type, weight,
  {sql.uuid(ids.RELATIONSHIP, "source_id || ':' || target_id || ':' || relationship_type")} AS relationship_id FROM x
""")
def rel_all(spark, d):
    e = elements(spark, d)
    found = graph.with_ids(graph.all_edges(e, _contained(e)))
    return found.select("source_id", "target_id", "relationship_type", "weight", "relationship_id")


# --- sections ----------------------------------------------------------------


def _headed(spark: SparkSession, d: str) -> DataFrame:
    e = elements(spark, d).drop("section_path").withColumn("__n", F.when(F.col("element_type") == "section_header", text.section_numbering(F.col("content"))))
    return materialised(e.withColumns({"section_path": F.lit(""), "level": F.col("__n.level"), "section_number": F.col("__n.number")}).drop("__n"))


#: ided(sec.*, section_id, parent_id) and, for each element, the last heading up to it (at).
_IDED = f"""{sql.SECTIONS}, own AS (SELECT *, {sql.uuid(ids.SECTION, "doc_id || ':' || path || ':' || lower(trim(title))")} AS section_id FROM sec),
ided AS (SELECT o.*, p.section_id AS parent_id FROM own o LEFT JOIN own p ON p.doc_id = o.doc_id AND p.ord = o.parent),
placed AS (
  SELECT q.*, s.path, s.section_id FROM (
    SELECT e.*, max(h.ord) OVER (PARTITION BY e.doc_id ORDER BY e.page_num, e.reading_order, e.y0, e.x0, e.element_id ROWS UNBOUNDED PRECEDING) AS at
    FROM el e LEFT JOIN heads h ON h.element_id = e.element_id) AS q
  LEFT JOIN own s ON s.doc_id = q.doc_id AND s.ord = q.at)"""
_OUTSIDE = "('header', 'footer', 'footnote', 'caption')"


@query(f"{WITH}, {_IDED} SELECT doc_id, element_id, CAST(level AS INT) AS level, number, title, path AS section_path, section_id, parent_id AS parent_section_id FROM ided")
def section_tree(spark, d):
    return hierarchy.sections(_headed(spark, d)).select("doc_id", "element_id", "level", "number", "title", "section_path", "section_id", "parent_section_id")


@query(f"{WITH}, {_IDED} SELECT element_id, CASE WHEN element_type IN {_OUTSIDE} THEN '' ELSE coalesce(path, '') END AS section_path FROM placed")
def section_paths(spark, d):
    return hierarchy.assign_paths(_headed(spark, d)).select("element_id", "section_path")


@query(f"""
{WITH}, {_IDED},
i AS (SELECT section_id, element_id, row_number() OVER (PARTITION BY doc_id, section_id ORDER BY page_num, reading_order, y0, x0, element_id) AS n FROM placed
      WHERE section_id IS NOT NULL AND element_type NOT IN {_OUTSIDE}),
c AS (SELECT parent_id AS s, section_id AS t FROM ided WHERE parent_id IS NOT NULL UNION SELECT section_id, element_id FROM i
  WHERE n > 1 UNION SELECT doc_id, section_id FROM ided WHERE parent IS NULL)
SELECT s AS source_id, t AS target_id, 'contains' AS relationship_type FROM c
""")
def rel_contains(spark, d):
    return hierarchy.contains(_headed(spark, d)).select("source_id", "target_id", "relationship_type")


# --- converted documents -----------------------------------------------------


def _normalised(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return normalise.normalise(converted.documents(spark, d))


@query(f"""
{WITH}, {converted.NORMALISED}
SELECT doc_id, page_num, CAST(reading_order AS BIGINT) AS reading_order, element_id, element_type, content, round(x0, 6) AS x0, round(y0, 6) AS y0,
  round(x1, 6) AS x1, round(y1, 6) AS y1 FROM nor
""")
def normalise_document(spark, d):
    found = _normalised(spark, d)[0]
    box = [F.round(c, 6).alias(n) for c, n in (("left", "x0"), ("top", "y0"), ("right", "x1"), ("bottom", "y1"))]
    return found.select(F.col("doc_id").cast("string").alias("doc_id"), "page_num", F.col("reading_order").cast("long").alias("reading_order"), "element_id", "element_type", "content", *box)


@query(f"""
{WITH}, {converted.NORMALISED}, all_pages AS (SELECT doc_id, unnest(range(1, 21)) AS page_num FROM (SELECT DISTINCT doc_id FROM el) AS ds)
SELECT doc_id, CAST(page_num AS INT) AS page_num, coalesce(string_agg(element_id, ',' ORDER BY reading_order), '') AS element_ids FROM all_pages LEFT
  JOIN nor USING (doc_id, page_num) GROUP BY 1, 2
""")
def normalise_pages(spark, d):
    return _normalised(spark, d)[1].select(F.col("doc_id").cast("string").alias("doc_id"), "page_num", F.array_join("element_ids", ",").alias("element_ids"))


@query(f"""
{WITH}, {converted.NORMALISED}, {converted.LINKS}
SELECT source_id, target_id, relationship_type, weight,
  {sql.uuid(ids.RELATIONSHIP, "source_id || ':' || target_id || ':' || relationship_type")} AS relationship_id FROM link
""")
def normalise_links(spark, d):
    links = _normalised(spark, d)[2]
    return links.select("source_id", "target_id", "relationship_type", "weight", "relationship_id")


def _describer(uri: str, caption: str) -> tuple[str, list[str]]:
    return f"shows {uri}", ["a", "b"]


@query(f"""
{WITH}, {converted.METADATA}
SELECT CAST(seq AS INT) AS sequence_number, embedding_type, chunk_text, array_to_string(types, '|') AS chunk_types, refs AS element_self_refs,
  section_path, page_numbers, image_type, image_uri, caption_text, caption_number,
  CAST(coalesce(token_count, -1) AS INT) AS token_count,
    {sql.uuid(ids.RETRIEVAL_CHUNK, "'doc:' || doc_id || '|seq:' || lpad(CAST(seq AS VARCHAR), 6, '0') || '|types:' || array_to_string(list_sort(types), ',')")} AS chunk_id
    FROM meta
""")
def chunk_metadata(spark, d):
    docs, made = converted.chunked(spark, d)
    parsed = materialised(docs).select("document", normalise.document(F.col("json")).alias("v"))
    found = projection.chunk_metadata(parsed, materialised(made), _describer)
    lists = ["chunk_types", "element_self_refs", "page_numbers", "image_type", "image_uri", "caption_text", "caption_number"]
    flat = {c: F.array_join(F.col(c).cast("array<string>"), "|") for c in lists} | {"token_count": F.coalesce("token_count", F.lit(-1))}
    return found.withColumns(flat).select("sequence_number", "embedding_type", "chunk_text", *lists, "section_path", "token_count", "chunk_id")


# --- tables, formulas, visuals -----------------------------------------------

_RUNS = """
t AS (SELECT *, CASE WHEN page_num - lag(page_num) OVER w > 2 THEN 1 ELSE 0 END AS step FROM (SELECT *, ordinal % 2 AS v3 FROM el WHERE element_type = 'table') AS q
      WINDOW w AS (PARTITION BY doc_id, section_path, m, v3 ORDER BY page_num, reading_order, element_id)),
r AS (SELECT *, sum(step) OVER (PARTITION BY doc_id, section_path, m, v3 ORDER BY page_num, reading_order, element_id) AS run FROM t),
g AS (SELECT *, count(*) OVER w AS n, min(page_num) OVER w AS lo FROM r WINDOW w AS (PARTITION BY doc_id, section_path, m, v3, run))"""


@query(f"""
{WITH}, {_RUNS}
SELECT element_id, n >= 2 AS is_spanning,
  CASE
    WHEN n >= 2 THEN {sql.uuid(ids.SPAN, "doc_id || ':' || section_path || ':' || lo || ':3:' || substr(md5(concat('name|h', v3)), 1, 12)")} END AS span_group_id
    FROM g
""")
def spanning_tables(spark, d):
    headers = F.array(F.lit(" Name "), F.concat(F.lit("H"), (F.col("ordinal") % 2).cast("string")), F.lit(""))
    t = elements(spark, d).where("element_type = 'table'").withColumns({"col_count": F.lit(3), "headers": headers})
    return tables.spanning(t).select("element_id", "is_spanning", "span_group_id")


@query("SELECT p_partkey, substr(md5(concat(lower(p_brand), '|', lower(p_type))), 1, 12) AS signature FROM part")
def header_signature(spark, d):
    p = read(spark, d, "part")
    return p.select("p_partkey", tables.header_signature(F.array(F.concat(F.lit(" "), F.col("p_brand")), F.lit("  "), F.upper("p_type"))).alias("signature"))


@query("""
WITH p AS (
  SELECT p_partkey, p_partkey % 5 AS form, p_brand AS a, CAST(p_size AS VARCHAR) AS b, CAST(p_partkey AS VARCHAR) AS c, p_partkey % 7 = 0 AS wide,
    CASE WHEN p_partkey % 4 = 0 THEN 'A note' ELSE '' END AS told FROM part),
q AS (SELECT *, CASE WHEN wide THEN ['Name', 'Size', 'Third'] ELSE ['Name', 'Size'] END AS h, CASE WHEN wide THEN [[a, b, 'y'], ['x', c, 'z']]
  ELSE [[a, b], ['x', c]] END AS r FROM p)
SELECT p_partkey, CAST(2 AS INT) AS row_count, CAST(len(h) AS INT) AS col_count,
  CASE WHEN told <> '' THEN told || '. ' ELSE '' END || 'Table with 2 row(s) and ' || len(h) || ' column(s), headers: [' || array_to_string(h, ', ') || ']' AS summary,
  concat_ws(chr(10), '| ' || array_to_string(h, ' | ') || ' |', '| ' || array_to_string(list_transform(h, lambda x: '---'), ' | ') || ' |', array_to_string(list_transform(r, lambda x: '| ' || array_to_string(x, ' | ') || ' |'), chr(10))) AS markdown,
  concat_ws(chr(10), '<table>', '  <thead>', '    <tr><th>' || array_to_string(h, '</th><th>') || '</th></tr>', '  </thead>', '  <tbody>',
    array_to_string(list_transform(r, lambda x: '    <tr><td>' || array_to_string(x, '</td><td>') || '</td></tr>'), chr(10)), '  </tbody>', '</table>') AS html FROM q
""")
def table_enrich(spark, d):
    """Tables as markdown, HTML, tabbed text, JSON rows and JSON columns."""
    p = read(spark, d, "part")
    form, wide = F.col("p_partkey") % 5, F.col("p_partkey") % 7 == 0
    a, b, c = F.col("p_brand"), F.col("p_size").cast("string"), F.col("p_partkey").cast("string")
    third = lambda there, x: F.when(wide, F.lit(there)).otherwise(F.lit(x))
    md = F.concat(
        F.lit("before\n| Name | Size |"), third(" Third |", ""), F.lit("\n|---|:--|"), third("--|", ""), F.lit("\n|"), a, F.lit("|  "), b,
        F.lit(" |"), third("y|", ""), F.lit("\n| x | "), c, F.lit(" |"), third(" z |", ""), F.lit("\nafter"),
    )
    html = F.concat(
        F.lit(
            "<table class='t'><thead><tr><th>Name</th><th>Size</th>"
        ), third("<th>Third</th>", ""), F.lit("</tr></thead><tr><td>"), a, F.lit("</td><td> "), b, F.lit("\n</td>"), third("<td>y</td>", ""),
        F.lit("</tr><tr><td><b>x</b></td><td>"), c, F.lit("</td>"), third("<td>z</td>", ""), F.lit("</tr></table>"),
    )
    tab = F.concat(F.lit("Name\tSize"), third("\tThird", ""), F.lit("\n"), a, F.lit("\t"), b, third("\ty", ""), F.lit("\nx\t"), c, third("\tz", ""))
    cells = lambda x, y, z: F.when(wide, F.array(x, y, z)).otherwise(F.array(x, y))
    one = lambda x, y, z: F.to_json(F.map_from_arrays(cells(F.lit("Name"), F.lit("Size"), F.lit("Third")), cells(x, y, z)))
    rows = F.concat(F.lit('{"rows":['), one(a, b, F.lit("y")), F.lit(","), one(F.lit("x"), c, F.lit("z")), F.lit("]}"))
    columns = F.to_json(
        F.map_from_arrays(cells(F.lit("Name"), F.lit("Size"), F.lit("Third")), cells(F.array(a, F.lit("x")), F.array(b, c), F.array(F.lit("y"), F.lit("z"))))
    )
    told = F.when(F.col("p_partkey") % 4 == 0, F.lit("A note")).otherwise(F.lit(""))
    source = p.select(
        "p_partkey", F.when(form == 0, md).alias("markdown"), F.when(form == 1, html).alias("html"), F.when(form == 2, tab).alias("content"),
        F.when(form == 3, rows).when(form == 4, columns).alias("json_data"), told.alias("summary"),
    )
    return tables.enrich(source).select("p_partkey", "row_count", "col_count", "summary", "markdown", "html")


_FORMULA = """CASE p_partkey % 6 WHEN 0 THEN concat('$$x_{', p_size, '}$$') WHEN 1 THEN concat('a $y + ', p_size, '$ b') WHEN 2 THEN 'z \\begin{align}z\\end{align}'
  WHEN 3 THEN 'w' WHEN 4 THEN concat('u', chr(10), 'v') ELSE concat('\\[', p_size, '\\]') END"""


@query("""
SELECT p_partkey, CASE WHEN p_partkey % 6 IN (0, 2, 4, 5) THEN 'display' WHEN p_partkey % 6 = 1 THEN 'inline' WHEN p_size / 50.0 > 0.4 THEN 'display'
  WHEN p_size / 50.0 < 0.15 THEN 'inline' END AS formula_type FROM part
""")
def formula_type(spark, d):
    p = read(spark, d, "part").withColumn("f", F.expr(_FORMULA.replace("\\", "\\\\")))
    return p.select("p_partkey", text.formula_type(F.col("f"), F.lit(""), F.lit(None).cast("string"), F.col("p_size") / 50.0).alias("formula_type"))


@query("""
SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN 'alpha,cdot,x,y' ELSE 'Omega,b,mapsto,sin' END AS variables,
  CASE p_partkey % 2 WHEN 0 THEN concat('alpha * x / y ', p_size) ELSE 'sin Omega -> b' END AS reading FROM part
""")
def formula_variables(spark, d):
    even = F.concat(F.lit("\\alpha \\cdot \\frac{x}{y}^{"), F.col("p_size").cast("string"), F.lit("}"))
    p = read(spark, d, "part").withColumn("f", F.when(F.col("p_partkey") % 2 == 0, even).otherwise(F.lit("\\sin \\Omega \\mapsto \\mathrm{b}")))
    return p.select("p_partkey", F.array_join(text.variables(F.col("f"), F.lit("")), ",").alias("variables"), text.latex_text(F.col("f")).alias("reading"))


@query(f"""
SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'x_{{' || p_size || '}}' WHEN 1 THEN 'y + ' || p_size WHEN 2 THEN 'z \\begin{{align}}z\\end{{align}}'
  WHEN 3 THEN 'w' WHEN 4 THEN 'u' || chr(10) || 'v' ELSE CAST(p_size AS VARCHAR) END AS latex,
  CASE WHEN p_partkey % 6 = 3 THEN CASE WHEN p_size / 50.0 > 0.4 THEN 'display' WHEN p_size / 50.0 < 0.15 THEN 'inline' ELSE 'display' END
    WHEN p_partkey % 6 = 1 THEN 'inline' ELSE 'display' END AS formula_type,
  CASE p_partkey % 6 WHEN 0 THEN 'x ' || p_size WHEN 1 THEN 'y + ' || p_size WHEN 2 THEN 'z' WHEN 3 THEN 'w' WHEN 4 THEN 'u v'
    ELSE CAST(p_size AS VARCHAR) END AS text_approximation,
  CASE p_partkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'y' WHEN 2 THEN 'z' WHEN 3 THEN 'w' WHEN 4 THEN 'u,v' ELSE '' END AS variables FROM part
""")
def formula_process(spark, d):
    p = read(spark, d, "part").withColumns(
        {"content": F.expr(_FORMULA.replace("\\", "\\\\")), "latex": F.lit(""), "formula_type": F.lit("display"), "text_approximation": F.lit("")}
    )
    found = text.process_formula(p.withColumns({"left": F.lit(0.0), "right": F.col("p_size") / 50.0}))
    return found.select("p_partkey", "latex", "formula_type", "text_approximation", F.array_join("variables", ",").alias("variables"))


@query(f"""
{WITH}, s AS (SELECT *, x1 - x0 AS w, y1 - y0 AS h FROM el WHERE element_type IN ('image', 'chart', 'graph'))
SELECT element_id, CASE WHEN element_type <> 'image' THEN element_type WHEN m = '1' THEN 'photograph' WHEN m = '2' THEN 'logo'
  WHEN w / h > 4 OR w / h < 0.25 THEN 'decorative'
  WHEN w / h BETWEEN 0.8 AND 1.2 THEN CASE WHEN w * h * 1000000 < 10000 THEN 'logo' ELSE 'illustration' END
  WHEN w * h * 1000000 < 5000 THEN 'logo' WHEN w * h * 1000000 > 500000 THEN 'photograph' ELSE 'unclassified' END AS visual_type FROM s
""")
def visual_type(spark, d):
    e = elements(spark, d).where("element_type IN ('image', 'chart', 'graph')")
    caption = F.when(F.col("m") == "1", F.lit("A Photo.")).when(F.col("m") == "2", F.lit("the LOGO"))
    shown = text.visual_type(F.col("element_type"), caption, F.lit("of sales"), F.col("right") - F.col("left"), F.col("bottom") - F.col("top"))
    return e.select("element_id", shown.alias("visual_type"))


# --- validation --------------------------------------------------------------

_VALID = "coalesce(x0 - 0.02 >= 0 AND x0 - 0.02 < x1 AND y0 >= 0 AND y0 < y1 AND x1 <= 0.8 AND y1 <= 0.85, false)"


@query(f"{WITH} SELECT element_id, {_VALID} AS valid FROM el")
def bbox_valid(spark, d):
    e = elements(spark, d).withColumn("left", F.col("left") - 0.02)
    return e.select("element_id", validation.box_valid(F.lit(0.8), F.lit(0.85)).alias("valid"))


#: checks(doc_id, check_name, failures) of items made from the elements.
_CHECKS = f"""i AS (
  SELECT doc_id, page_num, ordinal, CASE WHEN ordinal % 50 = 0 THEN 'title' WHEN element_type = 'table' THEN 'table' ELSE 'text' END AS type,
    {_VALID} AS ok, ordinal % 7 AS item_order,
    CASE WHEN element_type = 'table' THEN ordinal % 4 END AS nrow, CASE WHEN element_type = 'table' THEN 2 END AS ncol, CASE
      WHEN ordinal % 2 = 0 THEN 'c' END AS cap FROM el),
d AS (SELECT doc_id, count(DISTINCT page_num) AS pages, CASE WHEN CAST(doc_id AS INT) % 3 = 0 THEN 19 ELSE 20 END AS page_count FROM el GROUP BY 1),
o AS (
  SELECT doc_id, count(*) FILTER (WHERE g > 0 OR du > 0) AS f FROM (
    SELECT doc_id, page_num, max(item_order) - min(item_order) + 1 - count(DISTINCT item_order) AS g, count(*) - count(DISTINCT item_order) AS du
      FROM i GROUP BY 1, 2) AS q GROUP BY 1),
a AS (
  SELECT i.doc_id, any_value(d.pages) AS pages, any_value(d.page_count) AS page_count, count(*) FILTER (WHERE NOT ok) AS bad, count(*) AS n,
    count(*) FILTER (WHERE type = 'title') AS unk,
    count(*) FILTER (WHERE (nrow IS NOT NULL OR type = 'table') AND (coalesce(nrow, 0) = 0 OR coalesce(ncol, 0) = 0)) AS tab,
      count(*) FILTER (WHERE type = 'table' AND cap IS NULL) AS bare,
    count(*) FILTER (WHERE page_num < 1 OR page_num > d.page_count) AS outside FROM i JOIN d USING (doc_id) GROUP BY 1),
checks AS (
  SELECT a.doc_id, unnest([
    {{'c': 'page_count', 'f': CASE WHEN pages <> page_count THEN 1 ELSE 0 END}}, {{'c': 'not_empty', 'f': 0}},
      {{'c': 'all_bboxes_valid', 'f': CASE WHEN bad = n THEN 1 ELSE 0 END}}, {{'c': 'page_number_valid', 'f': outside}},
    {{'c': 'item_types', 'f': unk}}, {{'c': 'individual_bboxes', 'f': bad}}, {{'c': 'reading_order', 'f': o.f}}, {{'c': 'tables', 'f': tab}}, {{'c': 'captions', 'f': bare}}]) AS x FROM a JOIN o USING (doc_id))"""
_CRITICAL = "x.c IN ('page_count', 'not_empty', 'all_bboxes_valid')"


def _checked(spark: SparkSession, d: str) -> DataFrame:
    e = elements(spark, d)
    table = F.col("element_type") == "table"
    kind = F.when(F.col("ordinal") % 50 == 0, F.lit("title")).when(table, F.lit("table")).otherwise(F.lit("text"))
    items = e.select(
        "doc_id", "page_num", kind.alias("type"), (F.col("left") - 0.02).alias("left"), "top", "right", "bottom", (F.col("ordinal") % 7).alias("item_order"),
        F.when(table, F.col("ordinal") % 4).alias("row_count"), F.when(table, F.lit(2)).alias("col_count"), F.when(F.col("ordinal") % 2 == 0, F.lit("c")).alias("caption"),
    )
    pages = e.select("doc_id", "page_num").distinct().withColumns({"width": F.lit(0.8), "height": F.lit(0.85)})
    counted = F.when(F.col("doc_id").cast("int") % 3 == 0, 19).otherwise(20)
    documents = e.select("doc_id").distinct().select("doc_id", counted.alias("page_count"), F.lit("").alias("markdown"))
    return validation.checks(documents, items, pages)


@query(f"""
{WITH}, {_CHECKS}
SELECT doc_id, count(*) FILTER (WHERE x.f > 0 AND {_CRITICAL}) = 0 AS is_valid, count(*) AS n_checks,
  count(*) FILTER (WHERE x.f > 0 AND {_CRITICAL}) AS n_errors, count(*) FILTER (WHERE x.f > 0 AND NOT {_CRITICAL}) AS n_warnings
FROM checks GROUP BY 1
""")
def validation_report(spark, d):
    return validation.report(_checked(spark, d))


@query(f"{WITH}, {_CHECKS} SELECT doc_id, x.c AS check_name, CAST(x.f AS BIGINT) AS failures, x.f = 0 AS passed, CASE WHEN {_CRITICAL} THEN 'critical' ELSE 'warning' END AS severity FROM checks")
def validation_checks(spark, d):
    return _checked(spark, d).select("doc_id", "check_name", "failures", "passed", "severity")


@query(f"""
{WITH},
  b AS (SELECT doc_id, page_num, element_id, row_number() OVER (PARTITION BY doc_id ORDER BY page_num, element_id) AS k, count(*) OVER (PARTITION BY doc_id) AS n FROM el WHERE NOT {_VALID})
SELECT doc_id, max(n) AS failures, string_agg('page ' || page_num || ': ' || element_id, chr(10) ORDER BY k) || CASE
  WHEN max(n) > 20 THEN chr(10) || '… and ' || (max(n) - 20) || ' more' ELSE '' END AS details
FROM b WHERE k <= 20 GROUP BY 1
""")
def validation_details(spark, d):
    """The first twenty elements with a bad box of each document, and how many more there are."""
    e = elements(spark, d).withColumn("left", F.col("left") - 0.02).where(~validation.box_valid(F.lit(0.8), F.lit(0.85)))
    line = F.concat(F.lit("page "), F.col("page_num").cast("string"), F.lit(": "), F.col("element_id"))
    return validation.details(e.select("doc_id", line.alias("line"), F.struct("page_num", "element_id").alias("place")))


# --- chunks ------------------------------------------------------------------


@query("""WITH RECURSIVE p AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS ord FROM documents),
w AS (SELECT doc_id, ord, list_filter(regexp_split_to_array(line, '\\s+'), lambda x: x <> '') AS ws FROM p),
parts AS (SELECT doc_id, ord, unnest(range(0, len(ws), 300)) AS part, len(ws) AS n FROM w WHERE len(ws) > 0),
s AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY ord, part) AS i, least(300, n - part) AS n FROM parts),
f AS (SELECT doc_id, i, n AS run, 0 AS no, n FROM s WHERE i = 1 UNION ALL SELECT s.doc_id, s.i, CASE WHEN f.run + s.n > 300 THEN s.n
  ELSE f.run + s.n END, f.no + CASE WHEN f.run + s.n > 300 THEN 1 ELSE 0 END, s.n FROM f JOIN s ON s.doc_id = f.doc_id AND s.i = f.i + 1)
SELECT doc_id, CAST(no AS BIGINT) AS chunk_no, CAST(sum(n) AS BIGINT) AS token_count FROM f GROUP BY 1, 2""")
def chunk_pack(spark, d):
    p = read(spark, d, "documents").select(
        F.col("doc_id").alias("document"), F.col("lang").alias("heading"), F.posexplode(F.split("text", "\n", -1)).alias("ord", "text"),
    )
    return chunks.pack(p).select(F.col("document").alias("doc_id"), "chunk_no", "token_count")


def _chunked(spark: SparkSession, d: str) -> DataFrame:
    e = elements(spark, d)
    n = e.where("element_type = 'text_block'").groupBy(F.col("doc_id").alias("document")).agg(F.count("*").alias("n"))
    v = e.where("element_type IN ('image','chart')").select(
        F.col("doc_id").alias("document"), F.col("element_id").alias("self_ref"), "ordinal",
        F.when(F.col("ordinal") % 2 == 0, F.array(F.concat(F.lit("file:"), "element_id"))).alias("image_uri"), F.col("content").alias("caption"),
        F.lit("d").alias("description"),
    )
    return chunks.visual_chunks(v, n)


_VCHUNKS = """n AS (SELECT doc_id, count(*) AS n FROM el WHERE element_type = 'text_block' GROUP BY 1),
v AS (SELECT el.*, row_number() OVER (PARTITION BY doc_id ORDER BY ordinal) - 1 AS kk FROM el WHERE element_type IN ('image','chart')),
vc AS (SELECT v.doc_id, element_id, coalesce(content, '') AS content, coalesce(n.n, 0) + 2 * kk + e.d AS seq, e.d, ordinal FROM v LEFT JOIN n ON n.doc_id = v.doc_id, (VALUES (1), (2)) AS e(d))"""


@query(f"{WITH}, {_VCHUNKS} SELECT element_id AS self_ref, CAST(seq AS BIGINT) AS sequence_number, CASE d WHEN 1 THEN 'image' ELSE 'textual_description' END AS embedding_type, CASE d WHEN 1 THEN content ELSE concat('Image Caption: ', content, chr(10), 'Image Description: d') END AS chunk_text FROM vc")
def visual_chunks(spark, d):
    return _chunked(spark, d).select("self_ref", "sequence_number", "embedding_type", "chunk_text")


@query(f"{WITH}, {_VCHUNKS} SELECT CASE d WHEN 1 THEN 'image' ELSE 'textual_description' END AS embedding_type, CASE d WHEN 1 THEN concat('file:', element_id) ELSE concat('Image Caption: ', content, chr(10), 'Image Description: d') END AS content, CAST(seq AS BIGINT) AS chunk_index FROM vc WHERE d = 2 OR ordinal % 2 = 0")
def encode_items(spark, d):
    return vectors.encode_items(_chunked(spark, d)).select("embedding_type", "content", "chunk_index")


@query("SELECT CAST(d.doc_id AS STRING) AS chunk_id, e.label, round(CAST(e.embedding[1] AS DOUBLE), 4) AS first FROM documents d JOIN embeddings e ON e.vec_id = d.doc_id")
def attach_embeddings(spark, d):
    e = read(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("chunk_id"), "embedding", "label")
    c = read(spark, d, "documents").select(F.col("doc_id").cast("string").alias("chunk_id"), "text")
    return vectors.attach(c, e).join(e.select("chunk_id", "label"), "chunk_id").select(
        "chunk_id", "label", F.round(F.col("embedding")[0].cast("double"), 4).alias("first"),
    )


# --- documents ---------------------------------------------------------------


@query(f"SELECT doc_id, sha256(text) AS file_hash, {sql.uuid(ids.DOCUMENT, 'sha256(text)')} AS document_id FROM documents")
def doc_ingest_hash(spark, d):
    h = F.sha2(F.encode("text", "UTF-8"), 256)
    return read(spark, d, "documents").select("doc_id", h.alias("file_hash"), ids.document_id(h).alias("document_id"))


@query("SELECT sha256(text) AS file_hash, min(doc_id) AS doc_id, count(*) AS copies FROM documents GROUP BY 1")
def doc_dedup_exact(spark, d):
    return read(spark, d, "documents").groupBy(F.sha2(F.encode("text", "UTF-8"), 256).alias("file_hash")).agg(
        F.min("doc_id").alias("doc_id"), F.count("*").alias("copies"),
    )


@query("SELECT concat(conv_id, ':', turn) AS source_id, concat(conv_id, ':', nxt) AS target_id FROM (SELECT *, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations) AS c WHERE nxt IS NOT NULL")
def conversation_turn_edges(spark, d):
    c = read(spark, d, "conversations").select(
        F.col("conv_id").cast("string").alias("doc_id"), F.lit(1).alias("page_num"), F.col("turn").alias("reading_order"), F.lit(0.0).alias("top"),
        F.lit(0.0).alias("left"), F.concat_ws(":", "conv_id", "turn").alias("element_id"),
    )
    return graph.sequential(c).where("relationship_type = 'precedes'").select("source_id", "target_id")


@query("SELECT date_trunc('day', ts) AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2")
def events_tumbling(spark, d):
    return incremental.tumbling(read(spark, d, "events")).select(
        F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 2).alias("total"),
    )


@query("""WITH s AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
g AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM s) SELECT user_id, min(ts) AS start, count(*) AS n FROM g GROUP BY user_id, k""")
def events_sessions(spark, d):
    return incremental.sessions(read(spark, d, "events")).select("user_id", F.col("start").cast("timestamp_ntz").alias("start"), "n")


# --- the star schema ---------------------------------------------------------


@query("""SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue, count(*) AS n FROM lineitem WHERE l_shipdate <= TIMESTAMP '1998-09-02' GROUP BY 1, 2""")
def pricing_summary(spark, d):
    li = read(spark, d, "lineitem").where("l_shipdate <= TIMESTAMP_NTZ '1998-09-02 00:00:00'")
    return li.groupBy("l_returnflag", "l_linestatus").agg(
        F.round(F.sum("l_quantity"), 2).alias("sum_qty"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"),
        F.count("*").alias("n"),
    )


@query("""SELECT r_name, n_name, round(sum(o_totalprice), 2) AS total, count(*) AS orders FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ROLLUP (r_name, n_name)""")
def orders_rollup(spark, d):
    o = read(spark, d, "orders").join(read(spark, d, "customer"), F.expr("o_custkey = c_custkey")).join(
        read(spark, d, "nation"), F.expr("c_nationkey = n_nationkey"),
    ).join(read(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
    return o.rollup("r_name", "n_name").agg(F.round(F.sum("o_totalprice"), 2).alias("total"), F.count("*").alias("orders"))
