import datetime
import random
import re

import pandas as pd
import pytest
from pyspark.sql import functions as F

from foliate.operators import chunks, elements, graph, hierarchy, normalise, projection, tables, validation, vectors
from foliate.plans import converted, derived
from foliate.sources import readers, sinks
from foliate.streaming import incremental

ELEMENT = "doc_id string, element_id string, page_num int, reading_order int, section_path string, element_type string, content string, left double, top double, right double, bottom double, ordinal int"


def make(spark, rows):
    full = [("d", f"e{i}", r.get("page", 1), r.get("order", i), r.get("path", ""), r.get("type", "text_block"), r.get("text", ""), *r.get("box", (0.0, 0.0, 0.3, 0.1)), i) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, ELEMENT)


def pairs(df):
    return sorted((r["source_id"], r["target_id"], r["relationship_type"]) for r in df.collect())


def test_reading_order_puts_own_orders_first(spark):
    rows = [("d", 1, 0, None, 0.5, 0.1, 0.6, 0.2), ("d", 1, 1, 7, 0.0, 0.9, 0.1, 1.0), ("d", 1, 2, None, 0.0, 0.5, 0.1, 0.6), ("d", 1, 3, None, 0.0, 0.1, 0.1, 0.2)]
    df = spark.createDataFrame(rows, "doc_id string, page_num int, ordinal int, item_order int, left double, top double, right double, bottom double")
    got = {r["ordinal"]: r["reading_order"] for r in elements.reading_order(df).collect()}
    assert got == {1: 0, 3: 1, 2: 2, 0: 3}


def test_boxes_and_types(spark):
    items = spark.createDataFrame(
        [
            ("d", 1, 0, None, "Paragraph", "x", 10.0, 20.0, 30.0, 40.0), ("d", 2, 1, None, "odd", "y", 0.1, 0.1, 0.2, 0.2),
            ("d", 2, 2, None, "table", "z", 5.0, 5.0, 6.0, 6.0), ("d", 0, 3, None, "table", "off", 0.1, 0.1, 0.2, 0.2),
        ],
        "doc_id string, page_num int, ordinal int, item_order int, label string, content string, left double, top double, right double, bottom double",
    )
    pages = spark.createDataFrame([("d", 1, 100.0, 200.0)], "doc_id string, page_num int, width double, height double")
    got = {r["content"]: (r["element_type"], r["left"], r["bottom"]) for r in elements.elements(items, pages).collect()}
    assert got == {"x": ("text_block", 0.1, 0.2), "y": ("text_block", 0.1, 0.2), "z": ("table", 0.0, 0.0)}


def test_sequential_and_dedup(spark):
    assert pairs(graph.sequential(make(spark, [{}, {}, {"page": 2}]))) == [("e0", "e1", "precedes"), ("e1", "e0", "follows")]
    rows = [("a", "b", "follows"), ("a", "b", "follows"), ("a", "a", "follows"), ("b", "c", "precedes"), ("b", "c", "nearby"), ("c", "b", "nearby"), ("a", "a", "same_section_as")]
    df = spark.createDataFrame([("d", *r, i) for i, r in enumerate(rows)], "doc_id string, source_id string, target_id string, relationship_type string, rank int")
    assert pairs(graph.deduplicated(df)) == [("a", "a", "same_section_as"), ("a", "b", "follows"), ("b", "c", "nearby"), ("b", "c", "precedes")]


def test_near_pairs_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [{"box": (x := rng.random(), y := rng.random(), x + rng.random() / 5, y + rng.random() / 5), "page": rng.randint(1, 2)} for _ in range(120)]
    centre = lambda r: ((r["box"][0] + r["box"][2]) / 2, (r["box"][1] + r["box"][3]) / 2)
    want = {(f"e{i}", f"e{j}") for i, a in enumerate(rows) for j, b in enumerate(rows) if i < j and a["page"] == b["page"] and ((centre(a)[0] - centre(b)[0]) ** 2 + (centre(a)[1] - centre(b)[1]) ** 2) ** 0.5 <= 0.08}
    got = {(r["source_id"], r["target_id"]) for r in graph.proximity(make(spark, rows)).collect()}
    assert got == want and len(got) == graph.proximity(make(spark, rows)).count()


def test_references_and_describes(spark):
    e = make(
        spark,
        [
            {"text": "See Table 1.", "path": "s"}, {"type": "table", "text": "Table 1: x", "path": "s"},
            {"type": "image", "text": "Fig. 2a", "path": "t"}, {"type": "caption", "text": "Figure 2A and Table 1"},
        ],
    )
    assert pairs(graph.references(e)) == [("e0", "e1", "refers_to"), ("e3", "e1", "refers_to"), ("e3", "e2", "refers_to")]
    assert pairs(graph.describes(e)) == [("e0", "e1", "describes")]
    assert [tuple(r) for r in graph.summary(graph.all_edges(e)).collect()][0][1] >= 3


def test_hierarchy(spark):
    e = make(
        spark,
        [{"text": "Abstract"}, {"text": "words"}, {"text": "1. Introduction"}, {"text": "words"}, {"type": "caption", "text": "x"}, {"text": "Conclusion"}, {"text": "1.1 Back"}],
    ).withColumns({"level": F.lit(None).cast("int"), "section_number": F.lit(None).cast("string")})
    got = {r["element_id"]: r["section_path"] for r in hierarchy.assign_paths(e).collect()}
    assert [got[f"e{i}"] for i in range(7)] == ["0.1", "0.1", "1", "1", "", "0.2", "1.1"]
    edges = hierarchy.contains(e).collect()
    assert sum(r["source_id"] == "d" for r in edges) == 3 and any(r["target_id"] == "e1" for r in edges)


def test_hierarchy_paths_number_after_what_came_before():
    found = hierarchy.paths(pd.DataFrame({"level": [1, 2, 2, 2, 1], "number": ["1", None, "1.4", None, None]}))
    assert found["path"].tolist() == ["1", "1.1", "1.4", "1.5", "0.1"] and found["parent"].tolist() == [-1, 0, 0, 0, -1]


@pytest.mark.parametrize(
    ("kind", "source"),
    [
        ("markdown", "| H1 | H2 |\n|--|--|\n| A | B |\n| C | D |"), ("content", "H1\tH2\nA\tB\nC\tD"), ("content", "H1  H2\nA  B\nC  D"),
        ("html", "<table><tr><th>H1</th><th>H2</th></tr><tr><td>A</td><td>B</td></tr><tr><td>C<td>D</td></tr></table>"),
        ("json_data", '{"rows": [{"H1": "A", "H2": "B"}, {"H1": "C", "H2": "D"}]}'),
    ],
)
def test_tables(spark, kind, source):
    if kind == "html":
        source = source.replace("C<td>", "C</td><td>")
    r = tables.enrich(spark.createDataFrame([(source,)], f"{kind} string").withColumn("summary", F.lit(""))).first()
    assert (r["headers"], r["rows"], r["row_count"], r["col_count"]) == (["H1", "H2"], [["A", "B"], ["C", "D"]], 2, 2)
    assert r["summary"] == "Table with 2 row(s) and 2 column(s), headers: [H1, H2]" and r["markdown"].startswith("| H1 | H2 |\n| --- | --- |\n| A | B |")


def test_tables_without_source_and_numeric_rows(spark):
    df = spark.createDataFrame([(None,), ("1\t2\n3\t4",)], "content string").withColumn("summary", F.lit("Old"))
    a, b = tables.enrich(df).collect()
    assert (a["rows"], a["col_count"], a["markdown"], a["html"]) == ([], 0, "", "") and b["headers"] == ["Column 1", "Column 2"] and b["summary"].startswith("Old. Table with 2")


def test_spanning(spark):
    t = make(
        spark, [{"type": "table", "page": p, "path": "3.1"} for p in (1, 2, 4, 8)]
    ).withColumns({"col_count": F.lit(3), "headers": F.array(F.lit("A"), F.lit("B"), F.lit("C"))})
    got = {r["element_id"]: (r["is_spanning"], r["span_group_id"]) for r in tables.spanning(t).collect()}
    assert got["e0"] == got["e1"] == got["e2"] and got["e0"][0] and got["e3"] == (False, None)


def test_validation(spark):
    documents = spark.createDataFrame([("a", 2, ""), ("b", 3, "")], "doc_id string, page_count int, markdown string")
    pages = spark.createDataFrame([("a", 1, 10.0, 10.0), ("a", 2, 10.0, 10.0)], "doc_id string, page_num int, width double, height double")
    items = spark.createDataFrame(
        [("a", 1, "table", 1.0, 1.0, 2.0, 2.0, 0, 3, 4, "c"), ("a", 2, "text", 0.0, 0.0, 11.0, 1.0, 0, None, None, None)],
        "doc_id string, page_num int, type string, left double, top double, right double, bottom double, item_order int, row_count int, col_count int, caption string",
    )
    found = validation.checks(documents, items, pages)
    assert found.count() == 18
    got = {r["doc_id"]: (r["is_valid"], r["n_errors"], r["n_warnings"]) for r in validation.report(found).collect()}
    assert got == {"a": (True, 0, 1), "b": (False, 2, 0)}


def test_vectors(spark):
    v = spark.createDataFrame(
        [(0, [1.0, 0.0], 1), (1, [0.7, 0.3], 2), (2, [0.9, 0.1], 3), (3, [0.5, 0.5], 4), (4, [0.0, 0.0], 5), (5, None, 6)],
        "id long, embedding array<double>, g int",
    )
    got = {r["id"]: r["relates_to"] for r in vectors.relates_to(v, 3, 0.4).collect()}
    assert got[0] == [2, 1, 3] and got[4] == [] and got[5] == []
    assert vectors.top_k(v, 3, 0.4, blocks=3).count() == vectors.top_k(v, 3, 0.4).count()
    same = v.withColumn("g", F.lit(1))
    assert vectors.top_k(same, 3, 0.4, "g").count() == 0
    assert [r["id"] for r in vectors.search(v.where("id < 5"), [2.0, 0.0], 2).collect()] == [0, 2]
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "d")], "source_id string, target_id string")
    assert {tuple(r) for r in vectors.expand(spark.createDataFrame([("a",)], "id string"), edges, 2).collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_encoding(spark):
    items = spark.createDataFrame(
        [("1", "text", "a b", [""], 0), ("2", "image", "c", ["u"], 1), ("3", "image", "c", [""], 2), ("4", "odd", "x", None, 3), ("5", "text", None, None, 4)],
        "chunk_id string, embedding_type string, chunk_text string, image_uri array<string>, sequence_number int",
    )
    found = vectors.encode_items(items)
    assert {r["chunk_id"]: r["content"] for r in found.collect()} == {"1": "a b", "2": "u"}
    encoded = vectors.encode_batch(found, vectors.hashing_encoder(8), 8)
    assert all(abs(sum(x * x for x in r["embedding"]) - 1) < 1e-9 for r in encoded.collect())

    def broken(texts):
        raise ValueError

    assert {tuple(r["embedding"]) for r in vectors.encode_batch(found, broken, 2).collect()} == {(0.0, 0.0)}


def test_all_edges_keeps_edges_where_elements_are(spark):
    row = lambda i, kind, content: ("d", f"e{i}", 1, i, "s", kind, content, 0.1, 0.1, 0.1, 0.1, i)
    rows = [row(0, "text_block", "See Table 1."), row(1, "table", "Table 1: x"), row(2, "footnote", None)]
    columns = "doc_id string, element_id string, page_num int, reading_order int, section_path string, element_type string, content string, left double, top double, right double, bottom double, ordinal int"
    e = spark.createDataFrame(rows, columns).repartition(3, "doc_id")
    made = graph.all_edges(e)
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(doc_id") == plan.count("Exchange ") and "Join" not in plan and plan.count("Exchange ") <= 6
    told = [("d", 1, "e1", "e0", "nearby", 7.0, "told"), ("d", 1, "e9", "e9", "contains", 1.0, None), ("d", 1, "e9", "e1", "contains", 1.0, None)]
    existing = spark.createDataFrame(told, "doc_id string, page_num int, source_id string, target_id string, relationship_type string, weight double, detail string")
    key = lambda df: sorted((r["source_id"], r["target_id"], r["relationship_type"], r["weight"]) for r in df.collect())
    both = key(graph.all_edges(e, existing))
    assert ("e1", "e0", "nearby", 7.0) in both and ("e1", "e9", "belongs_to", 1.0) in both and len(both) == len(key(made)) + 2
    assert key(graph.all_edges(e, existing.where("weight < 2"))) == sorted(key(made) + [("e1", "e9", "belongs_to", 1.0), ("e9", "e1", "contains", 1.0)])


def test_siblings(spark):
    refs = spark.createDataFrame([(0, "t0"), (0, "p0"), (1, "p0"), (2, "t1"), (3, None), (4, None)], "item_id int, ref string")
    assert {tuple(r) for r in vectors.siblings(refs).collect()} == {(0, 1), (1, 0)}


def test_siblings_are_not_shuffled_as_pairs(spark):
    rows = [(i, f"r{i % 2}") for i in range(40)] + [(i, f"s{i % 3}") for i in range(30)] + [(5, "s2"), (41, "alone"), (None, "r0")]
    refs = spark.createDataFrame(rows, "item_id int, ref string")
    found = vectors.siblings(refs, block=4)
    own = {i: {r for j, r in rows if j == i} for i in range(42)}
    got = [tuple(r) for r in found.collect()]
    assert sorted(got) == sorted((a, b) for a in own for b in own if a != b and own[a] & own[b])
    top = found._jdf.queryExecution().sparkPlan().toString()
    assert "Aggregate" not in top.split("SortMergeJoin")[0]


def test_chunks(spark):
    p = spark.createDataFrame(
        [("d", "h", 0, "a b c"), ("d", "h", 1, "d e"), ("d", "h", 2, "f g h i j k l"), ("d", "h", 3, " ")],
        "document string, heading string, ord int, text string",
    )
    got = sorted((r["chunk_no"], r["chunk_text"], r["token_count"]) for r in chunks.pack(p, 5).collect())
    assert got == [(0, "a b c\nd e", 5), (1, "f g h i j", 5), (2, "k l", 2)]


def test_cross_references(spark):
    c = spark.createDataFrame(
        [("d", "A", "As Figure 1 shows, and Fig. 1"), ("d", "B", "Figure 1 itself"), ("d", "C", "Table IV is absent")],
        "document string, chunk_id string, chunk_text string",
    )
    index = spark.createDataFrame([("d", "figure 1", "B")], "document string, label string, chunk_id string")
    assert {r["chunk_id"]: r["refers_to"] for r in chunks.cross_references(c, index).collect()} == {"A": ["B"], "B": [], "C": []}


def test_ingest_and_state(spark, tmp_path):
    for name, content in (("a.pdf", b"1"), ("b.PDF", b"1"), ("c.pdf", b"2"), ("d.txt", b"3")):
        (tmp_path / name).write_bytes(content)
    found = readers.ingest(spark, str(tmp_path))
    assert sorted(r["title"] for r in found.collect()) == ["a", "c"]
    assert readers.ingest(spark, str(tmp_path), known=found).count() == 0
    events = spark.createDataFrame([("x", 1, "ingested", None), ("x", 2, "extracted", "ok"), ("x", 3, "ingested", None)], "doc_id string, ts int, status string, note string")
    assert tuple(sinks.manifests(events).first()) == ("x", 3, "ingested", "ok")


def test_converter_failures_are_rows(spark):
    files = spark.createDataFrame([("a", b"1"), ("b", b"x")], "doc_id string, content binary")
    got = {r["doc_id"]: (r["n"], r["error"] is not None) for r in readers.convert(files, lambda c: [{"n": int(c)}], "n int").collect()}
    assert got == {"a": (1, False), "b": (None, True)}


def test_stream(spark, data, tmp_path):
    source = tmp_path / "in"
    spark.read.parquet(f"{data}/events.parquet").write.parquet(str(source))
    schema = spark.read.parquet(str(source)).schema.simpleString()[7:-1].replace(":", " ")
    stream = incremental.once(incremental.files(spark, str(source), schema), "event_id", "ts", "365 days")
    q = incremental.run(stream, incremental.tumbling, str(tmp_path / "out"), str(tmp_path / "cp"))
    assert q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).agg(F.sum("n")).first()[0] == spark.read.parquet(str(source)).count()


def test_boxes_that_lack_a_side_are_zero(spark):
    items = spark.createDataFrame(
        [("d", 1, None, 1.0, 2.0, 3.0), ("d", 1, None, None, None, None), ("d", 2, None, 0.1, 0.2, 0.3)],
        "doc_id string, page_num int, left double, top double, right double, bottom double",
    )
    pages = spark.createDataFrame([("d", 1, 10.0, 10.0)], "doc_id string, page_num int, width double, height double")
    assert {tuple(r)[2:] for r in elements.normalise_boxes(items, pages).collect()} == {(0.0, 0.0, 0.0, 0.0)}


def test_visual_chunks_of_documents_without_text(spark):
    v = spark.createDataFrame(
        [("a", "p", 0, "c"), ("b", "q", 0, None)], "document string, self_ref string, ordinal int, caption string",
    ).withColumns({"image_uri": F.lit(None).cast("array<string>"), "description": F.lit("d")})
    n = spark.createDataFrame([("a", 5)], "document string, n int")
    assert sorted((r["document"], r["sequence_number"]) for r in chunks.visual_chunks(v, n).collect()) == [("a", 6), ("a", 7), ("b", 1), ("b", 2)]


def normalised(spark, *sources):
    return normalise.normalise(spark.createDataFrame([(f"d{i}", s) for i, s in enumerate(sources)], "doc_id string, document string"))


def test_normalise_reads_pages_in_both_forms_and_every_container(spark):
    listed = """{"pages": [{"size": {"width": 100, "height": 200}, "texts": [{"label": "Title", "text": "T", "bbox": [10, 20, 30, 40]}, {"type": "TEXT", "orig": ["a", "", "b"], "order": 7}],
      "tables": [{"kind": "table", "content": null, "rows": "3", "cols": 2, "headers": ["x", 1], "data": [[1]], "caption": "C", "prov": [{"bbox": {"l": 50, "t": 60, "r": 70, "b": 80}}],
                  "children": [{"label": "list", "items": ["p", "q"], "ordered": "yes"}, {"$ref": "#/x"}]}]}, null, {"page_no": 9, "items": [{"text": "moved", "page": 3}, null]}], "figures": [{"label": "figure", "page": 1, "rect": [[1, 2, 3, 4]]}, {"label": "text"}]}"""
    keyed = """{"pages": {"2": {"items": [{"label": "text", "text": "x"}]}, "z": {"items": [{"label": "text", "text": "lost"}]}}}"""
    found, pages, _ = normalised(spark, listed, keyed, "no json", None)
    rows = {(r["doc_id"], r["page_num"], r["reading_order"]): r for r in found.collect()}
    assert {k: (r["element_type"], r["content"]) for k, r in rows.items()} == {
        ("d0", 1, 0): ("text_block", "a b"), ("d0", 1, 1): ("list_block", ""), ("d0", 1, 2): ("image", ""), ("d0", 1, 3): ("section_header", "T"), ("d0", 1, 4): ("table", ""),
        ("d0", 3, 0): ("text_block", "moved"), ("d1", 2, 0): ("text_block", "x"),
    }
    table, title = rows["d0", 1, 4], rows["d0", 1, 3]
    assert (
        table["row_count"], table["col_count"], table["headers"], table["summary"], table["json_data"],
    ) == (3, 2, ["x", "1"], "C", '{"rows":[[1]]}') and (table["left"], table["bottom"]) == (0.5, 0.4)
    assert (title["left"], title["bottom"], title["level"]) == (0.1, 0.2, 1) and rows["d0", 1, 1]["items"] == ["p", "q"] and rows["d0", 1, 1]["ordered"] and (
        rows["d0", 1, 2]["left"], rows["d0", 1, 2]["bottom"],
    ) == (0.01, 0.02)
    assert sorted((r["doc_id"], r["page_num"], len(r["element_ids"])) for r in pages.collect()) == [("d0", 1, 5), ("d0", 2, 0), ("d0", 3, 1), ("d1", 0, 0), ("d1", 2, 1)]


def test_normalise_keeps_documents_where_they_are(spark):
    twice = """{"pages": {"1": {"size": {"width": 10, "height": 10}, "texts": [{"label": "caption", "text": "a", "bbox": [0, 5, 1, 5]}, {"label": "table", "bbox": [0, 4, 1, 4]}]}, "01": {"items": [null]}}}"""
    docs = spark.createDataFrame([("d", twice), ("e", twice)], "doc_id string, document string")
    for made, n in zip(normalise.normalise(docs.repartition(3, "doc_id")), (4, 2, 4), strict=True):
        plan = made._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and "Join" not in plan and "ExistingRDD" in plan
        assert made.count() == n


def test_normalise_links_sorts_no_edges(spark):
    docs = spark.createDataFrame([("d", '{"pages": [{"texts": [{"text": "a"}, {"text": "b"}]}]}')], "doc_id string, document string")
    links = normalise.normalise(docs)[2]
    # sorted are items by order, caption text, height and band, but not the edges, which are many more
    assert links._jdf.queryExecution().executedPlan().toString().count("Sort [") == 4 and links.count() == 1


def test_documents_are_dealt_to_tasks_of_bounded_rows(spark, data, monkeypatch):
    usual = converted.documents(spark, data)
    monkeypatch.setattr(converted, "ROWS", 600)
    many = converted.documents(spark, data)
    parts = lambda df: [int(n) for n in re.findall(r"Exchange hashpartitioning\(doc_id\S*, (\d+)\)", df._jdf.queryExecution().executedPlan().toString())]
    assert parts(usual) == [4] and parts(many) == [spark.read.parquet(f"{data}/lineitem.parquet").count() // 600 + 1]
    assert sorted(many.collect()) == sorted(usual.collect())


def test_packed_rows_come_back_to_the_bit(spark, data):
    usual = {"l_orderkey": 7, "l_partkey": 8, "l_suppkey": 9, "l_linenumber": 1, "l_extendedprice": 1234.56, "l_quantity": 50.0, "l_discount": 0.0, "l_tax": 0.08}
    at = datetime.datetime(1996, 9, 13)
    edges = [{"l_orderkey": n} for n in (0, 2**32 - 1, 2**32, 2**63 - 1, -1, None)] + [{"l_partkey": n} for n in (2**27 - 1, 2**27, -(2**63), None)] + [
        {"l_linenumber": n} for n in (15, 16, -1, None)
    ] + [{c: x} for c in ("l_extendedprice", "l_quantity", "l_discount", "l_tax") for x in (
        0.0, -0.0, 0.31, 0.32, 0.1 + 0.2, 1.27, 1.28, 127.0, 128.0, 1342177.27, 1342177.28, 1e300, -1.0, 5e-324, float("nan"), float("inf"), -float("inf"), None,
    )] + [{"l_shipdate": x} for x in (
        None, datetime.datetime(1970, 1, 1), datetime.datetime(1969, 12, 31), datetime.datetime(1996, 9, 13, 0, 0, 0, 1), datetime.datetime(2328, 11, 10),
        datetime.datetime(2328, 11, 11), datetime.datetime(9999, 12, 31),
    )] + [{"l_suppkey": n} for n in (None, -1, 2**63 - 1)]
    rows = [usual | {"l_shipdate": at} | e for e in [{}, *edges]]
    schema = spark.read.parquet(f"{data}/lineitem.parquet").select(*usual, "l_shipdate").schema
    lines = spark.createDataFrame([tuple(r[c] for c in schema.names) for r in rows], schema)
    text = [f"CAST({c} AS STRING) AS {c}" for c in schema.names]
    back = derived.unpacked(derived.packed(lines))
    assert back.select(*schema.names).dtypes == lines.dtypes
    assert [tuple(r) for r in back.selectExpr(*text).collect()] == [tuple(r) for r in lines.selectExpr(*text).collect()]
    whole = derived.packed(spark.read.parquet(f"{data}/lineitem.parquet"))
    assert whole.where("rest IS NOT NULL").count() == 0 and whole.columns == ["doc_id", "w0", "w1", "rest"]


def test_documents_are_dealt_packed(spark, data):
    # a row's numbers are two, and an item's JSON text is made at once; without that, 60 copies of sf0.1 take over 3 times their size on disk
    made = converted.documents(spark, data)._jdf.queryExecution().executedPlan().toString()
    below = made[made.index("Exchange hashpartitioning(doc_id") :].splitlines()[1]
    assert "AS w0" in below and "AS w1" in below and "AS l_" not in below


def test_normalise_pages_reads_what_it_needs(spark, monkeypatch):
    read, items = [], normalise.items
    monkeypatch.setattr(normalise, "items", lambda *a, **b: read.append(items(*a, **b)) or read[-1])
    docs = spark.createDataFrame([("d", '{"pages": [{"texts": [{"text": "a", "label": "table", "markdown": "m"}]}]}')], "doc_id string, document string")
    pages = normalise.normalise(docs)[1]
    assert ["markdown" in r.schema["item"].dataType.names for r in read] == [True, False] and [len(r["element_ids"]) for r in pages.collect()] == [1]


def test_normalise_reads_fields_of_any_type(spark):
    source = """{"pages": [{"size": {"width": 10, "height": 10}, "items": [7, "word", null, [], {"text": {"a": 1}, "page_no": "x", "bbox": "none", "rect": [[1, 2, 3, 4]], "prov": 5},
      {"text": ["p", 1, null], "label": 3, "bounds": {"left": 1, "t": 2, "r": 3, "b": 4}, "prov": [{"bbox": {"l": "1", "t": 2.5, "r": 3, "b": "four"}, "bbox_normalized": [0, 1, 2, 3]}]}]}]}"""
    found, pages, _ = normalised(spark, source)
    got = sorted((r["content"], *(round(r[b], 3) for b in normalise.BOX)) for r in found.collect())
    assert got == [("", 0.0, 0.0, 0.0, 0.0)] * 3 + [("p 1", 0.0, 0.1, 0.2, 0.3), ('{"a":1}', 0.1, 0.2, 0.3, 0.4)]
    assert [len(r["element_ids"]) for r in pages.collect()] == [5]


def test_normalise_links_captions(spark):
    parent = "0123456789ABCDEF0123456789abcdef"
    source = f"""{{"pages": [{{"texts": [{{"label": "caption", "text": " A cap", "bbox": [0, 0.5, 0.2, 0.5], "order": 1}}, {{"label": "caption", "text": "B cap", "bbox": [0, 0.6, 0.2, 0.6], "order": 2}},
      {{"label": "text", "text": "A cap ", "parent_ref": "{{{parent}}}", "bbox": [0.9, 0.9, 0.9, 0.9]}}], "tables": [{{"label": "table", "bbox": [0, 0.4, 0.2, 0.4], "order": 0}}]}}]}}"""
    found, _, links = normalised(spark, source)
    ids = {r["content"]: r["element_id"] for r in found.collect()}
    usual = "01234567-89ab-cdef-0123-456789abcdef"
    got = {(r["source_id"], r["target_id"], r["relationship_type"]) for r in links.collect()}
    assert {(usual, ids[" A cap"], "has_caption"), (ids[" A cap"], usual, "describes"), (ids[""], ids["B cap"], "has_caption"), (ids["B cap"], ids[""], "describes")} <= got
    again = normalise.merged(links, links)
    assert again.count() == links.count() and again.select("relationship_id").distinct().count() == links.count()


def test_tables_of_lists_and_columns(spark):
    cases = {
        '[["a", "b"], ["1", null]]': ([], [["a", "b"], ["1", ""]]), '{"data": [{"k": 1, "l": null}, {"l": 2}]}': (["k", "l"], [["1", ""], ["", "2"]]),
        '{"c": [1, 2], "d": ["x"], "e": "no"}': (["c", "d", "e"], [["1", "x", ""], ["2", "", ""]]), '{"c": []}': None, "{}": None, "x": None,
        None: None,
    }
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cases)], "i int, c string").select("i", tables.from_json(F.col("c")).alias("t"))
    assert [(r["t"]["headers"], r["t"]["rows"]) if r["t"] else None for r in df.orderBy("i").collect()] == list(cases.values())


def test_chunk_metadata(spark):
    source = """{"origin": {"filename": "f.pdf", "mimetype": "m", "binary_hash": 7}, "texts": [{"self_ref": "#/t/0", "text": "Figure 2: sea"}, {"self_ref": "#/t/1", "text": "plain"}],
      "pictures": [{"self_ref": "#/p/0", "label": "picture", "image": {"uri": "u"}, "captions": [{"cref": "#/t/0"}], "children": [{"cref": "#/t/1"}], "prov": [{"page_no": 3}, {"page_no": 2}, {}]}, {"self_ref": "#/p/1", "label": "chart"}],
      "tables": [{"self_ref": "#/b/0", "label": "table", "children": [{"$ref": "#/t/1"}]}, {"self_ref": "#/b/1", "label": "table", "captions": [{"cref": "#/none"}]}]}"""
    docs = spark.createDataFrame([("x", source)], "document string, json string")

    def chunker(json_text):
        item = lambda ref, label, pages: {"self_ref": ref, "label": label, "pages": pages}
        return [
            {
                "sequence_number": 0, "chunk_text": "one two", "section_headings": ["H", "S"],
                "doc_items": [item("#/t/1", "text", [2, 1]), item("#/p/0", "picture", [2]), item("#/p/9", "picture", [])],
            },
            {"sequence_number": 1, "chunk_text": "three", "section_headings": None, "doc_items": [item("#/b/0", "table", None), item("#/p/0", "picture", [3])]},
        ]

    def describer(uri, caption):
        if uri != "u":
            raise ValueError(uri)
        return "told", ["k"]

    made = projection.chunk(docs, chunker)
    found = projection.chunk_metadata(docs.select("document", normalise.document(F.col("json")).alias("v")), made, describer)
    rows = {r["sequence_number"]: r for r in found.collect()}
    assert sorted(rows) == [0, 1, 3, 4, 5, 6, 7, 8]
    a, b, p, told = rows[0], rows[1], rows[3], rows[4]
    assert (a["chunk_types"], a["page_numbers"], a["section_path"], a["token_count"]) == (["text", "picture", "picture"], [1, 2], "H > S", 2)
    assert (
        a["image_type"], a["image_uri"], a["caption_text"], a["caption_number"],
    ) == (["picture"], ["u"], ["Figure 2: sea"], ["figure 2"]) and (b["image_type"], b["caption_text"]) == (["table", "picture"], ["plain", "Figure 2: sea"])
    assert (
        p["embedding_type"], p["chunk_text"], p["section_headings"], p["page_numbers"],
    ) == ("image", "Figure 2: sea", ["H", "S"], [2, 3]) and told["chunk_text"] == "Image Caption: Figure 2: sea\nImage Description: told\nKeywords: ['k']"
    assert rows[6]["chunk_text"] == "" and rows[5]["caption_text"] == ["plain"] and rows[7]["caption_text"] == [""] and rows[7]["image_uri"] == ["None"]
    counts = projection.populated(found, "image_uri", "section_headings").first()
    assert (counts["image_uri_filled"], counts["section_headings_filled"], counts["image_uri_longest"]) == (8, 3, 2)


def test_describer_failures_are_empty(spark):
    v = spark.createDataFrame([("d", "a", "u", "c"), ("d", "b", None, "c")], "document string, self_ref string, image_uri string, caption string")

    def fails(uri, caption):
        raise ValueError

    assert {r["description"] for r in projection.describe(v, fails, tasks=2).collect()} == {""}


def test_similar_pairs_and_queries_equal_brute_force(spark):
    import numpy as np

    rng = np.random.default_rng(3)
    m = rng.normal(size=(150, 8))
    m[5] = m[7]
    rows = [(int(i) * 3 % 457, [float(x) for x in v], int(i % 9)) for i, v in enumerate(m)]
    v = spark.createDataFrame([*rows, (9999, None, 0)], "id long, embedding array<double>, g int")
    unit = m / np.linalg.norm(m, axis=1, keepdims=True)
    score = np.round(unit @ unit.T, 12)
    ids = [r[0] for r in rows]
    want = {(min(ids[i], ids[j]), max(ids[i], ids[j])) for i in range(150) for j in range(i) if score[i, j] >= 0.6 and rows[i][2] != rows[j][2]}
    for blocks in (1, 4):
        got = [(r["a"], r["b"]) for r in vectors.similar_pairs(v, 0.6, "g", blocks).collect()]
        assert set(got) == want and len(got) == len(want)
        top = {(r["a"], r["rank"]): r["b"] for r in vectors.top_k(v, 3, 0.2, blocks=blocks).collect()}
        best = {
            (ids[i], k + 1): ids[j] for i in range(150) for k,
            j in enumerate(sorted((j for j in range(150) if j != i and score[i, j] >= 0.2), key=lambda j: (-score[i, j], ids[j]))[:3])
        }
        assert top == best
    asked = v.where("id % 50 = 0")
    exact = {(r["a"], r["b"]) for r in vectors.top_k(v, 5, -1.0, queries=asked).collect()}
    assert exact == {(ids[i], ids[j]) for i in range(150) if ids[i] % 50 == 0 for j in sorted((j for j in range(150) if j != i), key=lambda j: (-score[i, j], ids[j]))[:5]}
    whole = vectors.centres(v)
    assert {(r["a"], r["b"]) for r in vectors.nearest(v, asked, 5, probes=len(whole), index=whole).collect()} == exact


def test_coarse_index_recall(spark, data):
    v = spark.read.parquet(f"{data}/embeddings.parquet").selectExpr("vec_id AS id", "embedding")
    asked = v.where("id % 50 = 0")
    exact = {(r["a"], r["b"]) for r in vectors.top_k(v, 10, -1.0, queries=asked).collect()}
    got = {(r["a"], r["b"]) for r in vectors.nearest(v, asked, 10).collect()}
    assert len(exact & got) / len(exact) >= 0.9


def test_small_parts(spark, tmp_path):
    e = make(spark, [{"type": "caption", "text": "c"}, {"type": "table", "text": "t"}]).withColumn("parent_element_id", F.when(F.col("element_type") == "caption", F.lit("e1")))
    assert pairs(graph.captions(e)) == [("e1", "e0", "has_caption")]
    assert pairs(graph.caption_links(e)) == [("e0", "e1", "describes"), ("e1", "e0", "has_caption")]
    both = spark.createDataFrame(
        [("d", 1, "b", "a", "nearby", 1.0, None), ("d", 1, "a", "b", "nearby", 1.0, None)],
        "doc_id string, page_num int, source_id string, target_id string, relationship_type string, weight double, detail string",
    )
    assert pairs(graph.undirected(both)) == [("a", "b", "nearby")]
    twice = make(spark, [{"text": "old"}, {"text": "new"}]).withColumn("element_id", F.lit("e"))
    assert elements.latest(twice).first()["content"] == "new"
    got = [r[0] for r in spark.createDataFrame([("H", "b"), ("", "b"), (None, "b")], "h string, t string").select(chunks.contextualise(F.col("h"), F.col("t"))).collect()]
    assert got == ["H\nb", "b", "b"]


def test_sources_and_sinks(spark, tmp_path):
    docs = spark.createDataFrame([("a",), ("b",)], "doc_id string")
    todo, skipped = sinks.extraction_state(docs, docs.where("doc_id = 'a'"))
    assert [r["doc_id"] for r in todo.collect()] == ["b"] and [tuple(r) for r in skipped.collect()] == [("a", "skipped")]
    c = spark.createDataFrame([("x", "c1", [1.0], "text", "t", 3)], "document string, chunk_id string, embedding array<double>, embedding_type string, chunk_text string, n int")
    assert sinks.vector_documents(c).first()["metadata"].asDict() == {"document": "x", "n": 3}
    sinks.write_chunks(c.drop("embedding"), str(tmp_path / "c"))
    assert readers.json_rows(spark, str(tmp_path / "c")).first()["chunk_id"] == "c1"
    edges = spark.createDataFrame([("a", "b", "nearby")], "source_id string, target_id string, relationship_type string")
    sinks.write_graph(docs, edges, str(tmp_path / "g"))
    assert spark.read.parquet(str(tmp_path / "g/edges")).first()["relationship_type"] == "nearby"
    (tmp_path / "raw.json").write_text(
        '[{"text": "t", "meta": {"headings": ["h"], "doc_items": [{"self_ref": "#/0", "prov": [{"page_no": 2, "bbox": {"l": 1}}]}], "origin": {"binary_hash": 12345678901234567890}}}]'
    )
    r = readers.raw_chunks(spark, str(tmp_path / "raw.json")).first()
    assert r["meta"]["doc_items"][0]["prov"][0]["page_no"] == 2 and int(r["meta"]["origin"]["binary_hash"]) == 12345678901234567890
    pages = spark.createDataFrame([("d", 1, [("x",)], [("y",)])], "doc_id string, page_num int, texts array<struct<text: string>>, tables array<struct<text: string>>")
    assert sorted((r["container"], r["pos"], r["text"]) for r in readers.flatten(pages).collect()) == [(0, 0, "x"), (1, 0, "y")]


def test_visual_metadata_and_assets(spark):
    from foliate.operators import visuals

    png = bytes.fromhex("89504e470d0a1a0a0000000d49484452") + (300).to_bytes(4, "big") + (200).to_bytes(4, "big") + bytes([8, 6, 0, 0, 0])
    gif = b"GIF89a" + (10).to_bytes(2, "little") + (20).to_bytes(2, "little")
    files = spark.createDataFrame([("p", png), ("g", gif), ("t", b"text")], "path string, content binary")
    e = make(
        spark, [{"type": "image", "text": "a chart"}, {"type": "image"}, {"type": "chart"}, {"type": "image"}],
    ).withColumns({"asset_path": F.element_at(F.array(*map(F.lit, "pgtn")), F.col("ordinal") + 1), "caption": F.lit(None).cast("string"), "visual_type": F.element_at(F.array(*map(F.lit, ("", "logo", "unclassified", ""))), F.col("ordinal") + 1)})
    got = {r["element_id"]: (r["visual_type"], r["image_properties"] and tuple(r["image_properties"])) for r in visuals.metadata(e, files).collect()}
    assert got == {"e0": ("chart", (300, 200, 1.5, "RGBA", 29)), "e1": ("logo", (10, 20, 0.5, "P", 10)), "e2": ("chart", (None, None, None, None, 4)), "e3": ("unclassified", None)}

    def small(content, side):
        if content == gif:
            raise ValueError
        return content[:side][:3]

    images = spark.createDataFrame([("d", "a", png), ("d", "b", gif), ("d", "c", None)], "doc_id string, element_id string, content binary")
    assert sorted((r["element_id"], r["kind"], bytes(r["content"])) for r in visuals.assets(images, small).collect()) == [
        ("a", "image", png), ("a", "thumbnail", png[:3]), ("b", "image", gif),
    ]
    assert visuals.assets(images).count() == 2


def test_lookup_files_and_raw_outputs(spark, tmp_path):
    m = spark.createDataFrame([("a", "x")], "doc_id string, title string")
    assert readers.lookup(m, "a").first()["title"] == "x"
    with pytest.raises(KeyError):
        readers.lookup(m, "b")
    with pytest.raises(ValueError):
        readers.ingest_one(spark, "a.txt")
    files = spark.createDataFrame([("a", "x", b"3"), ("b", "y", b"?")], "doc_id string, title string, content binary")
    assert {tuple(r) for r in readers.describe_files(files, lambda c: (int(c), "told")).collect()} == {("a", "told", 3), ("b", "y", 0)}
    sinks.write_raw(sinks.raw_outputs(spark.createDataFrame([("a", "{}", None)], "doc_id string, json string, markdown string")), str(tmp_path / "r"))
    assert [tuple(r) for r in spark.read.parquet(str(tmp_path / "r")).collect()] == [("a", "{}", "json")]
    sinks.write_rows(m, str(tmp_path / "j"), "jsonl")
    assert readers.json_rows(spark, str(tmp_path / "j")).count() == 1


def test_global_order_and_nth_item(spark):
    got = {r["element_id"]: r["position"] for r in elements.global_order(make(spark, [{"page": 2, "order": 0}, {"page": 1, "order": 1}, {"page": 1, "order": 0}])).collect()}
    assert got == {"e2": 0, "e1": 1, "e0": 2}
    c = spark.createDataFrame(
        [("d", 0, [("a", "text"), ("b", "table")]), ("d", 1, [("c", "Table")])],
        "document string, sequence_number int, doc_items array<struct<self_ref: string, label: string>>",
    )
    assert [r["sequence_number"] for r in projection.nth_with_label(c, "table", 1).collect()] == [1] and projection.nth_with_label(c, "table", 2).count() == 0


def test_settings():
    from foliate.settings import Settings

    assert Settings.from_env({"FOLIATE_CHUNK_TOKENS": "50", "FOLIATE_TOP_K": " ", "FOLIATE_RAW_DIR": "x"}) == Settings(raw_dir="x", chunk_tokens=50)
    for bad in ({"FOLIATE_CHUNK_TOKENS": "many"}, {"FOLIATE_CHUNK_TOKENS": "0"}, {"FOLIATE_CHUNK_OVERLAP": "300"}, {"FOLIATE_CHUNK_OVERLAP": "-1"}):
        with pytest.raises(ValueError):
            Settings.from_env(bad)


def test_validation_details(spark):
    lines = spark.createDataFrame([("a", f"l{i}", i) for i in range(23)] + [("b", "x", 0)], "doc_id string, line string, place int")
    got = {r["doc_id"]: r["details"] for r in validation.details(lines).collect()}
    assert got["b"] == "x" and got["a"] == "\n".join(f"l{i}" for i in range(20)) + "\n… and 3 more"
