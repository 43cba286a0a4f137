"""Checks of converted documents: one pass of conditional aggregates per document, then one row per check."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Item types that converters are known to give.
KNOWN_TYPES = (
    "text", "table", "figure", "formula", "caption", "heading", "list", "checkbox", "picture", "chart", "graph", "header", "footer", "footnote",
    "page_number", "diagram", "shape", "line", "group",
)
SEVERITY = {
    "page_count": "critical", "not_empty": "critical", "all_bboxes_valid": "critical", "page_number_valid": "warning", "item_types": "warning",
    "individual_bboxes": "warning", "reading_order": "warning", "tables": "warning", "captions": "warning",
}


def box_valid(width: Column, height: Column) -> Column:
    """Finite, from 0 on, with left before right and top before bottom, inside the page where its size is known."""
    box = [F.col(c) for c in ("left", "top", "right", "bottom")]
    ok = (F.col("left") < F.col("right")) & (F.col("top") < F.col("bottom"))
    for c in box:
        ok = ok & c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")) & (c >= 0)
    ok = ok & (width.isNull() | (width <= 0) | (F.col("right") <= width)) & (height.isNull() | (height <= 0) | (F.col("bottom") <= height))
    return F.coalesce(ok, F.lit(False))


def order_gaps(items: DataFrame) -> DataFrame:
    """doc_id, page_num, gaps, duplicates: missing and repeated order numbers of each page."""
    own = items.where("item_order IS NOT NULL").groupBy("doc_id", "page_num").agg(
        F.count("item_order").alias("n"), F.countDistinct("item_order").alias("d"), F.min("item_order").alias("lo"), F.max("item_order").alias("hi"),
    )
    return own.select(
        "doc_id", "page_num", (F.col("hi") - F.col("lo") + 1 - F.col("d")).cast("long").alias("gaps"),
        (F.col("n") - F.col("d")).cast("long").alias("duplicates"),
    )


def checks(documents: DataFrame, items: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, check_name, passed, severity, failures of the nine checks.

    documents: doc_id, page_count, markdown. items: doc_id, page_num, type, box, item_order, row_count, col_count, caption.
    pages: doc_id, page_num, width, height.
    """
    dims = pages.select("doc_id", "page_num", "width", "height")
    placed = items.join(dims, ["doc_id", "page_num"], "left")
    boxed = F.coalesce("left", "top", "right", "bottom").isNotNull()
    valid = box_valid(F.col("width"), F.col("height"))
    table = (F.col("type") == "table") | F.col("row_count").isNotNull() | F.col("col_count").isNotNull()
    shown = F.col("type").isin("figure", "table", "chart", "graph", "picture")
    per = placed.groupBy("doc_id").agg(
        F.count("*").alias("n"), F.count_if(boxed).alias("boxes"), F.count_if(boxed & ~valid).alias("bad_boxes"),
        F.count_if(~F.col("type").isin(*KNOWN_TYPES)).alias("unknown"), F.count_if(
            table & ((F.coalesce("row_count", F.lit(0)) == 0) | (F.coalesce("col_count", F.lit(0)) == 0))
        ).alias("bad_tables"),
        F.count_if(shown & (F.coalesce(F.trim("caption"), F.lit("")) == "")).alias("bare"), F.min("page_num").alias("lo"), F.max("page_num").alias("hi"),
    )
    outside = items.join(
        documents.select("doc_id", "page_count"), "doc_id",
    ).groupBy("doc_id").agg(F.count_if((F.col("page_num") < 1) | (F.col("page_count") > 0) & (F.col("page_num") > F.col("page_count"))).alias("outside"))
    order = order_gaps(items).groupBy("doc_id").agg(F.count_if((F.col("gaps") > 0) | (F.col("duplicates") > 0)).alias("bad_order"))
    counted = pages.groupBy("doc_id").agg(F.count("*").alias("pages"))
    one = documents.join(per, "doc_id", "left").join(outside, "doc_id", "left").join(order, "doc_id", "left").join(counted, "doc_id", "left").na.fill(0)
    failures = {
        "page_count": F.when((F.col("page_count") > 0) & (F.col("pages") != F.col("page_count")), 1).otherwise(0),
        "not_empty": F.when((F.col("n") == 0) & (F.coalesce(F.trim("markdown"), F.lit("")) == ""), 1).otherwise(0),
        "all_bboxes_valid": F.when((F.col("boxes") > 0) & (F.col("bad_boxes") == F.col("boxes")), 1).otherwise(0),
        "page_number_valid": F.col("outside"), "item_types": F.col("unknown"), "individual_bboxes": F.col("bad_boxes"), "reading_order": F.col("bad_order"), "tables": F.col("bad_tables"), "captions": F.col("bare"),
    }
    rows = F.explode(
        F.array(*[F.struct(F.lit(k).alias("check_name"), F.lit(SEVERITY[k]).alias("severity"), v.cast("long").alias("failures")) for k, v in failures.items()])
    )
    return one.select("doc_id", rows.alias("c")).select("doc_id", "c.*").withColumn("passed", F.col("failures") == 0)


def report(found: DataFrame) -> DataFrame:
    """doc_id, is_valid (no critical check failed), n_checks, n_errors, n_warnings."""
    failed = ~F.col("passed")
    return found.groupBy("doc_id").agg(
        (F.count_if(failed & (F.col("severity") == "critical")) == 0).alias("is_valid"), F.count("*").alias("n_checks"),
        F.count_if(failed & F.col("severity").isin("error", "critical")).alias("n_errors"), F.count_if(failed & (F.col("severity") == "warning")).alias("n_warnings"),
    )


#: Lines that details() shows of each document.
SHOWN = 20


def details(lines: DataFrame, shown: int = SHOWN) -> DataFrame:
    """doc_id, failures, details: the first lines of lines(doc_id, line, place) in order of place, then how many more there are."""
    w = Window.partitionBy("doc_id").orderBy("place")
    ranked = lines.withColumn("k", F.row_number().over(w))
    kept = F.array_sort(F.collect_list(F.when(F.col("k") <= shown, F.struct("k", "line"))))
    one = ranked.groupBy("doc_id").agg(F.count("*").alias("failures"), kept.alias("x"))
    more = F.when(F.col("failures") > shown, F.concat(F.lit("\n… and "), (F.col("failures") - shown).cast("string"), F.lit(" more"))).otherwise(F.lit(""))
    return one.select("doc_id", "failures", F.concat(F.array_join(F.transform("x", lambda r: r["line"]), "\n"), more).alias("details"))
