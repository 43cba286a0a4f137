"""Page items to elements: types, boxes, reading order, ids.

Elements are one wide table: doc_id, element_id, page_num, reading_order, section_path, element_type, content and a box in page
fractions as the columns left, top, right, bottom. Every function takes and returns DataFrames and is lazy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from foliate.functions import ids

# Converter labels and element types.
ELEMENT_TYPES = {
    "text": "text_block", "paragraph": "text_block", "textblock": "text_block", "table": "table",
    "picture": "image", "image": "image", "figure": "image", "chart": "chart", "graph": "graph", "diagram": "graph",
    "formula": "formula", "equation": "formula", "caption": "caption", "footnote": "footnote",
    "header": "header", "page_header": "header", "footer": "footer", "page_footer": "footer",
    "list": "list_block", "list_item": "list_block", "title": "section_header", "section_header": "section_header", "heading": "section_header",
}
VISUAL = ("table", "image", "chart", "graph", "formula")


def element_type(label: Column) -> Column:
    """The element type of a converter's label; unknown ones are text blocks."""
    names = F.create_map(*[F.lit(x) for pair in ELEMENT_TYPES.items() for x in pair])
    return F.coalesce(F.try_element_at(names, F.lower(label)), F.lit("text_block"))


def scaled_boxes(items: DataFrame, width: str, height: str) -> DataFrame:
    """Boxes (left, top, right, bottom) as page fractions: divided by the page's width and height (columns, dropped) where these are known and
    positive, kept where they lie in [0, 1], else all zero; a box that lacks a side is all zero."""
    box = ("left", "top", "right", "bottom")
    sized, inside, whole = (F.col(width) > 0) & (F.col(height) > 0), F.lit(True), F.lit(True)
    for b in box:
        inside, whole = inside & F.col(b).between(0, 1), whole & F.col(b).isNotNull()
    scale = {"left": width, "right": width, "top": height, "bottom": height}
    out = items.withColumns({b: F.when(~whole, F.lit(0.0)).when(sized, F.col(b) / F.col(scale[b])).when(inside, F.col(b)).otherwise(F.lit(0.0)) for b in box})
    return out.drop(width, height)


def normalise_boxes(items: DataFrame, pages: DataFrame) -> DataFrame:
    """scaled_boxes() by the sizes of pages(doc_id, page_num, width, height)."""
    joined = items.join(pages.select("doc_id", "page_num", F.col("width").alias("__w"), F.col("height").alias("__h")), ["doc_id", "page_num"], "left")
    return scaled_boxes(joined, "__w", "__h")


def reading_order(items: DataFrame, order: str = "item_order", ordinal: str = "ordinal", after: Column | None = None) -> DataFrame:
    """reading_order from 0 on each page: items with an order of their own first, then by column, top and centre; ordinal
    breaks ties. The column is the centre divided by 0.3 (boxes in fractions) or 200 (others); an item without a whole box stands in the first one, at the top.
    Rows for which after holds come after all others."""
    centre, whole = (F.col("left") + F.col("right")) / 2, F.lit(True)
    for b in ("left", "top", "right", "bottom"):
        whole = whole & F.col(b).isNotNull()
    width = F.when(F.greatest("left", "top", "right", "bottom") <= 1, F.lit(0.3)).otherwise(F.lit(200.0))
    zero = F.struct(F.lit(0).alias("column"), F.lit(0.0).alias("top"), F.lit(0.0).alias("centre"))
    key = F.when(whole, F.struct((centre / width).cast("int").alias("column"), F.col("top").cast("double").alias("top"), centre.cast("double").alias("centre"))).otherwise(zero)
    own = F.col(order).isNull()
    by = [*([after] if after is not None else []), own.cast("int"), F.col(order).asc_nulls_last(), F.when(own, key), F.col(ordinal)]
    return items.withColumn("reading_order", F.row_number().over(Window.partitionBy("doc_id", "page_num").orderBy(*by)) - 1)


def elements(items: DataFrame, pages: DataFrame) -> DataFrame:
    """Elements of items(doc_id, page_num, ordinal, item_order, label, content, box): items off page are left out."""
    ordered = normalise_boxes(reading_order(items.where("page_num >= 1")), pages)
    kind = element_type(F.col("label"))
    return ordered.withColumn("element_type", kind).withColumn(
        "element_id", ids.element_id(F.col("doc_id"), F.col("page_num"), F.col("reading_order"), F.col("element_type")),
    )


def latest(elements: DataFrame, ordinal: str = "ordinal") -> DataFrame:
    """One row per element_id: the last one put in."""
    columns = elements.columns
    return elements.groupBy("element_id").agg(F.max_by(F.struct(*columns), F.col(ordinal)).alias("r")).select("r.*")


def page_elements(elements: DataFrame, pages: DataFrame) -> DataFrame:
    """doc_id, page_num, element_ids in reading order, of all pages with dimensions or elements."""
    own = elements.groupBy("doc_id", "page_num").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("reading_order", "element_id"))), lambda x: x["element_id"]).alias("element_ids")
    )
    both = pages.select("doc_id", "page_num").distinct().join(own, ["doc_id", "page_num"], "full_outer")
    return both.select("doc_id", "page_num", F.coalesce("element_ids", F.array().cast("array<string>")).alias("element_ids"))


def global_order(elements: DataFrame) -> DataFrame:
    """elements with position: from 0 on in each document, by page, reading order, top and left."""
    w = Window.partitionBy("doc_id").orderBy("page_num", "reading_order", "top", "left", "element_id")
    return elements.withColumn("position", F.row_number().over(w) - 1)
