"""Visual elements: image properties from the bytes of their files, assets with thumbnails, and the metadata that goes with them."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from foliate.functions import text
from foliate.session import ship

#: The longer side of a thumbnail, at most.
THUMBNAIL = 256
# The first bytes of the image formats whose size is read here, and the color types of PNG.
PNG, GIF = "89504e470d0a1a0a", "47494638"
PNG_MODES = {0: "L", 2: "RGB", 3: "P", 4: "LA", 6: "RGBA"}


def _number(content: Column, at: int, n: int, little: bool = False) -> Column:
    """n bytes from a place (from 1) as an unsigned number."""
    parts = [F.hex(F.substring(content, at + (n - 1 - i if little else i), 1)) for i in range(n)]
    return F.conv(F.concat(*parts), 16, 10).cast("int")


def image_properties(content: Column) -> Column:
    """struct(width, height, aspect_ratio, mode, size_bytes) of PNG and GIF files; of others, size_bytes alone; null without a file."""
    head = F.lower(F.hex(F.substring(content, 1, 8)))
    png, gif = head == PNG, F.substring(head, 1, 8) == GIF
    width = F.when(png, _number(content, 17, 4)).when(gif, _number(content, 7, 2, little=True))
    height = F.when(png, _number(content, 21, 4)).when(gif, _number(content, 9, 2, little=True))
    kinds = F.create_map(*[F.lit(x) for pair in PNG_MODES.items() for x in pair])
    mode = F.when(png, F.try_element_at(kinds, _number(content, 26, 1))).when(gif, F.lit("P"))
    ratio = F.round(F.try_divide(width, height), 4)
    found = F.struct(width.alias("width"), height.alias("height"), ratio.alias("aspect_ratio"), mode.alias("mode"), F.octet_length(content).alias("size_bytes"))
    return F.when(content.isNotNull(), found)


def metadata(visuals: DataFrame, files: DataFrame | None = None) -> DataFrame:
    """visuals with image_properties, vision_description (null unless there is one) and visual_type, found where it is empty or unclassified.

    visuals: element columns with asset_path, caption and visual_type. files(path, content): the assets, as Spark's binaryFile gives them.
    """
    out = visuals
    if files is not None:
        props = files.select(F.col("path").alias("asset_path"), image_properties(F.col("content")).alias("image_properties"))
        out = out.join(props, "asset_path", "left")
    if "vision_description" not in out.columns:
        out = out.withColumn("vision_description", F.lit(None).cast("string"))
    known = F.coalesce("visual_type", F.lit(""))
    shown = text.visual_type(F.col("element_type"), F.col("caption"), F.col("content"), F.col("right") - F.col("left"), F.col("bottom") - F.col("top"))
    return out.withColumn("visual_type", F.when(known.isin("", "unclassified"), shown).otherwise(known))


def assets(images: DataFrame, thumbnail: Callable[[bytes, int], bytes] | None = None) -> DataFrame:
    """doc_id, element_id, kind ('image' or 'thumbnail'), content of images(doc_id, element_id, content), ready for a partitioned write.

    thumbnail is injected and makes an image of at most THUMBNAIL a side; where it fails, there is none. Images without content are left out.
    """
    rows = images.where("content IS NOT NULL").select("doc_id", "element_id", F.lit("image").alias("kind"), "content")
    if thumbnail is None:
        return rows
    ship(images.sparkSession)

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            made = []
            for d, e, c in zip(pdf["doc_id"], pdf["element_id"], pdf["content"], strict=True):
                try:
                    made.append((d, e, "thumbnail", thumbnail(bytes(c), THUMBNAIL)))
                except Exception:  # noqa: BLE001  a bad image is data here
                    continue
            yield pd.DataFrame(made, columns=["doc_id", "element_id", "kind", "content"])

    return rows.unionByName(rows.drop("kind").mapInPandas(run, "doc_id string, element_id string, kind string, content binary"))
