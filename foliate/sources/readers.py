"""Sources: files to ingest, converter output, chunk files, and a converter as a Python data source seam."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from foliate.functions import ids

BOX = "STRUCT<l: DOUBLE, t: DOUBLE, r: DOUBLE, b: DOUBLE, coord_origin: STRING>"
ITEM = f"STRUCT<self_ref: STRING, parent: STRUCT<cref: STRING>, children: ARRAY<STRUCT<cref: STRING>>, content_layer: STRING, label: STRING, prov: ARRAY<STRUCT<page_no: INT, bbox: {BOX}, charspan: ARRAY<INT>>>>"
#: The schema of chunk files of a converter.
RAW_CHUNK = f"text STRING, meta STRUCT<schema_name: STRING, version: STRING, doc_items: ARRAY<{ITEM}>, headings: ARRAY<STRING>, origin: STRUCT<mimetype: STRING, binary_hash: DECIMAL(20,0), filename: STRING>>"


def ingest(spark: SparkSession, paths: str | list[str], suffix: str = "pdf", known: DataFrame | None = None) -> DataFrame:
    """doc_id, file_hash, source_path, title, n_bytes of each file with the suffix, each content once; known doc_ids are left out.

    A missing path fails when the read starts. Folders aren't searched in depth."""
    glob = "*.{%s,%s}" % (suffix.lower(), suffix.upper())
    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).option("recursiveFileLookup", "false").load(paths)
    found = files.select(F.sha2("content", 256).alias("file_hash"), F.col("path").alias("source_path"), F.col("length").alias("n_bytes"))
    found = found.withColumn("title", F.regexp_extract("source_path", r"([^/]*?)(?:\.[^./]*)?$", 1))
    first = found.groupBy("file_hash").agg(F.min(F.struct("source_path", "title", "n_bytes")).alias("f")).select("file_hash", "f.*")
    out = first.withColumn("doc_id", ids.document_id(F.col("file_hash")))
    return out.join(known.select("doc_id"), "doc_id", "left_anti") if known is not None else out


def ingest_one(spark: SparkSession, path: str, suffix: str = "pdf") -> DataFrame:
    """As ingest() of one file; another suffix is an error at once, a missing file one when it is read."""
    if not path.lower().endswith("." + suffix.lower()):
        raise ValueError(f"not a .{suffix} file: {path}")
    return ingest(spark, path, suffix)


def lookup(manifests: DataFrame, doc_id: str) -> DataFrame:
    """The manifest row of a document: a filter that reaches the scan. Raises KeyError if there is none."""
    found = manifests.where(F.col("doc_id") == doc_id)
    if not found.limit(1).count():
        raise KeyError(doc_id)
    return found


def describe_files(files: DataFrame, reader: Callable[[bytes], tuple[int, str | None]]) -> DataFrame:
    """files(doc_id, title, content) with page_count and title as an injected reader finds them; 0 pages and the given title where it fails or finds none."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            rows = []
            for d, title, content in zip(pdf["doc_id"], pdf["title"], pdf["content"], strict=True):
                try:
                    pages, told = reader(bytes(content))
                except Exception:  # noqa: BLE001  a bad file is data here
                    pages, told = 0, None
                rows.append((d, told or title, pages))
            yield pd.DataFrame(rows, columns=["doc_id", "title", "page_count"])

    return files.select("doc_id", "title", "content").mapInPandas(run, "doc_id string, title string, page_count int")


def raw_chunks(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Chunk files (one JSON object or array each, or JSON lines) under their fixed schema."""
    return spark.read.schema(RAW_CHUNK).option("multiLine", not lines).json(path)


def json_rows(spark: SparkSession, path: str, schema: str | T.StructType | None = None, lines: bool = True) -> DataFrame:
    """JSON lines (blank lines are skipped) or whole-file JSON."""
    reader = spark.read.option("multiLine", not lines)
    return (reader.schema(schema) if schema else reader).json(path)


def convert(files: DataFrame, converter: Callable[[bytes], list[dict]], schema: str) -> DataFrame:
    """Rows that an injected converter makes of each file(doc_id, content); a failing file gives one row with its error."""

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in parts:
            for d, content in zip(pdf["doc_id"], pdf["content"], strict=True):
                try:
                    rows, error = converter(bytes(content)), None
                except Exception as e:  # noqa: BLE001  a bad file is data here
                    rows, error = [{}], repr(e)
                yield pd.DataFrame([{"doc_id": d, "error": error} | {c: r.get(c) for c in names} for r in rows])

    names = [f.name for f in T.StructType.fromDDL(schema).fields]
    return files.select("doc_id", "content").mapInPandas(run, f"doc_id string, error string, {schema}")


def flatten(pages: DataFrame, containers: tuple[str, ...] = ("items", "texts", "tables", "pictures", "figures")) -> DataFrame:
    """One row per item of pages(doc_id, page_num, container arrays), with the container and ordinal that it came from."""
    out = None
    for rank, c in enumerate(x for x in containers if x in pages.columns):
        one = pages.select(
            "doc_id", "page_num", F.lit(rank).alias("container"), F.posexplode(c).alias("pos", "item"),
        ).select("doc_id", "page_num", "container", "pos", "item.*")
        out = one if out is None else out.unionByName(one, allowMissingColumns=True)
    return out
