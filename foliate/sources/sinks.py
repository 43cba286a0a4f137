"""Sinks: manifests, chunk exports, vectors and graphs. Spark's commit protocol stands for atomic writes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifests(events: DataFrame) -> DataFrame:
    """The latest state of each document of an event table(doc_id, ts, ...): later values win, nulls don't overwrite."""
    columns = [c for c in events.columns if c not in ("doc_id", "ts")]
    return events.groupBy("doc_id").agg(F.max("ts").alias("ts"), *[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("ts"))).alias(c) for c in columns])


def extraction_state(documents: DataFrame, done: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(to do, skipped): documents whose raw outputs exist already are skipped."""
    return documents.join(
        done.select("doc_id"), "doc_id", "left_anti",
    ), documents.join(done.select("doc_id"), "doc_id", "left_semi").withColumn("extraction_status", F.lit("skipped"))


def write_chunks(chunks: DataFrame, path: str, by: str = "document") -> None:
    """JSON lines, a folder per document."""
    chunks.write.mode("overwrite").partitionBy(by).json(path)


def vector_documents(chunks: DataFrame) -> DataFrame:
    """chunk_id, embedding, embedding_type, chunk_text and the rest as metadata."""
    top = ["chunk_id", "embedding", "embedding_type", "chunk_text"]
    return chunks.select(*top, F.struct(*[c for c in chunks.columns if c not in top]).alias("metadata"))


def write_graph(nodes: DataFrame, edges: DataFrame, path: str) -> None:
    """Nodes and edges as Parquet, edges by type."""
    nodes.write.mode("overwrite").parquet(f"{path}/nodes")
    edges.write.mode("overwrite").partitionBy("relationship_type").parquet(f"{path}/edges")


def raw_outputs(converted: DataFrame) -> DataFrame:
    """doc_id, kind, payload: a row per output that a conversion(doc_id, json, markdown, version) gave, for write_raw()."""
    kinds = [k for k in ("json", "markdown", "version") if k in converted.columns]
    rows = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).cast("string").alias("payload")) for k in kinds]))
    return converted.select("doc_id", rows.alias("r")).select("doc_id", "r.*").where("payload IS NOT NULL")


def write_raw(outputs: DataFrame, path: str) -> None:
    """raw_outputs() or visual assets by kind; a document that is converted again replaces its kind's rows only if the whole kind is written again."""
    outputs.write.mode("append").partitionBy("kind").parquet(path)


def write_rows(df: DataFrame, path: str, kind: str = "parquet") -> None:
    """JSON, JSON lines or Parquet, replaced as a whole: Spark moves finished files into place when all tasks are done."""
    df.write.mode("overwrite").format({"jsonl": "json"}.get(kind, kind)).save(path)
