"""The corpus pipeline: each stage takes what the one before kept, written as Parquet and read again.

All stages but the last return documents with the columns they came with; text and n_chars follow what a stage cut out.

Nulls: a null text, or one without a letter, has no language and goes in the first stage. Rows with a null doc_id pass through the others as
they are. Rows that share a doc_id are versions of one document: the first stages handle each on its own, the near-copy
stage keeps one of them (that of the least hash of its text), equal rows too. Null lang, source or other columns change nothing. An empty table gives no
rows, and so does one without any labelled row, as no language can be learnt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from foliate.llm import common, language, line_dedup, near_dedup, packing, repeats

#: Documents whose language is less certain than this go, and those without one.
LEAST_SCORE = 0.5
#: Near copies share this % of their 5-word shingles or more.
NEAR_SHARE = 80


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is known: a model is fitted on the stage's own labelled rows, and all rows are judged by their text."""
    found = language.predict(docs, language.learn(docs), *docs.columns)
    return found.where((F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand earlier."""
    return line_dedup.remove(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies, one row of it."""
    gone = common.materialise(near_dedup.groups(docs, NEAR_SHARE).where("NOT kept").select("doc_id").distinct())
    left = docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
    rows = common.keyed(left.select("doc_id", "text", F.struct(*docs.columns).alias("__row")))
    again = F.coalesce(F.col("doc_id").isNotNull() & (F.col("rid") != 0), F.lit(False))
    one = rows.where(again).groupBy("doc_id").agg(F.min_by("__row", "rid").alias("__row"))
    return rows.where(~again).select("__row.*").unionByName(one.select("__row.*")).select(*docs.columns)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without long passages of earlier ones."""
    return repeats.remove(docs)


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents that are left, in sequences."""
    return packing.pack(docs)


STAGES = [("language", languages), ("line_dedup", lines), ("near_dedup", near), ("repeats", passages), ("packing", sequences)]

#: SQL can't express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows for sf_dir's documents. What a stage stored on its way goes when its output is written, an output when the next one is."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    known = common.written(spark)
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            path = common.new_path(spark, "pipeline")
            out.write.parquet(path)
            common.cleanup(spark, since=known, keep=(path,))
            out = spark.read.parquet(path)
        docs = out
    return docs
