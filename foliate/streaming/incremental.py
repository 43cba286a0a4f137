"""Incremental documents: file streams through the batch functions, with ids that make a repeated batch harmless."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def files(spark: SparkSession, path: str, schema: str, **options: str) -> DataFrame:
    """A stream of the Parquet files that come into a folder."""
    return spark.readStream.schema(schema).options(**options).parquet(path)


def once(stream: DataFrame, key: str, ts: str, delay: str = "1 hour") -> DataFrame:
    """The first row of each key within delay. ts without a zone is read as the session's zone, which watermarks need."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])


def run(stream: DataFrame, batch: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Apply a batch function to each micro-batch and write its rows under out/batch=n, so that a repeated batch overwrites itself."""

    def write(df: DataFrame, n: int) -> None:
        batch(df).write.mode("overwrite").parquet(f"{out}/batch={n}")

    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def tumbling(events: DataFrame, size: str = "1 day", delay: str | None = None) -> DataFrame:
    """start, event_type, n, total: counts and sums of events(ts, event_type, value) in windows; with delay, of a stream."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    timed = timed.withWatermark("ts", delay) if delay else timed
    return timed.groupBy(F.window("ts", size), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(
        F.col("window.start").alias("start"), "event_type", "n", "total",
    )


def sessions(events: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """user_id, start, n: runs of a user's events with less than gap between them."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return timed.groupBy(F.session_window("ts", gap), "user_id").agg(F.count("*").alias("n")).select("user_id", F.col("session_window.start").alias("start"), "n")
