"""Incremental refresh on Structured Streaming: windows of labels, sessions, post sums, and an upsert sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from agorascope.functions import labels
from agorascope.operators.merge import upsert
from agorascope.operators.weights import with_weight
from agorascope.sources.versioned import Keyed


def comment_stream(spark: SparkSession, path: str, schema, files_per_trigger: int = 16) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def trends(comments: DataFrame, field: str = "stance", late: str = "7 days", unit: str = "1 day") -> DataFrame:
    """Counts per tumbling window and label; comments later than the refresh window are dropped."""
    rows = comments.withColumn("at", F.timestamp_seconds("created_utc")).withWatermark("at", late)
    # Weeks begin on Sunday; the epoch was a Thursday.
    window = F.window("at", unit, startTime="3 days") if unit == "7 days" else F.window("at", unit)
    return rows.groupBy(window.alias("w"), labels.known(F.col(f"{field}_label"), field == "stance").alias("label")).agg(F.count("*").alias("count")).select(F.col("w.start").alias("bucket"), "label", "count")


def post_sums(comments: DataFrame) -> DataFrame:
    """Running sums per post from which distributions follow; for update or complete output."""
    rows = with_weight(comments).withColumns({"s": labels.stance(F.col("stance_label")), "e": labels.sentiment(F.col("sentiment_label"))})
    part = lambda c, k: F.sum(F.when(F.col(c) == k, F.col("weight")).otherwise(0.0)).alias(k if c == "s" else f"e_{k}")
    return rows.groupBy("post_id").agg(*[part("s", k) for k in labels.STANCES], *[part("e", k) for k in labels.SENTIMENTS], F.count("s").alias("stance_count"))


def sliding(comments: DataFrame, field: str = "stance", size: str = "7 days", slide: str = "1 day", late: str = "7 days") -> DataFrame:
    """Counts per sliding window and label: a comment counts in each window that holds it. For batches and streams."""
    rows = comments.withColumn("at", F.timestamp_seconds("created_utc")).withWatermark("at", late)
    window = F.window("at", size, slide)
    return rows.groupBy(window.alias("w"), labels.known(F.col(f"{field}_label"), field == "stance").alias("label")).agg(F.count("*").alias("count")).select(F.col("w.start").alias("begins"), F.col("w.end").alias("ends"), "label", "count")


def sessions(comments: DataFrame, gap: str = "1 day", late: str = "7 days") -> DataFrame:
    """Bursts of a post's comments: one ends when no comment has come for the gap. For batches and streams; a session of a
    stream is final when the watermark has passed its end."""
    rows = comments.where("post_id is not null").withColumn("at", F.timestamp_seconds("created_utc")).withWatermark("at", late)
    found = rows.groupBy(F.session_window("at", gap).alias("w"), "post_id").agg(F.count("*").alias("comments"), F.sum(F.coalesce("upvote_score", F.lit(0))).alias("votes"))
    return found.select("post_id", F.col("w.start").alias("begins"), F.col("w.end").alias("ends"), "comments", "votes")


def upsert_sink(stream: DataFrame, spark: SparkSession, path: str, key: str, checkpoint: str, now, buckets: int = 64, source: str = "stream") -> StreamingQuery:
    """Upserts into a table of buckets (sources.versioned.Keyed): a trigger rewrites the buckets of its keys and no others.
    A batch that is run again is known by its source and number, and changes nothing."""
    table = Keyed(spark, path, stream.schema, key, buckets)

    def write(batch: DataFrame, n: int) -> None:
        table.apply(batch, lambda old, new: upsert(old, new, key, now), (source, n))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
