"""Weights of comments, and label distributions and polarization of posts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from agorascope.functions import labels


def with_weight(comments: DataFrame) -> DataFrame:
    """comments with weight computed anew from votes and confidence."""
    numbers = isinstance(comments.schema["llm_confidence"].dataType, NumericType)
    return comments.withColumn("weight", labels.compute_weight(F.col("upvote_score"), labels.confidence(F.col("llm_confidence"), numbers=numbers)))


def _distribution(kinds: list[str], label: Column, name: str) -> list[Column]:
    total = F.sum(F.when(label.isNotNull(), F.col("weight")))
    parts = [F.coalesce(F.sum(F.when(label == k, F.col("weight"))), F.lit(0.0)) / F.nullif(total, F.lit(0.0)) for k in kinds]
    return [F.when(total > 0, F.struct(*[p.alias(k) for p, k in zip(parts, kinds, strict=True)])).alias(f"{name}_dist_weighted"), F.count(label).alias(f"{name}_count")]


def post_distribution(comments: DataFrame, min_comments: int = 5, unknown: str = "drop", weighted: bool = False) -> DataFrame:
    """Per post: weighted shares of stances and sentiments, and polarization where enough stances are known.

    One aggregation with map-side partial sums; comments without a post are left out. weighted: they have their weights."""
    own = comments.where("post_id is not null")
    rows = (own if weighted else with_weight(own)).withColumns({"s_": labels.stance(F.col("stance_label"), unknown), "e_": labels.sentiment(F.col("sentiment_label"), unknown)})
    found = rows.groupBy("post_id").agg(*_distribution(labels.STANCES, F.col("s_"), "stance"), *_distribution(labels.SENTIMENTS, F.col("e_"), "sentiment"))
    d = F.col("stance_dist_weighted")
    return found.withColumn("polarization_score", F.when(F.col("stance_count") >= min_comments, labels.polarization(d["agree"], d["disagree"], d["neutral"])))


def changed_weights(comments: DataFrame, least: float = 1e-6) -> DataFrame:
    """comment_id and new weight where the stored one is null or differs."""
    rows = comments.withColumnRenamed("weight", "stored_").transform(with_weight)
    return rows.where(F.col("comment_id").isNotNull() & (F.col("stored_").isNull() | (F.abs(F.col("stored_") - F.col("weight")) > least))).select("comment_id", "weight")
