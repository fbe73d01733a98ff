"""Derived views of query results, as dashboards show them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agorascope.functions.text import string_hash, title_case


def kpis(overview: DataFrame) -> DataFrame:
    """Key figures in long form."""
    names = ["posts", "comments", "labeled_comments", "label_coverage", "avg_confidence", "avg_comments_per_post", "avg_post_upvotes", "avg_comment_upvotes_per_post"]
    return overview.selectExpr(f"stack({len(names)}, " + ", ".join(f"'{n}', cast({n} as double)" for n in names) + ") as (name, value)")


def quality_ratios(overview: DataFrame) -> DataFrame:
    share = lambda c: F.when(F.col("comments") > 0, F.col(c) / F.col("comments")).otherwise(F.lit(0.0))
    return overview.select((1 - share("labeled_comments")).alias("unlabeled"), share("deleted_comments").alias("deleted"), F.when(F.col("labeled_comments") > 0, F.col("low_confidence_comments") / F.col("labeled_comments")).otherwise(F.lit(0.0)).alias("low_confidence"))


def group_sizes(points: DataFrame) -> DataFrame:
    """Points by group, the largest first; a group without a name goes by its topic's id."""
    name = F.coalesce(F.nullif("topic_name", F.lit("")), "topic_id", F.lit("unassigned"))
    return points.groupBy(name.alias("group")).agg(F.count("*").alias("points"), F.sum("size").alias("size")).orderBy(F.desc("points"), "group")


def stacked_bars(insights: DataFrame, n: int = 12) -> DataFrame:
    """Stance shares of the topics with most comments, in long form."""
    kinds = ["agree", "disagree", "neutral", "partial", "unknown"]
    top = insights.orderBy(F.desc("total_comments"), "topic_id").limit(n)
    return top.selectExpr("topic_id", f"stack({len(kinds)}, " + ", ".join(f"'{k}', stance_{k}" for k in kinds) + ") as (stance, share)")


def fingerprints(insights: DataFrame, n: int = 10) -> DataFrame:
    """Ten axes of the most polarized topics, in long form."""
    axes = [f"{k}_{a}" for k, own in (("stance", ["agree", "disagree", "neutral", "partial", "unknown"]), ("sentiment", ["positive", "negative", "neutral", "mixed", "unknown"])) for a in own]
    top = insights.orderBy(F.desc(F.round("polarization_score", 6)), "topic_id").limit(n)
    return top.selectExpr("topic_id", f"stack({len(axes)}, " + ", ".join(f"'{a}', {a}" for a in axes) + ") as (axis, value)")


def coherence(insights: DataFrame) -> DataFrame:
    return insights.where("avg_center_distance is not null").select("topic_id", "polarization_score", "avg_center_distance", "total_comments")


def mirror_bars(insights: DataFrame, n: int = 12) -> DataFrame:
    """Agreement to the right, disagreement to the left."""
    return insights.orderBy(F.desc("total_comments"), "topic_id").limit(n).select("topic_id", "stance_agree", (-F.col("stance_disagree")).alias("stance_disagree"))


def matrix_known(matrix: DataFrame) -> DataFrame:
    return matrix.where("stance <> 'unknown' and sentiment <> 'unknown'")


def topic_table(topics: DataFrame, n: int = 12) -> DataFrame:
    return topics.orderBy(F.desc("count"), "topic_id").limit(n).withColumn("title", title_case(F.coalesce(F.nullif("topic_name", F.lit("")), "topic_id")))


def prefixed_flows(links: DataFrame) -> DataFrame:
    """Flows whose two sides have names of their own."""
    return links.select(F.concat(F.lit("sentiment:"), "source").alias("source"), F.concat(F.lit("stance:"), "target").alias("target"), "value")


def bubbles(points: DataFrame, size: str = "size") -> DataFrame:
    """Radius by the square root of the size."""
    most = F.greatest(F.max(size).over(Window.partitionBy()), F.lit(1))
    return points.withColumn("radius", 5 + F.sqrt(F.col(size) / most) * 22)


def polar_layout(topics: DataFrame, n: int = 42) -> DataFrame:
    """Topics on a plane around (240, 190): the angle from a hash of the id, the radius from the distance to the centre (of
    topics without one, from their rank), both shifted a little by the hash; sizes by the square root of the count.

    Fixed values: the centre, radii, shift and sizes. All windows are over n rows."""
    rank = F.row_number().over(Window.orderBy(F.desc("count"), "topic_id")) - 1
    top = topics.orderBy(F.desc("count"), "topic_id").limit(n).withColumns({"rank": rank, "seed": string_hash(F.coalesce(F.nullif("topic_id", F.lit("")), F.nullif("topic_name", F.lit("")), rank.cast("string")))})
    every = Window.partitionBy()
    far = F.greatest(F.max(F.coalesce("avg_center_distance", F.lit(0.0))).over(every), F.lit(1.0))
    distance = F.coalesce("avg_center_distance", F.col("rank") / F.count("*").over(every))
    shift = F.shiftright(F.col("seed"), 4) % 100 / 100 - 0.5
    radius, angle = 40 + distance / far * 140 + shift * 18, F.col("seed") % 360 / 360 * 2 * F.pi()
    size = 6 + F.sqrt(F.col("count") / F.max("count").over(every)) * 22
    return top.select("topic_id", "count", (240 + F.cos(angle) * radius).alias("x"), (190 + F.sin(angle) * radius).alias("y"), size.alias("size"))
