"""Reports on data: nulls, tokens, distributions, ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.functions import text
from agorascope.operators.ranks import placed

#: Fields that the report covers unless told otherwise.
POST_FIELDS = ["post_id", "subreddit", "title", "selftext", "cleaned_selftext", "topic_text", "embedding", "embedding_model", "embedding_dim", "topic_id", "topic_name", "topic_description", "stance_dist_weighted", "sentiment_dist_weighted", "polarization_score", "snapshot_week", "created_utc"]
COMMENT_FIELDS = ["comment_id", "post_id", "comment_text", "comment_text_clean", "sentiment_label", "stance_label", "weight", "llm_confidence", "llm_comment_exp", "snapshot_week", "created_utc"]


def table_reports(posts: DataFrame | None, comments: DataFrame | None, fields: list[str] | None = None) -> DataFrame:
    """The null reports of either table or both, with the table's name; over the fields given or those of each table."""
    given = [("posts", posts, POST_FIELDS), ("comments", comments, COMMENT_FIELDS)]
    parts = [null_report(rows, fields or own).withColumn("table", F.lit(name)) for name, rows, own in given if rows is not None]
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def null_report(rows: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Per field: total, null, empty string and empty array counts, from one pass. A field the table lacks is null in all rows."""
    kinds = dict(rows.dtypes)
    fields = fields or rows.columns
    parts = [F.count("*").alias("total")]
    for i, f in enumerate(fields):
        if f not in kinds:
            parts += [F.count("*").alias(f"n{i}"), F.lit(0).cast("long").alias(f"e{i}"), F.lit(0).cast("long").alias(f"a{i}")]
            continue
        c = F.col(f)
        parts += [F.count_if(c.isNull()).alias(f"n{i}"), (F.count_if(c == "") if kinds[f] == "string" else F.lit(0).cast("long")).alias(f"e{i}"), (F.count_if(F.size(c) == 0) if kinds[f].startswith("array") else F.lit(0).cast("long")).alias(f"a{i}")]
    long = ", ".join(f"'{f}', n{i}, e{i}, a{i}" for i, f in enumerate(fields))
    return rows.agg(*parts).selectExpr(f"stack({len(fields)}, {long}) as (field, nulls, empty_strings, empty_arrays)", "total")


def token_stats(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Per post: tokens of its text and of its comments, and the number of comments."""
    sums = comments.groupBy("post_id").agg(F.sum(text.estimate_tokens(F.col("comment_text"), blank_is_zero=True)).alias("c"), F.count("*").alias("n"))
    rows = posts.join(sums, "post_id", "left")
    return rows.select("post_id", text.estimate_tokens(F.col("post_text"), blank_is_zero=True).alias("post_tokens"), F.coalesce("c", F.lit(0)).alias("comment_tokens"), F.coalesce("n", F.lit(0)).alias("comments"))


def count_distribution(stats: DataFrame) -> DataFrame:
    return stats.groupBy("comments").agg(F.count("*").alias("posts"), F.sum("comment_tokens").alias("tokens"))


def weighted_median(counts: DataFrame, value: str, weight: str) -> DataFrame:
    """Mean, weighted mean and weighted median (the first value whose running weight reaches half) of distinct values."""
    rows = placed(counts.groupBy(value).agg(F.sum(weight).alias("w")).where(F.col(value).isNotNull()), [], [value], "w")
    rows = rows.withColumns({"run": F.col("before_") + F.col("w"), "all": F.col("all_")})
    return rows.agg(F.avg(value).alias("mean"), (F.sum(F.col(value) * F.col("w")) / F.sum("w")).alias("weighted_mean"), F.min(F.when(F.col("run") >= 0.5 * F.col("all"), F.col(value))).alias("weighted_median"))


def histogram(rows: DataFrame, value: str, bins: int = 30) -> DataFrame:
    """Counts in equal bins from the least to the largest value; the last bin is closed."""
    ends = rows.agg(F.min(value).alias("lo"), F.max(value).alias("hi")).withColumn("one_", F.lit(1))
    held = rows.where(F.col(value).isNotNull()).withColumn("one_", F.lit(1)).join(F.broadcast(ends), "one_")
    width = (F.col("hi") - F.col("lo")) / bins
    bin_ = F.when(width == 0, F.lit(0)).otherwise(F.least(F.floor((F.col(value) - F.col("lo")) / F.nullif(width, F.lit(0.0))), F.lit(bins - 1)))
    return held.groupBy(bin_.cast("int").alias("bin")).agg(F.count("*").alias("count"), F.avg(value).alias("mean"))


def medians(rows: DataFrame, group: str, value: str) -> DataFrame:
    """Exact medians of finite values."""
    return rows.where(~F.isnan(value) & (F.abs(value) < float("inf"))).groupBy(group).agg(F.median(value).alias("median"), F.count("*").alias("count"))


def percentiles(rows: DataFrame, group: str, value: str, share: float) -> DataFrame:
    """Exact percentiles, interpolated."""
    return rows.groupBy(group).agg(F.percentile(value, F.lit(share)).alias("percentile"))


def topic_inventory(posts: DataFrame) -> DataFrame:
    """Topics with the name, description and confidence (null where posts have none) of their first post, by id."""
    rows = posts if "confidence" in posts.columns else posts.withColumn("confidence", F.lit(None).cast("double"))
    first = lambda c: F.min_by(c, "post_id").alias(c)
    return rows.where("coalesce(topic_id, '') <> ''").groupBy("topic_id").agg(first("topic_name"), first("topic_description"), first("confidence"), F.count("*").alias("posts")).orderBy("topic_id")
