"""The query API: one function per endpoint over posts, weighted comments and filters.

Sorted results end in a unique key, so limits cut the same rows each time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.functions import labels, timeutil
from agorascope.functions.text import is_deleted
from agorascope.operators.filters import Filters, comments_of, comments_with_posts, posts_of


def _part(name: str, key: str) -> Column:
    return F.coalesce(F.col(f"{name}_dist_weighted")[key], F.lit(0.0))


def _zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0))


def _ratio(a: Column, b: Column, otherwise: float | None = 0.0) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(otherwise))


STANCE_BALANCE = lambda: _part("stance", "agree") - _part("stance", "disagree")
SENTIMENT_BALANCE = lambda: _part("sentiment", "positive") - _part("sentiment", "negative")


def first(name: str) -> Column:
    """The value in the row with the smallest post_id, null or not."""
    return F.min_by(name, "post_id")


def overview(posts: DataFrame, comments: DataFrame, f: Filters) -> DataFrame:
    p = posts_of(posts, f).agg(F.count("*").alias("posts"), F.avg("num_comments").alias("avg_comments_per_post"), F.avg("score").alias("avg_post_upvotes"))
    labeled = (F.coalesce("stance_label", F.lit("")) != "") & (F.coalesce("sentiment_label", F.lit("")) != "")
    rows = comments_of(comments, posts, f).withColumn("labeled", labeled)
    # Per post first, so comments are read once for both levels.
    conf = F.when(F.col("labeled"), F.col("llm_confidence"))
    each = rows.groupBy("post_id").agg(F.count("*").alias("n"), F.count_if("labeled").alias("labeled"), F.count_if(is_deleted(F.col("comment_text"), blank=True)).alias("deleted"), F.count_if(F.col("labeled") & F.coalesce(F.col("llm_confidence") < 0.5, F.lit(True))).alias("low"), F.sum(conf).alias("conf_sum"), F.count(conf).alias("conf_n"), F.sum(_zero("upvote_score")).alias("votes"))
    c = each.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("comments"), F.coalesce(F.sum("labeled"), F.lit(0)).alias("labeled_comments"), F.coalesce(F.sum("deleted"), F.lit(0)).alias("deleted_comments"), F.coalesce(F.sum("low"), F.lit(0)).alias("low_confidence_comments"), F.sum("conf_sum").alias("s"), F.sum("conf_n").alias("k"), F.avg("votes").alias("avg_comment_upvotes_per_post"))
    # Two rows of one aggregate each; no table is crossed.
    both = p.withColumn("one", F.lit(1)).join(c.withColumn("one", F.lit(1)), "one")
    return both.select("posts", "comments", "labeled_comments", _ratio(F.col("labeled_comments"), F.col("comments")).alias("label_coverage"), _ratio(F.col("s"), F.col("k"), None).alias("avg_confidence"), "avg_comments_per_post", "avg_post_upvotes", "avg_comment_upvotes_per_post", "deleted_comments", "low_confidence_comments")


def stance_sentiment(posts: DataFrame, comments: DataFrame, f: Filters, merge: bool = True) -> DataFrame:
    """The matrix of stance and sentiment; merge=False leaves unclear apart from unknown."""
    rows = comments_of(comments, posts, f).select(labels.known(F.col("stance_label"), merge).alias("stance"), labels.known(F.col("sentiment_label"), False).alias("sentiment"))
    return rows.groupBy("stance", "sentiment").agg(F.count("*").alias("count"))


def marginals(matrix: DataFrame) -> DataFrame:
    """Both marginals of the matrix, in long form."""
    sides = matrix.select(F.explode(F.array(F.struct(F.lit("stance").alias("side"), F.col("stance").alias("label")), F.struct(F.lit("sentiment").alias("side"), F.col("sentiment").alias("label")))).alias("x"), "count")
    return sides.groupBy("x.side", "x.label").agg(F.sum("count").alias("count"))


def trends(posts: DataFrame, comments: DataFrame, f: Filters, field: str = "stance", merge: bool = True) -> DataFrame:
    """Counts per bucket of time and label of one field, in long form."""
    rows = comments_of(comments, posts, f).where("created_utc > 0")
    label = labels.known(F.col(f"{field}_label"), merge and field == "stance")
    return rows.groupBy(timeutil.bucket(F.col("created_utc"), timeutil.bucket_unit(f.days)).alias("bucket"), label.alias("label")).agg(F.count("*").alias("count"))


def series(trend: DataFrame) -> DataFrame:
    """A row per bucket with a map from label to count."""
    return trend.groupBy("bucket").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("label", "count")))).alias("counts"))


def topics(posts: DataFrame, f: Filters, limit: int = 80) -> DataFrame:
    rows = posts_of(posts, f).where("topic_id is not null")
    found = rows.groupBy("topic_id").agg(F.count("*").alias("count"), first("topic_name").alias("n"), first("topic_description").alias("d"), F.avg("num_comments").alias("avg_comments"), F.avg("score").alias("avg_score"), F.avg("center_distance").alias("avg_center_distance"))
    return found.select("topic_id", F.coalesce("n", F.lit("")).alias("topic_name"), F.coalesce("d", F.lit("")).alias("topic_description"), "count", "avg_comments", "avg_score", "avg_center_distance").orderBy(F.desc("count"), "topic_id").limit(limit)


def subreddits(posts: DataFrame, f: Filters, limit: int = 60) -> DataFrame:
    """The limit comes before null and empty names are dropped."""
    found = posts_of(posts, f).groupBy("subreddit").agg(F.count("*").alias("count")).orderBy(F.desc("count"), "subreddit").limit(limit)
    return found.where("coalesce(subreddit, '') <> ''")


def _judged(posts: DataFrame, f: Filters) -> DataFrame:
    return posts_of(posts, f).where("stance_dist_weighted is not null and sentiment_dist_weighted is not null")


def opinion_map_posts(posts: DataFrame, f: Filters, limit: int = 1500) -> DataFrame:
    rows = _judged(posts, f).select(F.col("post_id").alias("id"), F.col("title").alias("label"), "subreddit", "topic_id", F.coalesce("topic_name", F.lit("")).alias("topic_name"), _zero("num_comments").alias("size"), F.coalesce("polarization_score", F.lit(0.0)).alias("polarization_score"), STANCE_BALANCE().alias("x"), SENTIMENT_BALANCE().alias("y"))
    return rows.orderBy(F.desc("size"), "id").limit(limit)


def _weighted(expr: Column, name: str) -> Column:
    return F.sum(expr * _zero("num_comments")).alias(name)


def opinion_map_topics(posts: DataFrame, f: Filters, limit: int = 80) -> DataFrame:
    sums = _judged(posts, f).where("topic_id is not null").groupBy("topic_id").agg(first("topic_name").alias("n"), F.sum(_zero("num_comments")).alias("size"), _weighted(F.coalesce("polarization_score", F.lit(0.0)), "p"), _weighted(STANCE_BALANCE(), "sx"), _weighted(SENTIMENT_BALANCE(), "sy"))
    size = F.col("size")
    return sums.select(F.col("topic_id").alias("id"), F.coalesce("n", "topic_id").alias("label"), "topic_id", F.coalesce("n", F.lit("")).alias("topic_name"), _ratio(F.col("sx"), size).alias("x"), _ratio(F.col("sy"), size).alias("y"), _ratio(F.col("p"), size).alias("polarization_score"), "size").orderBy(F.desc("size"), "id").limit(limit)


def umap_landscape(posts: DataFrame, f: Filters, limit: int = 2000) -> DataFrame:
    rows = posts_of(posts, f).where("umap_x is not null and umap_y is not null")
    rows = rows.select(F.col("post_id").alias("id"), F.col("title").alias("label"), "subreddit", "topic_id", F.coalesce("topic_name", F.lit("")).alias("topic_name"), F.col("umap_x").alias("x"), F.col("umap_y").alias("y"), _zero("num_comments").alias("size"), F.coalesce("polarization_score", F.lit(0.0)).alias("polarization_score"), STANCE_BALANCE().alias("stance_balance"), SENTIMENT_BALANCE().alias("sentiment_balance"))
    return rows.orderBy(F.desc("size"), "id").limit(limit)


#: Shares that readers ask for, and the keys of a distribution that make them up; keys it lacks count as 0.
SHARES = {"stance": {"agree": ["agree"], "disagree": ["disagree"], "neutral": ["neutral"], "partial": ["partial"], "unknown": ["unknown", "unclear"]}, "sentiment": {"positive": ["positive"], "negative": ["negative"], "neutral": ["neutral"], "mixed": ["mixed"], "unknown": ["unknown"]}}


def topic_insights(posts: DataFrame, f: Filters, limit: int = 40) -> DataFrame:
    rows = _judged(posts, f).where("topic_id is not null")
    has = {k: {x.name for x in rows.schema[f"{k}_dist_weighted"].dataType.fields} for k in SHARES}
    share = lambda kind, keys: sum((_part(kind, k) for k in keys if k in has[kind]), F.lit(0.0))
    sums = [_weighted(share(kind, keys), f"{kind}_{name}") for kind, own in SHARES.items() for name, keys in own.items()]
    near = F.sum(F.when(F.col("center_distance").isNotNull(), _zero("num_comments")).otherwise(F.lit(0)))
    found = rows.groupBy("topic_id").agg(first("topic_name").alias("n"), F.sum(_zero("num_comments")).alias("total_comments"), _weighted(F.coalesce("polarization_score", F.lit(0.0)), "p"), _weighted(F.coalesce("center_distance", F.lit(0.0)), "c"), near.alias("cw"), *sums)
    total = F.col("total_comments")
    out = found.select("topic_id", F.coalesce("n", F.lit("")).alias("topic_name"), "total_comments", _ratio(F.col("p"), total).alias("polarization_score"), _ratio(F.col("c"), F.col("cw"), None).alias("avg_center_distance"), *[_ratio(F.col(f"{k}_{n}"), total).alias(f"{k}_{n}") for k, own in SHARES.items() for n in own])
    return out.orderBy(F.desc("polarization_score"), "topic_id").limit(limit)


def sankey(posts: DataFrame, comments: DataFrame, f: Filters) -> DataFrame:
    """Flows from sentiment to stance."""
    rows = comments_of(comments, posts, f).select(labels.known(F.col("sentiment_label"), False).alias("source"), labels.known(F.col("stance_label")).alias("target"), F.coalesce("weight", F.lit(1.0)).alias("w"))
    return rows.groupBy("source", "target").agg(F.sum("w").alias("value"))


def sankey_nodes(links: DataFrame) -> DataFrame:
    return links.select(F.explode(F.array("source", "target")).alias("name")).distinct()


def polarization_timeline(posts: DataFrame, comments: DataFrame, f: Filters) -> DataFrame:
    """Weekly means over posts, weighted by the weights of their comments. Post columns join after the comments are summed."""
    rows = comments.where(F.col("created_utc") >= f.since) if f.since else comments
    sums = rows.groupBy("post_id").agg(F.sum(F.coalesce("weight", F.lit(1.0))).alias("w"))
    from agorascope.operators.filters import of_posts

    own = posts.where(of_posts(f, time=False)).where("snapshot_week is not null").select("post_id", F.col("snapshot_week").alias("week"), F.coalesce("polarization_score", F.lit(0.0)).alias("p"), SENTIMENT_BALANCE().alias("b"))
    weeks = sums.join(own, "post_id").groupBy("week").agg(F.sum("w").alias("weight"), F.sum(F.col("p") * F.col("w")).alias("ps"), F.sum(F.col("b") * F.col("w")).alias("bs"))
    return weeks.select("week", "weight", _ratio(F.col("ps"), F.col("weight")).alias("polarization_score"), _ratio(F.col("bs"), F.col("weight")).alias("sentiment_balance")).orderBy("week")


def leaderboard_posts(posts: DataFrame, comments: DataFrame, f: Filters, limit: int = 30) -> DataFrame:
    rows = comments.where(F.col("created_utc") >= f.since) if f.since else comments
    from agorascope.operators.filters import of_posts

    sums = rows.groupBy("post_id").agg(F.sum(F.coalesce("weight", F.lit(1.0))).alias("comment_weight_sum"))
    found = sums.join(posts.where(of_posts(f, time=False)).select("post_id", "title", "subreddit", "topic_id", "topic_name", "polarization_score"), "post_id")
    return found.select(F.col("post_id").alias("id"), F.coalesce("title", "post_id").alias("label"), "subreddit", "topic_id", F.coalesce("topic_name", F.lit("")).alias("topic_name"), F.coalesce("polarization_score", F.lit(0.0)).alias("polarization_score"), "comment_weight_sum").orderBy(F.desc(F.round("comment_weight_sum", 6)), "id").limit(limit)


def leaderboard_topics(posts: DataFrame, comments: DataFrame, f: Filters, limit: int = 30) -> DataFrame:
    rows = comments_with_posts(comments, posts, f, "topic_id", "topic_name", "polarization_score").where("topic_id is not null").withColumn("w", F.coalesce("weight", F.lit(1.0)))
    sums = rows.groupBy("topic_id").agg(first("topic_name").alias("n"), F.sum("w").alias("comment_weight_sum"), F.sum(F.coalesce("polarization_score", F.lit(0.0)) * F.col("w")).alias("p"))
    return sums.select(F.col("topic_id").alias("id"), F.coalesce("n", "topic_id").alias("label"), "topic_id", F.coalesce("n", F.lit("")).alias("topic_name"), "comment_weight_sum", _ratio(F.col("p"), F.col("comment_weight_sum")).alias("polarization_score")).orderBy(F.desc(F.round("comment_weight_sum", 6)), "id").limit(limit)


def heatmap_topics(posts: DataFrame, f: Filters, limit: int = 12) -> DataFrame:
    rows = posts_of(posts, f).where("topic_id is not null")
    top = rows.groupBy("topic_id").agg(first("topic_name").alias("n"), F.sum(_zero("num_comments")).alias("total_comments"))
    return top.orderBy(F.desc("total_comments"), "topic_id").limit(limit).select("topic_id", F.coalesce("n", F.lit("")).alias("topic_name"), "total_comments")


def topic_heatmap(posts: DataFrame, f: Filters, limit: int = 12) -> DataFrame:
    """Cells of topic and week for the topics with most comments: one plan, the topics as a semi join."""
    top = heatmap_topics(posts, f, limit).where("topic_id <> ''").select("topic_id")
    rows = posts_of(posts, f).where("topic_id is not null and snapshot_week is not null").join(top, "topic_id", "left_semi")
    sums = rows.groupBy("topic_id", F.col("snapshot_week").alias("week")).agg(F.sum(_zero("num_comments")).alias("n"), _weighted(F.coalesce("polarization_score", F.lit(0.0)), "p"), *[_weighted(_part("stance", k), k) for k in labels.STANCES])
    return sums.select("topic_id", "week", _ratio(F.col("p"), F.col("n")).alias("polarization_score"), labels.dominant(F.round("agree", 6), F.round("disagree", 6), F.round("neutral", 6)).alias("dominant_label"))
