"""Scans of posts and comments, listings by feed, and rows for export."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.functions.text import or_none
from agorascope.operators.sampling import random_rows

COMMENT_COLUMNS = ["comment_id", "post_id", "upvote_score", "score", "stance_label", "sentiment_label", "llm_confidence", "confidence", "weight"]
#: Windows of the top feed, in days.
TIME_FILTERS = {"hour": 1 / 24, "day": 1, "week": 7, "month": 30, "year": 365, "all": None}


def scan(rows: DataFrame, columns: list[str] | None = None, where: Column | None = None, key: str = "post_id", skip: int = 0, limit: int | None = None, sample: int = 0, seed: int = 42) -> DataFrame:
    """Columns of the rows that match, in order of key, after skip and up to limit; sample > 0 takes that many at random instead."""
    if where is not None:
        rows = rows.where(where)
    rows = rows.select(*[c for c in columns or rows.columns if c in rows.columns])
    if sample > 0:
        return random_rows(rows, sample, seed, key)
    if skip or limit:
        rows = rows.orderBy(key).offset(skip)
    return rows.limit(limit) if limit else rows


def scan_comments(comments: DataFrame, skip: int = 0, limit: int | None = None) -> DataFrame:
    """What weights are computed from."""
    return scan(comments, COMMENT_COLUMNS, key="comment_id", skip=skip, limit=limit)


def listing(posts: DataFrame, feed: str, limit: int, as_of: int, time_filter: str = "week") -> DataFrame:
    """Posts of a landed subreddit table as a feed gives them: top of a time, hot (votes against age), or new.

    An unknown feed gives no posts."""
    if feed == "top":
        days = TIME_FILTERS.get(time_filter, 7)
        rows = posts.where(F.col("created_utc") >= as_of - days * 86400) if days else posts
        return rows.orderBy(F.desc("score"), "post_id").limit(limit)
    if feed == "hot":
        heat = F.signum("score") * F.log10(F.greatest(F.abs("score"), F.lit(1))) + F.col("created_utc") / 45_000
        return posts.orderBy(F.desc(heat), "post_id").limit(limit)
    return posts.orderBy(F.desc("created_utc"), "post_id").limit(limit) if feed == "new" else posts.limit(0)


def distinct_values(rows: DataFrame, column: str, limit: int | None = None) -> DataFrame:
    """Distinct values that are not null, sorted as text."""
    found = rows.select(F.col(column).cast("string").alias(column)).where(F.col(column).isNotNull()).distinct().orderBy(column)
    return found.limit(limit) if limit else found


def _given(rows: DataFrame, *names: str) -> Column:
    """The first of columns by these names that is given."""
    have = [F.col(n) for n in names if n in rows.columns]
    return F.coalesce(*have) if have else F.lit(None)


def _iso(c: Column) -> Column:
    return F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss'Z'")


def export_posts(posts: DataFrame) -> DataFrame:
    """Posts with fallbacks for older names and times as text."""
    g = lambda *n: _given(posts, *n)
    return posts.select(g("post_id", "id").cast("string").alias("post_id"), g("subreddit").cast("string").alias("subreddit"), F.coalesce(g("title").cast("string"), F.lit("")).alias("title"), F.coalesce(g("selftext", "body").cast("string"), F.lit("")).alias("selftext"), F.coalesce(g("score").cast("long"), F.lit(0)).alias("score"), F.coalesce(g("num_comments").cast("long"), F.lit(0)).alias("num_comments"), _iso(g("created_utc").cast("long")).alias("created_at"))


def export_comments(comments: DataFrame) -> DataFrame:
    g = lambda *n: _given(comments, *n)
    return comments.select(g("comment_id", "id").cast("string").alias("comment_id"), g("post_id").cast("string").alias("post_id"), F.coalesce(or_none(g("author").cast("string")), F.lit("[deleted]")).alias("author"), F.coalesce(g("comment_text", "body").cast("string"), F.lit("")).alias("body"), F.coalesce(g("upvote_score", "score").cast("long"), F.lit(0)).alias("score"), _iso(g("created_utc").cast("long")).alias("created_at"))


def write_table(rows: DataFrame, name: str, key: str, buckets: int) -> None:
    """A table by weeks, bucketed and sorted by key, so joins on it need no shuffle."""
    rows.write.mode("overwrite").partitionBy("snapshot_week").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def violations(rows: DataFrame, required: list[str]) -> DataFrame:
    """Rows that lack required fields; nothing is rejected."""
    lacks = F.filter(F.array(*[F.when(F.col(c).isNull() if c in rows.columns else F.lit(True), F.lit(c)) for c in required]), lambda x: x.isNotNull())
    return rows.withColumn("lacks", lacks).where(F.size("lacks") > 0)
