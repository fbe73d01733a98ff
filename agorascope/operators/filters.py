"""The filter triple of the query API and what it means for posts and comments."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Ranges by name, in days.
RANGE_DAYS = {"7d": 7, "30d": 30, "90d": 90, "180d": 180, "365d": 365}


@dataclass(frozen=True)
class Filters:
    range: str = "90d"
    subreddit: str | None = None
    topic: str | None = None
    days: int | None = None
    since: int | None = None


def parse(range: str | None = None, subreddit: str | None = None, topic: str | None = None, *, now: int) -> Filters:
    """"all" or empty means no condition; a range of another name has no bound of time; now: epoch seconds."""
    range = range or "90d"
    days = RANGE_DAYS.get(range)
    value = lambda v: None if not v or v == "all" else v
    return Filters(range, value(subreddit), value(topic), days, now - days * 86400 if days else None)


def _all(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def of_posts(f: Filters, time: bool = True) -> Column:
    parts = [F.col("created_utc") >= f.since] if f.since and time else []
    parts += [F.col("subreddit") == f.subreddit] if f.subreddit else []
    return _all(parts + ([F.col("topic_id") == f.topic] if f.topic else []))


def posts_of(posts: DataFrame, f: Filters) -> DataFrame:
    return posts.where(of_posts(f))


def comments_of(comments: DataFrame, posts: DataFrame, f: Filters) -> DataFrame:
    """Comments by their own time; only a filter on posts joins them, and drops comments without one."""
    rows = comments.where(F.col("created_utc") >= f.since) if f.since else comments
    if not (f.subreddit or f.topic):
        return rows
    return rows.join(posts.where(of_posts(f, time=False)).select("post_id"), "post_id")


def comments_with_posts(comments: DataFrame, posts: DataFrame, f: Filters, *columns: str) -> DataFrame:
    """Comments of a time, joined to columns of their posts; comments without a post are left out."""
    rows = comments.where(F.col("created_utc") >= f.since) if f.since else comments
    return rows.join(posts.where(of_posts(f, time=False)).select("post_id", *columns), "post_id")


def has_embedding(vector: str = "embedding") -> Column:
    """A vector that is there and not empty; a null counts as missing, and so does an empty one."""
    return F.coalesce(F.size(vector) > 0, F.lit(False))


def lacks_topic() -> Column:
    return F.coalesce("topic_id", F.lit("")) == ""


def is_noise(topic: Column) -> Column:
    return F.coalesce(topic == "noise", F.lit(False))


def is_noise_cluster(topic: Column) -> Column:
    return F.coalesce(topic.startswith("noise_"), F.lit(False))
