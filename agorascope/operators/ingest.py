"""Selection and cleaning of posts and comments on their way in."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope.functions import text


def by_score(posts: DataFrame, least: int) -> DataFrame:
    return posts.where(F.col("score") >= least)


def by_recency(posts: DataFrame, days: int, as_of: int) -> DataFrame:
    """as_of: epoch seconds; never the clock."""
    return posts.where(F.col("created_utc") >= as_of - days * 86400)


def by_num_comments(posts: DataFrame, least: int) -> DataFrame:
    return posts.where(F.col("num_comments") >= least)


def by_category(posts: DataFrame, names: list[str]) -> DataFrame:
    return posts.where(F.col("category").isin(names))


def without_category(posts: DataFrame, names: list[str]) -> DataFrame:
    """A null category stays."""
    return posts.where(~F.coalesce(F.col("category").isin(names), F.lit(False)))


def first_of(rows: DataFrame, key: str | Column, *order: Column | str) -> DataFrame:
    """The first row of each key in the order given."""
    w = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("n_", F.row_number().over(w)).where("n_ = 1").drop("n_")


def by_score_desc(posts: DataFrame) -> DataFrame:
    return posts.orderBy(F.desc("score"), "post_id")


def by_time(posts: DataFrame, newest: bool = True) -> DataFrame:
    return posts.orderBy(F.desc("created_utc") if newest else F.asc("created_utc"), "post_id")


@dataclass
class Selection:
    """What apply_filters() does; None, empty and (but for min_score) 0 leave a step out."""

    min_score: int | None = None
    min_comments: int | None = None
    recent_days: int | None = None
    allow: list[str] = field(default_factory=list)
    deny: list[str] = field(default_factory=list)
    deduplicate: bool = True
    sort: str | None = "score"
    top_n: int | None = None


def apply_filters(posts: DataFrame, s: Selection, as_of: int) -> DataFrame:
    if s.min_score is not None:
        posts = by_score(posts, s.min_score)
    if s.min_comments:
        posts = by_num_comments(posts, s.min_comments)
    if s.recent_days:
        posts = by_recency(posts, s.recent_days, as_of)
    if s.allow:
        posts = by_category(posts, s.allow)
    if s.deny:
        posts = without_category(posts, s.deny)
    if s.deduplicate:
        posts = first_of(posts, "post_id", F.desc("score"), F.desc("created_utc"))
    if s.sort:
        posts = by_score_desc(posts) if s.sort == "score" else by_time(posts)
    return posts.limit(s.top_n) if s.top_n else posts


def not_existing(posts: DataFrame, existing: DataFrame, refresh_days: int | None, as_of: int) -> DataFrame:
    """Posts that are new, without an id, or recent enough to be refreshed."""
    held = existing.select(F.col("post_id").alias("held_")).distinct()
    rows = posts.join(held, F.col("post_id") == F.col("held_"), "left")
    keep = F.col("post_id").isNull() | F.col("held_").isNull()
    if refresh_days:
        keep = keep | (F.col("created_utc") >= as_of - refresh_days * 86400)
    return rows.where(keep).drop("held_")


def human_comments(comments: DataFrame, body: str = "comment_text", automatic: Callable[[Column], Column] = text.is_bot) -> DataFrame:
    return comments.where(~automatic(F.col(body)))


def long_comments(comments: DataFrame, least: int = 20, body: str = "comment_text") -> DataFrame:
    return comments.where(F.length(F.coalesce(body, F.lit(""))) >= least)


def top_comments(comments: DataFrame, limit: int | None, min_count: int, *order: Column, body: str = "comment_text", automatic: Callable[[Column], Column] = text.is_bot) -> DataFrame:
    """Of each post the first `limit` comments, automatic ones left out; all or none if fewer than min_count stay.

    automatic: what tells them by their text; text.is_bot also takes any text that begins with "bot", whatever the word."""
    if limit:
        w = Window.partitionBy("post_id").orderBy(*order)
        comments = comments.withColumn("n_", F.row_number().over(w)).where(F.col("n_") <= limit).drop("n_")
    rows = human_comments(comments, body, automatic)
    return rows.withColumn("n_", F.count("*").over(Window.partitionBy("post_id"))).where(F.col("n_") >= min_count).drop("n_")


def wants_comments(is_self: Column, body: Column, least: int = 100) -> Column:
    """Posts whose own text says little."""
    return ~F.coalesce(is_self, F.lit(False)) | (F.length(text.strip(F.coalesce(body, F.lit("")))) < least)


def fetch_gate(mode: str, score: Column, is_self: Column, body: Column) -> Column:
    """Whether comments are fetched: never, always, or smartly (for posts of 100 votes or more)."""
    if mode == "false":
        return F.lit(False)
    return wants_comments(is_self, body) & (F.coalesce(score, F.lit(0)) >= 100) if mode == "smart" else F.lit(True)


def clean_posts(posts: DataFrame) -> DataFrame:
    """Adds cleaned_selftext (empty for links) and topic_text."""
    body = F.when(F.coalesce("is_self", F.lit(False)), text.clean_text(F.col("selftext"))).otherwise(F.lit(""))
    return posts.withColumns({"cleaned_selftext": body, "topic_text": text.topic_text(F.col("title"), F.col("selftext"), F.col("is_self"))})


def clean_comments(comments: DataFrame) -> DataFrame:
    return comments.withColumn("comment_text_clean", text.clean_text(F.col("comment_text")))


def ingest(posts: DataFrame, existing: DataFrame, comments: DataFrame, s: Selection, as_of: int, refresh_days: int | None = 7, min_count: int = 1) -> tuple[DataFrame, DataFrame]:
    """Selected new posts and their comments, both cleaned."""
    chosen = clean_posts(not_existing(apply_filters(posts, s, as_of), existing, refresh_days, as_of))
    own = comments.join(chosen.select("post_id"), "post_id", "left_semi")
    return chosen, clean_comments(top_comments(own, None, min_count))


def unprocessed_images(posts: DataFrame, done: DataFrame) -> DataFrame:
    """Posts that link to an image whose address is not among those done; of equal addresses the post with the smallest id."""
    return first_of(posts.where(text.is_image_url(F.col("url"))).join(done.select("url"), "url", "left_anti"), "url", "post_id")


def mark_processed(done: DataFrame, posts: DataFrame) -> DataFrame:
    """The addresses done, with those of the posts."""
    return done.select("url").union(posts.select("url").where("url is not null")).distinct()
