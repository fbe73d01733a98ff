"""Samples of posts per topic, by ranks under a limit. Random order is a hash of key and seed: the same on every run and cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agorascope.functions.text import word_count
from agorascope.operators.ranks import first_rows


def shuffled(seed: int, key: str = "post_id") -> Column:
    return F.xxhash64(F.lit(seed), F.col(key))


def random_rows(rows: DataFrame, n: int, seed: int = 42, key: str = "post_id") -> DataFrame:
    """Exactly n rows."""
    return rows.orderBy(shuffled(seed, key), key).limit(n)


def near_far(rows: DataFrame, near: int = 20, far: int = 5) -> DataFrame:
    """The nearest and farthest posts of each topic, tagged; NEAR wins where they overlap. post_index is the place by distance.

    Both ends are ranks under a limit, and the place of a far one follows from the topic's size: no topic is sorted whole."""
    close = first_rows(rows, ["topic_id"], near, "distance", "post_id").select(*rows.columns, F.lit("NEAR").alias("tag"), (F.col("n_") - 1).alias("post_index"))
    size = rows.groupBy(F.col("topic_id").alias("of_")).agg(F.count("*").alias("m_"))
    away = first_rows(rows, ["topic_id"], far, F.desc("distance"), F.desc("post_id")).join(size, F.col("topic_id").eqNullSafe(F.col("of_")))
    away = away.select(*rows.columns, F.lit("FAR").alias("tag"), (F.col("m_") - F.col("n_")).cast("int").alias("post_index"))
    return close.unionByName(away.where(F.col("post_index") >= near))


def _take(rows: DataFrame, how: str, quota: Column, *order: Column | str) -> DataFrame:
    """Marks the first `quota` rows of each topic among those not taken."""
    w = Window.partitionBy("topic_id", F.col("taken").isNotNull()).orderBy(*order)
    return rows.withColumn("taken", F.coalesce("taken", F.when(F.row_number().over(w) <= quota, F.lit(how))))


def sample(rows: DataFrame, size: Column, dominant: Column, seed: int = 42) -> DataFrame:
    """A stratified sample of `size` posts per topic, all of smaller topics; adds how each was taken.

    Dominant topics: a third each by score, by time (half earliest, half latest) and at random; others half by score, half
    at random. What a step leaves short is filled up at random.

    A step takes no more than the largest size, so it finds its rows among as many more by its own order as steps before it may
    have taken: these candidates, a few times the size per topic, are all that is ranked in full."""
    rows = rows.withColumns({"size_": size, "dom_": dominant, "taken": F.lit(None).cast("string")})
    orders = {"score": (F.desc("score"), "post_id"), "early": (F.asc("created_utc"), "post_id"), "late": (F.desc("created_utc"), "post_id"), "random": (shuffled(seed), "post_id")}
    most = int(rows.agg(F.max("size_")).first()[0] or 0)
    own = [first_rows(rows.select("topic_id", "post_id", "score", "created_utc"), ["topic_id"], 2 * most, *by).select("topic_id", "post_id") for by in orders.values()]
    some = own[0].unionByName(own[1]).unionByName(own[2]).unionByName(own[3]).distinct().toDF("in_", "is_")
    rows = rows.join(some, F.col("topic_id").eqNullSafe(F.col("in_")) & (F.col("post_id") == F.col("is_")), "left_semi")
    n = F.col("size_")
    third = F.floor(n / 3)
    by_score = F.when(F.col("dom_"), third + F.when(n % 3 >= 1, 1).otherwise(0)).otherwise(F.floor(n / 2))
    by_time = F.when(F.col("dom_"), third).otherwise(F.lit(0))
    rows = _take(rows, "score", by_score, *orders["score"])
    rows = _take(rows, "early", F.floor(by_time / 2), *orders["early"])
    rows = _take(rows, "late", by_time - F.floor(by_time / 2), *orders["late"])
    rows = rows.withColumn("left_", n - F.count("taken").over(Window.partitionBy("topic_id")))
    rows = _take(rows, "random", F.col("left_"), *orders["random"])
    return rows.where("taken is not null").drop("size_", "dom_", "left_")


def sample_plan(counts: DataFrame, share: float = 0.1, most: int = 80, small: int = 50, dominance: float = 0.25, small_noise: int | None = None) -> DataFrame:
    """Per topic (topic_id, count): whether it is dominant among what is no noise, and its sample size."""
    noise = F.col("topic_id").startswith("noise")
    total = F.sum(F.when(~noise, F.col("count"))).over(Window.partitionBy())
    floor = F.when(noise, F.lit(small if small_noise is None else small_noise)).otherwise(F.lit(small))
    size = F.when(F.col("count") < floor, F.col("count")).otherwise(F.least(F.ceil(F.col("count") * share), F.lit(most)))
    return counts.withColumns({"dominant": ~noise & (F.col("count") > dominance * F.coalesce(total, F.lit(0))), "sample_size": size.cast("long")})


def topic_counts(posts: DataFrame, text: str = "topic_text") -> DataFrame:
    """Posts with a text per topic; posts without a topic are left out."""
    return posts.where((F.coalesce("topic_id", F.lit("")) != "") & (F.coalesce(text, F.lit("")) != "")).groupBy("topic_id").agg(F.count("*").alias("count"))


def top_texts(posts: DataFrame, limit: int | None, text: str = "topic_text") -> DataFrame:
    """The texts of each topic by votes, then by time, newest first, then by id; at most `limit` of them. Adds rank.

    Groups are cut before the sort's rows leave their tasks, as Spark plans a limit on a rank."""
    w = Window.partitionBy("topic_id").orderBy(F.desc("score"), F.desc("created_utc"), "post_id")
    rows = posts.where((F.coalesce("topic_id", F.lit("")) != "") & (F.coalesce(text, F.lit("")) != "")).withColumn("rank", F.row_number().over(w))
    return rows.where(F.col("rank") <= limit) if limit else rows


def trim_long(rows: DataFrame, share: float = 0.95, min_words: int = 1, text: str = "text") -> DataFrame:
    """Posts of min_words or more, per topic without those longer than the percentile.

    The percentile is exact: an aggregate of how often each length occurs, combined before rows move."""
    rows = rows.withColumn("words", word_count(F.col(text))).where(F.col("words") >= min_words)
    cut = rows.groupBy(F.col("topic_id").alias("of_")).agg(F.percentile("words", F.lit(share)).alias("cut_"))
    return rows.join(cut, F.col("topic_id").eqNullSafe(F.col("of_"))).where("words <= cut_").drop("cut_", "of_")


def capped(rows: DataFrame, per_post: int | None, posts: int | None, total: int | None) -> DataFrame:
    """Comments in order of post, time and id, capped per post, in posts and in all."""
    order = ("post_id", "created_utc", "comment_id")
    if per_post:
        rows = rows.withColumn("n_", F.row_number().over(Window.partitionBy("post_id").orderBy(*order[1:]))).where(F.col("n_") <= per_post).drop("n_")
    if posts:
        chosen = rows.select("post_id").distinct().orderBy("post_id").limit(posts)
        rows = rows.join(chosen, "post_id", "left_semi")
    return rows.orderBy(*order).limit(total) if total else rows
