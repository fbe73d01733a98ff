"""Posts and comments derived from the relational test tables, with fixed rules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.functions import timeutil
from agorascope.sources import store

#: The moment that ranges of days count back from; never the clock.
AS_OF = 996_624_000


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A comment per lineitem; no weight yet."""
    e = F.expr
    return read(spark, sf_dir, "lineitem").select(
        e("concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, cast(round(l_extendedprice * 100) as bigint), datediff(l_shipdate, date '1970-01-01'))").alias("comment_id"),
        e("cast(l_orderkey as string)").alias("post_id"),
        e("case when l_suppkey % 13 = 0 then null when l_suppkey % 11 = 0 then ' [Deleted] ' else concat('part ', l_partkey, ' of ', l_suppkey) end").alias("comment_text"),
        e("cast(l_quantity as bigint)").alias("upvote_score"),
        e("unix_seconds(cast(l_shipdate as timestamp))").alias("created_utc"),
        e("case l_returnflag when 'A' then 'agree' when 'R' then 'disagree' else case l_partkey % 3 when 0 then 'unclear' when 1 then 'neutral' end end").alias("stance_label"),
        e("case l_linestatus when 'F' then case l_suppkey % 4 when 0 then 'positive' when 1 then 'negative' when 2 then 'neutral' end else case l_suppkey % 4 when 0 then 'negative' when 1 then 'positive' when 2 then 'mixed' else 'neutral' end end").alias("sentiment_label"),
        e("case when l_linenumber = 7 then null else round(1 - l_discount * 8, 2) end").alias("llm_confidence"),
    )


def bare_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A post per order, without distributions."""
    e = F.expr
    count = read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("num_comments"))
    rows = read(spark, sf_dir, "orders").join(count, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    topic = "case when o_orderkey % 17 = 0 then null when o_orderkey % 11 = 0 then 'noise' else concat('topic_', o_custkey % 12 + 1) end"
    rows = rows.select(
        e("cast(o_orderkey as string)").alias("post_id"),
        F.col("o_orderpriority").alias("subreddit"),
        F.col("o_orderstatus").alias("category"),
        e("concat('Order ', o_orderkey)").alias("title"),
        e("cast(floor(o_totalprice / 1000) as bigint)").alias("score"),
        e("unix_seconds(cast(o_orderdate as timestamp))").alias("created_utc"),
        e(topic).alias("topic_id"),
        e("coalesce(num_comments, 0)").alias("num_comments"),
        e("case when o_orderkey % 7 = 0 then null else (o_custkey % 100) / 10.0D - 5 end").alias("umap_x"),
        e("case when o_orderkey % 9 = 0 then null else (o_orderkey % 100) / 10.0D - 5 end").alias("umap_y"),
        e("case when o_orderkey % 5 = 0 then null else (o_custkey % 50) / 50.0D end").alias("center_distance"),
    )
    named = F.when(F.col("topic_id").startswith("topic_"), F.concat(F.lit("Topic "), F.substring("topic_id", 7, 9)))
    return rows.withColumns({"topic_name": named, "topic_description": F.concat(named, F.lit(" of orders")), "snapshot_week": timeutil.snapshot_week(F.col("created_utc"))})


def _size(spark: SparkSession, sf_dir: str) -> int:
    """Bytes of both inputs: tables made from them have as many buckets each, so they join without a shuffle."""
    return sum(store.size_of(read(spark, sf_dir, name)) for name in ("lineitem", "orders"))


def sources(sf_dir: str) -> list[str]:
    """The files that posts and comments are made of."""
    return [f"{sf_dir}/{name}.parquet" for name in ("lineitem", "orders")]


def version(spark: SparkSession, sf_dir: str) -> str:
    """The fingerprint of these files, as they are now, and of the code that reads them."""
    return store.fingerprint(spark, *sources(sf_dir), more=store.code_digest())


def _landed(spark: SparkSession, name: str, sf_dir: str, at: str | None, build: Callable[[], DataFrame]) -> DataFrame:
    return store.landed(spark, name, sources(sf_dir), at or version(spark, sf_dir), _size(spark, sf_dir), "post_id", build)


def posts(spark: SparkSession, sf_dir: str, at: str | None = None) -> DataFrame:
    """Posts with distributions and polarization from their comments, as a landed table. at: the version, if it is known."""
    from agorascope.operators.weights import post_distribution

    at = at or version(spark, sf_dir)

    def build() -> DataFrame:
        found = post_distribution(weighted_comments(spark, sf_dir, at), weighted=True).drop("stance_count", "sentiment_count")
        return bare_posts(spark, sf_dir).join(found, "post_id", "left")

    return _landed(spark, "posts", sf_dir, at, build)


def weighted_comments(spark: SparkSession, sf_dir: str, at: str | None = None) -> DataFrame:
    """Comments with their weights, as a landed table."""
    from agorascope.operators.weights import with_weight

    return _landed(spark, "comments", sf_dir, at, lambda: with_weight(comments(spark, sf_dir)))


def posts_and_comments(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Both landed tables at one version of their files."""
    at = version(spark, sf_dir)
    return posts(spark, sf_dir, at), weighted_comments(spark, sf_dir, at)


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as posts."""
    return read(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("post_id"), F.col("source").alias("subreddit"), F.col("text").alias("selftext"), "lang", F.col("n_chars").alias("score"))


def threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as comments of posts."""
    return read(spark, sf_dir, "conversations").select(F.col("conv_id").cast("string").alias("post_id"), F.concat_ws("-", "conv_id", "turn").alias("comment_id"), F.col("role").alias("author"), F.col("text").alias("comment_text"), F.col("turn").alias("seq"))


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "embeddings").select(F.col("vec_id").cast("string").alias("post_id"), "embedding", "label")
