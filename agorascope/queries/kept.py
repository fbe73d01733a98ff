"""Tables that are kept and changed in place: roll-ups of the query API, upserts by bucket, windows of time."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.operators import merge, neighbours
from agorascope.plans.rollup import DAY, Rollups
from agorascope.queries import dashboard
from agorascope.queries.base import COMMENTS, r, rounded, sql
from agorascope.sources import store, tables
from agorascope.sources.versioned import Keyed
from agorascope.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        if oracle:
            ORACLES[f.__name__] = oracle
        return f

    return add


# --- roll-ups: the query API from partial states, with the SQL of the rows


def rollups(spark: SparkSession, sf_dir: str) -> Rollups:
    """Those of the landed posts and comments, made once for their files."""
    at = tables.version(spark, sf_dir)
    posts, comments = tables.posts(spark, sf_dir, at), tables.weighted_comments(spark, sf_dir, at)
    held = Rollups(spark, f"{store.shared_dir(spark)}/rollups/{at}", posts, comments)
    held.refresh(names=tuple(n for n in ("comment_cells", "post_days", "post_cells") if not held.table(n).version()))
    return held


def _dates(df: DataFrame) -> DataFrame:
    return df.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd"))


ROLLED: dict[str, Callable] = {
    "q1_overview": lambda r, f: r.overview(f),
    "q2_stance_sentiment": lambda r, f: r.stance_sentiment(f),
    "q3_trends_stance": lambda r, f: _dates(r.trends(f)),
    "q4_topics": lambda r, f: r.topics(f),
    "q5_subreddits": lambda r, f: r.subreddits(f),
    "q6_opinion_map_topics": lambda r, f: r.opinion_map_topics(f),
    "q8_topic_insights": lambda r, f: r.topic_insights(f),
    "q9_sankey": lambda r, f: r.sankey(f),
    "q10_polarization_timeline": lambda r, f: r.polarization_timeline(f),
    "q11_leaderboard_posts": lambda r, f: r.leaderboard_posts(f),
    "q11_leaderboard_topics": lambda r, f: r.leaderboard_topics(f),
    "q12_topic_heatmap": lambda r, f: r.topic_heatmap(f),
}
for name, work in ROLLED.items():
    for key in ("90d", "year_urgent", "topic"):
        QUERIES[f"rollup_{name}_{key}"] = lambda spark, sf_dir, work=work, f=dashboard.FILTERS[key]: rounded(work(rollups(spark, sf_dir), f))
        ORACLES[f"rollup_{name}_{key}"] = dashboard.ORACLES[f"{name}_{key}"]

#: A day of comments that comes after the others: 1995-06-14.
LATE_DAY = 9295 * DAY


@query(sql(f"SELECT {dashboard.MERGED} AS stance, coalesce(sentiment_label, 'unknown') AS sentiment, count(*) AS count, CAST(1 AS BIGINT) AS weeks_written FROM comments GROUP BY 1, 2"))
def rollup_refreshed(spark, sf_dir):
    """Roll-ups without one day's comments, then with them: only the day's week is written again."""
    posts, comments = tables.posts_and_comments(spark, sf_dir)
    late = F.col("created_utc").between(LATE_DAY, LATE_DAY + DAY - 1)
    path = f"{store.shared_dir(spark)}/rollups/refreshed-{uuid.uuid4().hex}"
    Rollups(spark, path, posts, comments.where(~late)).refresh(names=("comment_cells",))
    after = Rollups(spark, path, posts, comments)
    weeks = after.refresh(after.weeks_of(comments.where(late)), ("comment_cells",), ("days", LATE_DAY))["comment_cells"]
    return after.stance_sentiment(dashboard.FILTERS["all"]).withColumn("weeks_written", F.lit(len(weeks)).cast("long"))


# --- upserts by bucket


@query("""
SELECT o_orderkey AS post_id, CASE WHEN o_orderkey % 100 = 7 THEN 'late' WHEN o_orderkey % 5 = 0 THEN 'new' ELSE o_orderstatus END AS category,
  CASE WHEN o_orderkey % 100 = 7 THEN -1 WHEN o_orderkey % 5 = 0 THEN NULL ELSE round(o_totalprice, 2) END AS score, o_orderdate AS created_at,
  CASE WHEN o_orderkey % 100 = 7 THEN TIMESTAMP '2002-01-02' WHEN o_orderkey % 5 = 0 THEN TIMESTAMP '2002-01-01' END AS updated_at FROM orders
UNION ALL SELECT -o_orderkey - 1, CASE WHEN o_orderkey % 100 = 5 THEN 'late' ELSE 'new' END, CASE WHEN o_orderkey % 100 = 5 THEN -1 END, TIMESTAMP '2002-01-01',
  CASE WHEN o_orderkey % 100 = 5 THEN TIMESTAMP '2002-01-02' ELSE TIMESTAMP '2002-01-01' END FROM orders WHERE o_orderkey % 5 = 0
""")
def upserted_by_bucket(spark, sf_dir):
    """Two batches into a table of buckets, the second of few keys, old and new."""
    first = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post_id"), F.col("o_orderstatus").alias("category"), F.round("o_totalprice", 2).alias("score"), F.col("o_orderdate").cast("timestamp").alias("created_at"), F.lit(None).cast("timestamp").alias("updated_at"))
    table = Keyed(spark, f"{store.shared_dir(spark)}/upserted-{uuid.uuid4().hex}", first.schema, "post_id", 32)
    table.apply(first, lambda old, new: new)
    some = first.where("post_id % 5 = 0").select("post_id", F.lit("new").alias("category"), F.lit(None).cast("double").alias("score"))
    batch = lambda rows, day: table.apply(rows, lambda old, new: merge.upsert(old, new, "post_id", F.lit(f"2002-01-0{day}").cast("timestamp")), ("batches", day))
    batch(some.unionByName(some.withColumn("post_id", -F.col("post_id") - 1)), 1)
    few = first.select(F.explode(F.expr("filter(array(if(post_id % 100 = 7, post_id, null), if(post_id % 100 = 5, -post_id - 1, null)), x -> x is not null)")).alias("post_id"), F.lit("late").alias("category"), F.lit(-1.0).alias("score"))
    batch(few, 2)
    batch(few.withColumn("score", F.lit(-5.0)), 2)  # a batch that is run again changes nothing
    return table.read()


# --- windows of event time, the batch twins of the streams


@query(f"""WITH {COMMENTS}, h AS (SELECT *, CASE WHEN created_utc - lag(created_utc) OVER (PARTITION BY post_id ORDER BY created_utc) <= 10 * 86400 THEN 0 ELSE 1 END AS head FROM comments),
g AS (SELECT *, sum(head) OVER (PARTITION BY post_id ORDER BY created_utc) AS n FROM h)
SELECT post_id, min(created_utc) AS begins, max(created_utc) + 10 * 86400 AS ends, count(*) AS comments, CAST(sum(upvote_score) AS BIGINT) AS votes FROM g GROUP BY post_id, n""")
def comment_sessions(spark, sf_dir):
    found = incremental.sessions(tables.comments(spark, sf_dir), "10 days")
    return found.withColumns({"begins": F.unix_seconds("begins"), "ends": F.unix_seconds("ends")})


@query(f"WITH {COMMENTS}, d AS (SELECT date_trunc('day', created_at) - to_days(CAST(k AS INTEGER)) AS b, {dashboard.MERGED} AS label FROM comments, (SELECT unnest(range(7)) AS k)) SELECT strftime(b, '%Y-%m-%d') AS begins, label, count(*) AS count FROM d GROUP BY 1, 2")
def sliding_trends(spark, sf_dir):
    found = incremental.sliding(tables.comments(spark, sf_dir))
    return found.select(F.date_format("begins", "yyyy-MM-dd").alias("begins"), "label", "count")


# --- nearest neighbours


@query(f"""WITH v AS (SELECT CAST(vec_id AS VARCHAR) AS id, vec_id, embedding::DOUBLE[] AS e FROM embeddings),
d AS (SELECT q.id AS post_id, r.id AS neighbour, sqrt(list_sum(list_transform(list_zip(q.e, r.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))) AS distance FROM v q, v r WHERE q.vec_id % 50 = 0)
SELECT post_id, CAST(row_number() OVER (PARTITION BY post_id ORDER BY distance, neighbour) AS INTEGER) AS rank, neighbour, {r('distance')} AS distance FROM d QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY distance, neighbour) <= 15""")
def nearest_search(spark, sf_dir):
    """Every fiftieth vector against all, all lists asked, so exact."""
    rows = tables.vectors(spark, sf_dir)
    return neighbours.search(rows.where("cast(post_id as long) % 50 = 0"), rows, probes=None)


@query()
def nearest_graph(spark, sf_dir):
    """The 15 nearest of each vector among the lists nearest to it; tests measure its recall."""
    return neighbours.graph(tables.vectors(spark, sf_dir))
