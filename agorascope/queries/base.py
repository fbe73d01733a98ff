"""The tables of sources.tables as SQL, and helpers for both sides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.operators.filters import Filters


def rounded(df: DataFrame) -> DataFrame:
    """Doubles at six decimals, no negative zero: sums differ in their last bits by order."""
    return df.select(*[(F.round(c, 6) + F.lit(0.0)).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


def r(expr: str) -> str:
    return f"(round({expr}, 6) + 0.0)"


COMMENTS = """comments AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(round(l_extendedprice * 100) AS BIGINT), date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) AS comment_id,
    CAST(l_orderkey AS VARCHAR) AS post_id,
    CASE WHEN l_suppkey % 13 = 0 THEN NULL WHEN l_suppkey % 11 = 0 THEN ' [Deleted] ' ELSE concat('part ', l_partkey, ' of ', l_suppkey) END AS comment_text,
    CAST(l_quantity AS BIGINT) AS upvote_score,
    CAST(epoch(l_shipdate) AS BIGINT) AS created_utc, l_shipdate AS created_at,
    CASE l_returnflag WHEN 'A' THEN 'agree' WHEN 'R' THEN 'disagree' ELSE CASE l_partkey % 3 WHEN 0 THEN 'unclear' WHEN 1 THEN 'neutral' END END AS stance_label,
    CASE l_linestatus WHEN 'F' THEN CASE l_suppkey % 4 WHEN 0 THEN 'positive' WHEN 1 THEN 'negative' WHEN 2 THEN 'neutral' END
      ELSE CASE l_suppkey % 4 WHEN 0 THEN 'negative' WHEN 1 THEN 'positive' WHEN 2 THEN 'mixed' ELSE 'neutral' END END AS sentiment_label,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE round(1 - l_discount * 8, 2) END AS llm_confidence,
    (1 + ln(1 + greatest(0, CAST(l_quantity AS BIGINT)))) * (0.5::DOUBLE + 0.5::DOUBLE * CASE WHEN l_linenumber = 7 THEN 1 ELSE least(1, greatest(0, round(1 - l_discount * 8, 2))) END) AS weight
  FROM lineitem
)"""


def distribution(unknown: str = "drop", name: str = "dist") -> str:
    """Distributions per post as flat columns."""
    stance = f"CASE WHEN stance_label IN ('agree', 'disagree', 'neutral') THEN stance_label {'WHEN stance_label IS NOT NULL THEN ' + chr(39) + 'neutral' + chr(39) if unknown == 'neutral' else ''} END"
    sentiment = f"CASE WHEN sentiment_label IN ('positive', 'negative', 'neutral') THEN sentiment_label {'WHEN sentiment_label IS NOT NULL THEN ' + chr(39) + 'neutral' + chr(39) if unknown == 'neutral' else ''} END"
    share = lambda c, k: f"coalesce(sum(weight) FILTER (WHERE {c} = '{k}'), 0) / nullif(sum(weight) FILTER (WHERE {c} IS NOT NULL), 0)"
    return f"""{name}_labels AS (SELECT post_id, weight, {stance} AS s, {sentiment} AS e FROM comments),
{name}_shares AS (
  SELECT post_id, {share('s', 'agree')} AS agree, {share('s', 'disagree')} AS disagree, {share('s', 'neutral')} AS neutral,
    {share('e', 'positive')} AS positive, {share('e', 'negative')} AS negative, {share('e', 'neutral')} AS neutral_sentiment,
    count(s) AS stance_count, count(e) AS sentiment_count
  FROM {name}_labels GROUP BY post_id),
{name} AS (
  SELECT *, CASE WHEN stance_count >= 5 THEN greatest(0, least(1, (1 - neutral) * (1 - abs(agree - disagree) / greatest(agree + disagree, 1e-9)))) END AS polarization_score
  FROM {name}_shares)"""


POSTS = """posts AS (
  SELECT p.*, d.agree, d.disagree, d.neutral, d.positive, d.negative, d.neutral_sentiment, d.polarization_score FROM (
    SELECT CAST(o_orderkey AS VARCHAR) AS post_id, o_orderpriority AS subreddit, o_orderstatus AS category, concat('Order ', o_orderkey) AS title,
      CAST(floor(o_totalprice / 1000) AS BIGINT) AS score, CAST(epoch(o_orderdate) AS BIGINT) AS created_utc,
      CASE WHEN o_orderkey % 17 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'noise' ELSE concat('topic_', o_custkey % 12 + 1) END AS topic_id,
      CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE concat('Topic ', o_custkey % 12 + 1) END AS topic_name,
      CASE WHEN o_orderkey % 17 = 0 OR o_orderkey % 11 = 0 THEN NULL ELSE concat('Topic ', o_custkey % 12 + 1, ' of orders') END AS topic_description,
      coalesce(n, 0) AS num_comments,
      CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE (o_custkey % 100) / 10.0::DOUBLE - 5 END AS umap_x,
      CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE (o_orderkey % 100) / 10.0::DOUBLE - 5 END AS umap_y,
      CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE (o_custkey % 50) / 50.0::DOUBLE END AS center_distance,
      strftime(o_orderdate, '%G-W%V') AS snapshot_week
    FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey) ON o_orderkey = l_orderkey) p
  LEFT JOIN dist d ON p.post_id = d.post_id
)"""
WITH = f"WITH {COMMENTS},\n{distribution()},\n{POSTS}"


def sql(select: str, *more: str) -> str:
    return ",\n".join([WITH, *more]) + "\n" + select


def post_where(f: Filters, time: bool = True, extra: str = "") -> str:
    parts = ([f"created_utc >= {f.since}"] if f.since and time else []) + ([f"subreddit = '{f.subreddit}'"] if f.subreddit else []) + ([f"topic_id = '{f.topic}'"] if f.topic else []) + ([extra] if extra else [])
    return " WHERE " + " AND ".join(parts) if parts else ""


def filtered(f: Filters) -> tuple[str, str, str]:
    """CTEs p (posts), c (comments), j (comments with their posts' columns) under the filters."""
    time = f" WHERE created_utc >= {f.since}" if f.since else ""
    c = f"c AS (SELECT * FROM comments{time})" if not (f.subreddit or f.topic) else f"c AS (SELECT c0.* FROM (SELECT * FROM comments{time}) c0 JOIN (SELECT post_id FROM posts{post_where(f, False)}) p0 ON c0.post_id = p0.post_id)"
    j = f"j AS (SELECT c0.weight, p0.* FROM (SELECT * FROM comments{time}) c0 JOIN (SELECT * FROM posts{post_where(f, False)}) p0 ON c0.post_id = p0.post_id)"
    return f"p AS (SELECT * FROM posts{post_where(f)})", c, j
