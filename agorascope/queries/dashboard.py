"""The query API under several filters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.operators.filters import Filters, parse
from agorascope.plans import dashboard as d
from agorascope.plans import snapshot, views
from agorascope.queries.base import filtered, r, rounded, sql
from agorascope.sources import tables

FILTERS = {
    "all": parse("all", now=tables.AS_OF),
    "90d": parse("90d", now=tables.AS_OF),
    "year_urgent": parse("365d", "1-URGENT", now=tables.AS_OF),
    "topic": parse("all", None, "topic_3", now=tables.AS_OF),
}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, work: Callable, select: Callable[[Filters], str] | None, filters: tuple[str, ...] = ("all", "90d", "year_urgent", "topic"), alone: bool = False) -> None:
    """work(posts, comments, filters) -> DataFrame, and its SQL over p, c, j."""
    for key in filters:
        f, full = FILTERS[key], name if alone else f"{name}_{key}"
        QUERIES[full] = lambda spark, sf_dir, f=f: rounded(work(*tables.posts_and_comments(spark, sf_dir), f))
        if select:
            ORACLES[full] = sql(select(f), *filtered(f))


LABELED = "(coalesce(stance_label, '') <> '' AND coalesce(sentiment_label, '') <> '')"
register("q1_overview", lambda p, c, f: d.overview(p, c, f), lambda f: f"""
SELECT a.posts, b.comments, b.labeled_comments, {r('CASE WHEN b.comments > 0 THEN b.labeled_comments / b.comments ELSE 0 END')} AS label_coverage,
  {r('b.avg_confidence')} AS avg_confidence, {r('a.avg_comments_per_post')} AS avg_comments_per_post, {r('a.avg_post_upvotes')} AS avg_post_upvotes,
  {r('v.avg_comment_upvotes_per_post')} AS avg_comment_upvotes_per_post, b.deleted_comments, b.low_confidence_comments
FROM (SELECT count(*) AS posts, avg(num_comments) AS avg_comments_per_post, avg(score) AS avg_post_upvotes FROM p) a,
  (SELECT count(*) AS comments, count(*) FILTER (WHERE {LABELED}) AS labeled_comments, avg(llm_confidence) FILTER (WHERE {LABELED}) AS avg_confidence,
    count(*) FILTER (WHERE lower(trim(coalesce(comment_text, ''))) IN ('[deleted]', '[removed]', '')) AS deleted_comments,
    count(*) FILTER (WHERE {LABELED} AND coalesce(llm_confidence < 0.5, true)) AS low_confidence_comments FROM c) b,
  (SELECT avg(s) AS avg_comment_upvotes_per_post FROM (SELECT sum(upvote_score) AS s FROM c GROUP BY post_id)) v""")

MERGED = "CASE WHEN coalesce(stance_label, 'unknown') = 'unclear' THEN 'unknown' ELSE coalesce(stance_label, 'unknown') END"
register("q2_stance_sentiment", lambda p, c, f: d.stance_sentiment(p, c, f), lambda f: f"SELECT {MERGED} AS stance, coalesce(sentiment_label, 'unknown') AS sentiment, count(*) AS count FROM c GROUP BY 1, 2")
register("q2_marginals", lambda p, c, f: d.marginals(d.stance_sentiment(p, c, f)), lambda f: f"SELECT 'stance' AS side, {MERGED} AS label, count(*) AS count FROM c GROUP BY 2 UNION ALL SELECT 'sentiment', coalesce(sentiment_label, 'unknown'), count(*) FROM c GROUP BY 2", ("all",))


def _bucket(f: Filters) -> str:
    return "date_trunc('day', created_at)" if f.days and f.days <= 120 else "date_trunc('week', created_at + INTERVAL 1 DAY) - INTERVAL 1 DAY"


register("q3_trends_stance", lambda p, c, f: d.trends(p, c, f).withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd")), lambda f: f"SELECT strftime({_bucket(f)}, '%Y-%m-%d') AS bucket, {MERGED} AS label, count(*) AS count FROM c WHERE created_utc > 0 GROUP BY 1, 2")
register("q3_trends_sentiment", lambda p, c, f: d.trends(p, c, f, "sentiment").withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd")), lambda f: f"SELECT strftime({_bucket(f)}, '%Y-%m-%d') AS bucket, coalesce(sentiment_label, 'unknown') AS label, count(*) AS count FROM c WHERE created_utc > 0 GROUP BY 1, 2", ("all", "90d"))
register("q4_topics", lambda p, c, f: d.topics(p, f), lambda f: f"""
SELECT topic_id, coalesce(arg_min_null(topic_name, post_id), '') AS topic_name, coalesce(arg_min_null(topic_description, post_id), '') AS topic_description, count(*) AS count,
  {r('avg(num_comments)')} AS avg_comments, {r('avg(score)')} AS avg_score, {r('avg(center_distance)')} AS avg_center_distance
FROM p WHERE topic_id IS NOT NULL GROUP BY topic_id ORDER BY count DESC, topic_id LIMIT 80""")
register("q5_subreddits", lambda p, c, f: d.subreddits(p, f), lambda f: "SELECT * FROM (SELECT subreddit, count(*) AS count FROM p GROUP BY subreddit ORDER BY count DESC, subreddit LIMIT 60) WHERE coalesce(subreddit, '') <> ''")

HAS = "agree IS NOT NULL AND positive IS NOT NULL"
register("q6_opinion_map_posts", lambda p, c, f: d.opinion_map_posts(p, f), lambda f: f"""
SELECT post_id AS id, title AS label, subreddit, topic_id, coalesce(topic_name, '') AS topic_name, num_comments AS size, {r('coalesce(polarization_score, 0)')} AS polarization_score, {r('agree - disagree')} AS x, {r('positive - negative')} AS y
FROM p WHERE {HAS} ORDER BY size DESC, id LIMIT 1500""")
register("q6_opinion_map_topics", lambda p, c, f: d.opinion_map_topics(p, f), lambda f: f"""
SELECT topic_id AS id, coalesce(n, topic_id) AS label, topic_id, coalesce(n, '') AS topic_name, {r('CASE WHEN size > 0 THEN sx / size ELSE 0 END')} AS x, {r('CASE WHEN size > 0 THEN sy / size ELSE 0 END')} AS y, {r('CASE WHEN size > 0 THEN ps / size ELSE 0 END')} AS polarization_score, size
FROM (SELECT topic_id, arg_min_null(topic_name, post_id) AS n, CAST(sum(num_comments) AS BIGINT) AS size, sum((agree - disagree) * num_comments) AS sx, sum((positive - negative) * num_comments) AS sy, sum(coalesce(polarization_score, 0) * num_comments) AS ps FROM p WHERE {HAS} AND topic_id IS NOT NULL GROUP BY topic_id)
ORDER BY size DESC, id LIMIT 80""")
register("q7_umap_landscape", lambda p, c, f: d.umap_landscape(p, f), lambda f: f"""
SELECT post_id AS id, title AS label, subreddit, topic_id, coalesce(topic_name, '') AS topic_name, {r('umap_x')} AS x, {r('umap_y')} AS y, num_comments AS size, {r('coalesce(polarization_score, 0)')} AS polarization_score,
  {r('coalesce(agree, 0) - coalesce(disagree, 0)')} AS stance_balance, {r('coalesce(positive, 0) - coalesce(negative, 0)')} AS sentiment_balance
FROM p WHERE umap_x IS NOT NULL AND umap_y IS NOT NULL ORDER BY size DESC, id LIMIT 2000""")


def _insights(limit: int = 40) -> str:
    mean = lambda x, n: f"{r(f'CASE WHEN total_comments > 0 THEN {x} / total_comments ELSE 0 END')} AS {n}"
    own = {"agree": "stance_agree", "disagree": "stance_disagree", "neutral": "stance_neutral", "positive": "sentiment_positive", "negative": "sentiment_negative", "neutral_sentiment": "sentiment_neutral"}
    return f"""insights AS (
SELECT topic_id, coalesce(n, '') AS topic_name, total_comments, {mean('ps', 'polarization_score')}, {r('CASE WHEN cw > 0 THEN cs / cw END')} AS avg_center_distance,
  {', '.join(mean('s_' + k, v) for k, v in own.items())}, 0.0::DOUBLE AS stance_partial, 0.0::DOUBLE AS stance_unknown, 0.0::DOUBLE AS sentiment_mixed, 0.0::DOUBLE AS sentiment_unknown
FROM (SELECT topic_id, arg_min_null(topic_name, post_id) AS n, CAST(sum(num_comments) AS BIGINT) AS total_comments, sum(coalesce(polarization_score, 0) * num_comments) AS ps, sum(coalesce(center_distance, 0) * num_comments) AS cs,
    sum(CASE WHEN center_distance IS NOT NULL THEN num_comments ELSE 0 END) AS cw, {', '.join(f'sum({k} * num_comments) AS s_{k}' for k in own)}
  FROM p WHERE {HAS} AND topic_id IS NOT NULL GROUP BY topic_id)
ORDER BY polarization_score DESC, topic_id LIMIT {limit})"""


def register_insights(name: str, work: Callable, select: str, filters: tuple[str, ...] = ("all",)) -> None:
    for key in filters:
        f, full = FILTERS[key], name if filters == ("all",) else f"{name}_{key}"
        QUERIES[full] = lambda spark, sf_dir, f=f: rounded(work(d.topic_insights(tables.posts(spark, sf_dir), f)))
        ORACLES[full] = sql(select, *filtered(f), _insights())


register_insights("q8_topic_insights", lambda i: i, "SELECT * FROM insights", ("all", "90d", "year_urgent", "topic"))
KINDS = ["agree", "disagree", "neutral", "partial", "unknown"]
AXES = [f"stance_{k}" for k in KINDS] + [f"sentiment_{k}" for k in ("positive", "negative", "neutral", "mixed", "unknown")]
TOP = "(SELECT * FROM insights ORDER BY total_comments DESC, topic_id LIMIT 12)"
register_insights("view_stacked_bars", views.stacked_bars, " UNION ALL ".join(f"SELECT topic_id, '{k}' AS stance, stance_{k} AS share FROM {TOP}" for k in KINDS))
register_insights("view_fingerprints", views.fingerprints, " UNION ALL ".join(f"SELECT topic_id, '{a}' AS axis, {a} AS value FROM (SELECT * FROM insights ORDER BY polarization_score DESC, topic_id LIMIT 10)" for a in AXES))
register_insights("view_coherence", views.coherence, "SELECT topic_id, polarization_score, avg_center_distance, total_comments FROM insights WHERE avg_center_distance IS NOT NULL")
register_insights("view_mirror_bars", views.mirror_bars, f"SELECT topic_id, stance_agree, 0.0 - stance_disagree AS stance_disagree FROM {TOP}")

register("q9_sankey", lambda p, c, f: d.sankey(p, c, f), lambda f: f"SELECT coalesce(sentiment_label, 'unknown') AS source, {MERGED} AS target, {r('sum(weight)')} AS value FROM c GROUP BY 1, 2")
register("q9_sankey_nodes", lambda p, c, f: d.sankey_nodes(d.sankey(p, c, f)), lambda f: f"SELECT coalesce(sentiment_label, 'unknown') AS name FROM c UNION SELECT {MERGED} FROM c", ("all",))
register("q10_polarization_timeline", lambda p, c, f: d.polarization_timeline(p, c, f), lambda f: f"""
SELECT week, {r('sum(w)')} AS weight, {r('CASE WHEN sum(w) > 0 THEN sum(ps * w) / sum(w) ELSE 0 END')} AS polarization_score, {r('CASE WHEN sum(w) > 0 THEN sum(b * w) / sum(w) ELSE 0 END')} AS sentiment_balance
FROM (SELECT post_id, snapshot_week AS week, sum(weight) AS w, coalesce(any_value(polarization_score), 0) AS ps, coalesce(any_value(positive), 0) - coalesce(any_value(negative), 0) AS b FROM j WHERE snapshot_week IS NOT NULL GROUP BY 1, 2)
GROUP BY week ORDER BY week""")
register("q11_leaderboard_posts", lambda p, c, f: d.leaderboard_posts(p, c, f), lambda f: f"""
SELECT post_id AS id, any_value(title) AS label, any_value(subreddit) AS subreddit, any_value(topic_id) AS topic_id, coalesce(any_value(topic_name), '') AS topic_name, {r('coalesce(any_value(polarization_score), 0)')} AS polarization_score, {r('sum(weight)')} AS comment_weight_sum
FROM j GROUP BY post_id ORDER BY comment_weight_sum DESC, id LIMIT 30""")
register("q11_leaderboard_topics", lambda p, c, f: d.leaderboard_topics(p, c, f), lambda f: f"""
SELECT topic_id AS id, coalesce(arg_min_null(topic_name, post_id), topic_id) AS label, topic_id, coalesce(arg_min_null(topic_name, post_id), '') AS topic_name, {r('sum(weight)')} AS comment_weight_sum,
  {r('CASE WHEN sum(weight) > 0 THEN sum(coalesce(polarization_score, 0) * weight) / sum(weight) ELSE 0 END')} AS polarization_score
FROM j WHERE topic_id IS NOT NULL GROUP BY topic_id ORDER BY comment_weight_sum DESC, id LIMIT 30""")
TOP12 = "top AS (SELECT topic_id, coalesce(arg_min_null(topic_name, post_id), '') AS topic_name, CAST(sum(num_comments) AS BIGINT) AS total_comments FROM p WHERE topic_id IS NOT NULL GROUP BY topic_id ORDER BY total_comments DESC, topic_id LIMIT 12)"
for key, f in FILTERS.items():
    QUERIES[f"q12_topic_heatmap_{key}"] = lambda spark, sf_dir, f=f: rounded(d.topic_heatmap(tables.posts(spark, sf_dir), f))
    ORACLES[f"q12_topic_heatmap_{key}"] = sql(f"""
SELECT topic_id, week, {r('CASE WHEN n > 0 THEN ps / n ELSE 0 END')} AS polarization_score, CASE WHEN a >= b AND a >= u THEN 'agree' WHEN b >= a AND b >= u THEN 'disagree' ELSE 'neutral' END AS dominant_label
FROM (SELECT topic_id, snapshot_week AS week, sum(num_comments) AS n, sum(coalesce(polarization_score, 0) * num_comments) AS ps, round(sum(coalesce(agree, 0) * num_comments), 6) AS a, round(sum(coalesce(disagree, 0) * num_comments), 6) AS b, round(sum(coalesce(neutral, 0) * num_comments), 6) AS u
  FROM p WHERE topic_id IN (SELECT topic_id FROM top) AND snapshot_week IS NOT NULL GROUP BY 1, 2)""", *filtered(f), TOP12)
QUERIES["q12_heatmap_topics"] = lambda spark, sf_dir: d.heatmap_topics(tables.posts(spark, sf_dir), FILTERS["all"])
ORACLES["q12_heatmap_topics"] = sql("SELECT * FROM top", *filtered(FILTERS["all"]), TOP12)
register("q13_snapshot", lambda p, c, f: snapshot.snapshot(p, c, f), None, ("all",), alone=True)
register("q3_trend_series", lambda p, c, f: d.series(d.trends(p, c, f)).select(F.date_format("bucket", "yyyy-MM-dd").alias("bucket"), F.array_join(F.transform(F.map_entries("counts"), lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string"))), ",").alias("counts")),
         lambda f: f"SELECT bucket, string_agg(label || '=' || n, ',' ORDER BY label) AS counts FROM (SELECT strftime({_bucket(f)}, '%Y-%m-%d') AS bucket, {MERGED} AS label, count(*) AS n FROM c WHERE created_utc > 0 GROUP BY 1, 2) GROUP BY bucket", ("90d",), alone=True)
register("view_kpis", lambda p, c, f: views.kpis(d.overview(p, c, f)).where("name in ('posts', 'comments', 'avg_post_upvotes')"), lambda f: f"SELECT 'posts' AS name, CAST(count(*) AS DOUBLE) AS value FROM p UNION ALL SELECT 'comments', CAST(count(*) AS DOUBLE) FROM c UNION ALL SELECT 'avg_post_upvotes', {r('avg(score)')} FROM p", ("all",), alone=True)
register("view_quality_ratios", lambda p, c, f: views.quality_ratios(d.overview(p, c, f)), lambda f: f"""
SELECT {r(f"1 - avg(CASE WHEN {LABELED} THEN 1.0::DOUBLE ELSE 0 END)")} AS unlabeled, {r("avg(CASE WHEN lower(trim(coalesce(comment_text, ''))) IN ('[deleted]', '[removed]', '') THEN 1.0::DOUBLE ELSE 0 END)")} AS deleted,
  {r(f"CAST(count(*) FILTER (WHERE {LABELED} AND coalesce(llm_confidence < 0.5, true)) AS DOUBLE) / count(*) FILTER (WHERE {LABELED})")} AS low_confidence FROM c""", ("all",), alone=True)
register("view_matrix_known", lambda p, c, f: views.matrix_known(d.stance_sentiment(p, c, f)), lambda f: "SELECT stance_label AS stance, sentiment_label AS sentiment, count(*) AS count FROM c WHERE stance_label <> 'unclear' AND sentiment_label IS NOT NULL GROUP BY 1, 2", ("all",), alone=True)
register("view_group_sizes", lambda p, c, f: views.group_sizes(d.umap_landscape(p, f)), lambda f: "SELECT coalesce(nullif(topic_name, ''), topic_id, 'unassigned') AS \"group\", count(*) AS points, CAST(sum(num_comments) AS BIGINT) AS size FROM (SELECT * FROM p WHERE umap_x IS NOT NULL AND umap_y IS NOT NULL ORDER BY num_comments DESC, post_id LIMIT 2000) GROUP BY 1", ("all",), alone=True)
register("view_topic_table", lambda p, c, f: views.topic_table(d.topics(p, f)).select("topic_id", "count", "title"), lambda f: "SELECT topic_id, count(*) AS count, CASE WHEN topic_id = 'noise' THEN 'Noise' ELSE any_value(topic_name) END AS title FROM p WHERE topic_id IS NOT NULL GROUP BY topic_id ORDER BY count DESC, topic_id LIMIT 12", ("all",), alone=True)
register("view_flows", lambda p, c, f: views.prefixed_flows(d.sankey(p, c, f)), lambda f: f"SELECT 'sentiment:' || coalesce(sentiment_label, 'unknown') AS source, 'stance:' || ({MERGED}) AS target, {r('sum(weight)')} AS value FROM c GROUP BY 1, 2", ("all",), alone=True)
register("view_bubbles", lambda p, c, f: views.bubbles(d.opinion_map_topics(p, f)).select("id", "size", "radius"), lambda f: f"SELECT topic_id AS id, CAST(sum(num_comments) AS BIGINT) AS size, {r('5 + sqrt(sum(num_comments) / max(sum(num_comments)) OVER ()) * 22')} AS radius FROM p WHERE {HAS} AND topic_id IS NOT NULL GROUP BY topic_id", ("all",), alone=True)
HASH = "abs(list_reduce(list_prepend(0::BIGINT, list_transform(string_split(topic_id, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda h, x: (h * 31 + x + 139586437120) % 4294967296 - 2147483648))"
register("view_polar_layout", lambda p, c, f: views.polar_layout(d.topics(p, f)), lambda f: f"""
SELECT topic_id, count, {r('240 + cos(angle) * radius')} AS x, {r('190 + sin(angle) * radius')} AS y, {r('6 + sqrt(count / most) * 22')} AS size
FROM (SELECT *, seed % 360 / 360.0::DOUBLE * 2 * pi() AS angle, 40 + coalesce(d, rank / n) / far * 140 + (((seed >> 4) % 100) / 100.0::DOUBLE - 0.5) * 18 AS radius
  FROM (SELECT *, {HASH} AS seed, row_number() OVER (ORDER BY count DESC, topic_id) - 1 AS rank, CAST(count(*) OVER () AS DOUBLE) AS n, greatest(max(coalesce(d, 0)) OVER (), 1) AS far, CAST(max(count) OVER () AS DOUBLE) AS most
    FROM (SELECT topic_id, count(*) AS count, avg(center_distance) AS d FROM p WHERE topic_id IS NOT NULL GROUP BY topic_id ORDER BY count DESC, topic_id LIMIT 42)))""", ("all",), alone=True)
#: The snapshot's documents, read back: what differs from the queries above is that unclear stays apart from unknown.
_DATES = lambda df: df.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd"))
UNMERGED = "coalesce(stance_label, 'unknown')"
DOCUMENTS: dict[str, tuple[str, Callable]] = {
    "overview": (ORACLES["q1_overview_all"], lambda x: x), "trends_sentiment": (ORACLES["q3_trends_sentiment_all"], _DATES), "topics": (ORACLES["q4_topics_all"], lambda x: x), "subreddits": (ORACLES["q5_subreddits_all"], lambda x: x),
    "opinion_map": (ORACLES["q6_opinion_map_posts_all"], lambda x: x), "umap_landscape": (ORACLES["q7_umap_landscape_all"], lambda x: x), "topic_insights": (ORACLES["q8_topic_insights_all"], lambda x: x), "sankey": (ORACLES["q9_sankey_all"], lambda x: x),
    "polarization_timeline": (ORACLES["q10_polarization_timeline_all"], lambda x: x), "controversy_leaderboard": (ORACLES["q11_leaderboard_posts_all"], lambda x: x), "topic_heatmap": (ORACLES["q12_topic_heatmap_all"], lambda x: x),
    "stance_sentiment": (sql(f"SELECT {UNMERGED} AS stance, coalesce(sentiment_label, 'unknown') AS sentiment, count(*) AS count FROM c GROUP BY 1, 2", *filtered(FILTERS["all"])), lambda x: x),
    "trends_stance": (sql(f"SELECT strftime({_bucket(FILTERS['all'])}, '%Y-%m-%d') AS bucket, {UNMERGED} AS label, count(*) AS count FROM c WHERE created_utc > 0 GROUP BY 1, 2", *filtered(FILTERS["all"])), _DATES),
}


def _document(name: str, shown: Callable) -> Callable:
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = snapshot.results(*tables.posts_and_comments(spark, sf_dir), FILTERS["all"])[name]
        return rounded(shown(snapshot.read_back(snapshot.document(name, df), df)))

    return read


for name, (text, shown) in DOCUMENTS.items():
    QUERIES[f"q13_document_{name}"], ORACLES[f"q13_document_{name}"] = _document(name, shown), text
SIZES = {
    "overview": "1", "stance_sentiment": "(SELECT count(*) FROM (SELECT DISTINCT stance_label, sentiment_label FROM c))", "trends_stance": f"(SELECT count(*) FROM (SELECT DISTINCT {_bucket(FILTERS['all'])}, stance_label FROM c WHERE created_utc > 0))",
    "trends_sentiment": f"(SELECT count(*) FROM (SELECT DISTINCT {_bucket(FILTERS['all'])}, sentiment_label FROM c WHERE created_utc > 0))", "topics": "(SELECT least(80, count(DISTINCT topic_id)) FROM p)", "subreddits": "(SELECT least(60, count(DISTINCT subreddit)) FROM p)",
    "opinion_map": f"(SELECT least(1500, count(*)) FROM p WHERE {HAS})", "umap_landscape": "(SELECT least(2000, count(*)) FROM p WHERE umap_x IS NOT NULL AND umap_y IS NOT NULL)", "topic_insights": f"(SELECT least(40, count(DISTINCT topic_id)) FROM p WHERE {HAS})",
    "sankey": f"(SELECT count(*) FROM (SELECT DISTINCT coalesce(sentiment_label, 'unknown'), {MERGED} FROM c))", "polarization_timeline": "(SELECT count(DISTINCT snapshot_week) FROM j)", "controversy_leaderboard": "(SELECT least(30, count(DISTINCT post_id)) FROM j)",
    "topic_heatmap": "(SELECT count(*) FROM (SELECT DISTINCT topic_id, snapshot_week FROM p WHERE topic_id IN (SELECT topic_id FROM top)))",
}
QUERIES["q13_snapshot_sizes"] = lambda spark, sf_dir: snapshot.snapshot(*tables.posts_and_comments(spark, sf_dir), FILTERS["all"]).select("name", "rows", F.size(F.from_json("document", "array<string>")).cast("long").alias("parsed"))
ORACLES["q13_snapshot_sizes"] = sql(" UNION ALL ".join(f"SELECT '{n}' AS name, CAST({x} AS BIGINT) AS rows, CAST({x} AS BIGINT) AS parsed" for n, x in SIZES.items()), *filtered(FILTERS["all"]), TOP12)
