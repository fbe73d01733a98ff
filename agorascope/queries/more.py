"""Further operators one by one over the test tables: scans, writes, predicates, samples, texts and replies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.functions import jsontext, labels, text, timeutil, vectors
from agorascope.operators import cluster, filters, ingest, merge, quality, sampling, sets
from agorascope.plans import inference
from agorascope.queries.base import COMMENTS, r, rounded, sql
from agorascope.sources import files, scan, tables

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str):
    def add(f: Callable[[SparkSession, str], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: rounded(f(spark, sf_dir))
        ORACLES[f.__name__] = oracle
        return f

    return add


# --- scans

@query(f"WITH {COMMENTS} SELECT comment_id, post_id, upvote_score, stance_label, sentiment_label, llm_confidence FROM comments ORDER BY comment_id LIMIT 300 OFFSET 70")
def scanned_comments(spark, sf_dir):
    return scan.scan_comments(tables.comments(spark, sf_dir), skip=70, limit=300)


@query(sql(f"SELECT post_id, {r('log10(greatest(abs(score), 1)) * sign(score) + created_utc / 45000.0::DOUBLE')} AS heat FROM posts ORDER BY log10(greatest(abs(score), 1)) * sign(score) + created_utc / 45000.0::DOUBLE DESC, post_id LIMIT 100"))
def listing_hot(spark, sf_dir):
    heat = F.signum("score") * F.log10(F.greatest(F.abs("score"), F.lit(1))) + F.col("created_utc") / 45_000
    return scan.listing(tables.bare_posts(spark, sf_dir), "hot", 100, tables.AS_OF).select("post_id", heat.alias("heat"))


@query(sql("SELECT post_id, created_utc FROM posts ORDER BY created_utc DESC, post_id LIMIT 100"))
def listing_new(spark, sf_dir):
    return scan.listing(tables.bare_posts(spark, sf_dir), "new", 100, tables.AS_OF).select("post_id", "created_utc")


@query(sql("SELECT post_id, coalesce(subreddit, '') AS subreddit, title, '' AS selftext, score, num_comments, strftime(to_timestamp(created_utc) AT TIME ZONE 'UTC', '%Y-%m-%dT%H:%M:%SZ') AS created_at FROM posts"))
def exported_posts(spark, sf_dir):
    return scan.export_posts(tables.bare_posts(spark, sf_dir).withColumnRenamed("post_id", "id"))


# --- writes as new states

RAW_POSTS = "SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderpriority AS subreddit, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE concat('Order ', o_orderkey) END AS title, CASE WHEN o_orderkey % 6 = 0 THEN 'x' ELSE CAST(floor(o_totalprice) AS VARCHAR) END AS score, CAST(epoch(o_orderdate) AS BIGINT) AS created_utc, o_orderdate FROM orders"


def _raw_posts(spark, sf_dir) -> DataFrame:
    e = F.expr
    return tables.read(spark, sf_dir, "orders").select(e("cast(o_orderkey as string)").alias("id"), F.col("o_orderpriority").alias("subreddit"), e("case when o_orderkey % 4 <> 0 then concat('Order ', o_orderkey) end").alias("title"), e("case when o_orderkey % 6 = 0 then 'x' else cast(cast(floor(o_totalprice) as bigint) as string) end").alias("score"), e("unix_seconds(cast(o_orderdate as timestamp))").alias("created_utc"))


@query(f"SELECT id AS post_id, subreddit, coalesce(title, '') AS title, '' AS selftext, coalesce(TRY_CAST(score AS BIGINT), 0) AS score, 0::BIGINT AS num_comments, created_utc, CAST(NULL AS VARCHAR) AS topic_id, strftime(o_orderdate, '%G-W%V') AS snapshot_week FROM ({RAW_POSTS})")
def stored_posts(spark, sf_dir):
    """Posts as they are stored, with older names and defaults."""
    return merge.post_rows(_raw_posts(spark, sf_dir)).select("post_id", "subreddit", "title", "selftext", "score", "num_comments", "created_utc", "topic_id", "snapshot_week")


@query(f"WITH {COMMENTS} SELECT comment_id, post_id, CASE WHEN upvote_score % 2 = 0 THEN '' ELSE coalesce(comment_text, '') END AS comment_text, CASE WHEN upvote_score % 2 = 0 THEN NULL ELSE stance_label END AS stance_label, upvote_score, llm_confidence, upvote_score % 2 = 0 AS renewed FROM comments UNION ALL SELECT comment_id || '-new', post_id, '', NULL, upvote_score, NULL, true FROM comments WHERE upvote_score % 10 = 0")
def upserted_comments(spark, sf_dir):
    """Half of the comments come again by older names and without labels: labels are reset, confidences stay."""
    old = tables.comments(spark, sf_dir).withColumns({"comment_text": F.coalesce("comment_text", F.lit("")), "renewed": F.lit(False), "updated_at": F.lit(None).cast("timestamp")})
    again = old.where("upvote_score % 2 = 0").select(F.col("comment_id").alias("id"), "post_id", F.col("upvote_score").alias("score"), "created_utc", F.lit("").alias("body"))
    new = again.unionByName(again.where("score % 10 = 0").withColumn("id", F.concat("id", F.lit("-new")))).unionByName(again.limit(5).withColumn("post_id", F.lit("")))
    found = merge.upsert(old, merge.comment_rows(new), "comment_id", F.lit("2002-01-01").cast("timestamp"), keep=["llm_confidence"])
    return found.select("comment_id", "post_id", "comment_text", "stance_label", "upvote_score", "llm_confidence", F.col("updated_at").isNotNull().alias("renewed"))


@query("SELECT (SELECT count(*) FROM (SELECT DISTINCT conv_id FROM conversations)) AS posts, (SELECT count(*) FROM conversations) AS comments, CAST((SELECT count(*) + (SELECT count(DISTINCT conv_id) FROM conversations WHERE conv_id % 2 = 1) FROM conversations WHERE conv_id % 2 = 0 AND false) AS BIGINT) AS old_posts")
def upserted_threads(spark, sf_dir):
    """Raw posts with nested comments into two tables; comments get their parent's id."""
    turns = tables.threads(spark, sf_dir)
    raw = turns.groupBy(F.col("post_id").alias("id")).agg(F.collect_list(F.struct(F.col("comment_id").alias("id"), F.col("comment_text").alias("body"), F.lit("").alias("post_id"))).alias("comments"))
    posts, comments = merge.post_rows(raw.drop("comments")).where("cast(post_id as long) % 2 = 1"), merge.comment_rows(turns).limit(0)
    new_posts, new_comments, counts = merge.upsert_posts_and_comments(posts, comments.withColumn("llm_confidence", F.lit(None).cast("double")), raw, F.lit("t"))
    whole = new_comments.join(turns.select("comment_id", F.col("post_id").alias("parent")), "comment_id").where("post_id = parent").count()
    old = posts.join(new_posts, "post_id", "left_anti").count()
    return counts.select(F.col("posts"), F.when(F.col("comments") == whole, F.col("comments")).otherwise(F.lit(-1)).alias("comments"), (F.lit(old).cast("long") + posts.count()).alias("old_posts"))


@query(sql("SELECT post_id, CASE WHEN CAST(post_id AS BIGINT) % 4 IN (0, 1) THEN round(CAST(post_id AS BIGINT) / 8.0::DOUBLE, 6) ELSE round(center_distance, 6) END AS center_distance FROM posts"))
def updated_distances(spark, sf_dir):
    """Keyed updates: values that are no finite numbers change nothing."""
    posts = tables.bare_posts(spark, sf_dir)
    id_ = F.col("post_id").cast("long")
    value = F.when(id_ % 4 <= 1, id_ / 8).when(id_ % 4 == 2, F.lit(float("nan"))).otherwise(F.lit(float("inf")))
    return merge.update(posts, posts.select("post_id", value.alias("center_distance")), "post_id", only_finite=True).select("post_id", "center_distance")


@query(sql("SELECT post_id, topic_id, CASE WHEN topic_id = 'topic_3' THEN 'Three' WHEN topic_id = 'noise' THEN NULL ELSE topic_name END AS topic_name, CASE WHEN topic_id = 'topic_3' THEN 0.75 END AS confidence, CASE WHEN topic_id = 'noise' THEN NULL ELSE round(center_distance, 6) END AS center_distance FROM posts"))
def labelled_topics(spark, sf_dir):
    """Names of a topic on all its posts; fields of noise are unset."""
    posts = tables.bare_posts(spark, sf_dir).withColumn("confidence", F.lit(None).cast("double"))
    new = spark.range(1).select(F.lit("topic_3").alias("topic_id"), F.lit("Three").alias("topic_name"), F.lit(0.75).alias("confidence"))
    return merge.unset_noise(merge.set_topic_labels(posts, new), ["topic_name", "center_distance"]).select("post_id", "topic_id", "topic_name", "confidence", "center_distance")


@query("SELECT CAST(vec_id AS VARCHAR) AS post_id, CASE WHEN label = 0 THEN 'old' ELSE concat('noise_', label) END AS topic_id FROM embeddings")
def noise_topics(spark, sf_dir):
    """The noise variant: what stays noise keeps its topic."""
    rows = tables.vectors(spark, sf_dir).withColumn("label", F.when(F.col("label") == 0, -1).otherwise(F.col("label")))
    names = rows.where("label > 0").select("label", F.concat(F.lit("noise_"), "label").alias("topic_id")).distinct()
    return merge.set_topics(rows.select("post_id", F.lit("old").alias("topic_id")), rows.select("post_id", "label"), names, noise=None).select("post_id", "topic_id")


@query("SELECT CAST(vec_id AS VARCHAR) AS post_id, CASE WHEN vec_id % 2 = 0 THEN 'm' END AS embedding_model, CASE WHEN vec_id % 2 = 0 THEN CAST(len(embedding) AS INTEGER) END AS embedding_dim, CASE WHEN vec_id % 3 = 0 THEN CAST(vec_id AS DOUBLE) END AS umap_x, CASE WHEN vec_id % 3 = 0 THEN vec_id / 2.0::DOUBLE END AS umap_y, CASE WHEN vec_id % 3 = 0 THEN 3 END AS wide FROM embeddings")
def saved_vectors(spark, sf_dir):
    """Embeddings, their model and projections written back to posts."""
    own = tables.vectors(spark, sf_dir)
    id_ = F.col("post_id").cast("long")
    posts = own.select("post_id", F.lit(None).cast("array<float>").alias("embedding"))
    posts = merge.save_embeddings(posts, own.where(id_ % 2 == 0).select("post_id", "embedding"), "m")
    some = own.where(id_ % 3 == 0)
    posts = merge.save_projection(posts, some.select("post_id", F.array(id_.cast("double"), id_ / 2).alias("projected")), some.select("post_id", F.array(*[F.lit(0.5)] * 3).alias("projected")))
    return posts.select("post_id", "embedding_model", "embedding_dim", "umap_x", "umap_y", F.when(F.col("umap_50d").isNotNull(), F.size("umap_50d")).alias("wide"))


# --- predicates

BODY = "CASE CAST(o_orderkey AS BIGINT) % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '   ' WHEN 3 THEN repeat('long text ', 12) ELSE 'short' END"


@query(f"SELECT o_orderkey AS post_id, b IS NOT NULL AND b <> '' AS has_text, NOT o_orderkey % 3 = 0 OR length(trim(coalesce(b, ''))) < 100 AS wants, (NOT o_orderkey % 3 = 0 OR length(trim(coalesce(b, ''))) < 100) AND o_totalprice >= 100 AS smart, regexp_matches(lower(u), '[.](jpg|png|gif|jpeg|webp)$') AS image, coalesce(t, '') = '' AS lacks_topic, coalesce(t = 'noise', false) AS noise, coalesce(t LIKE 'noise/_%' ESCAPE '/', false) AS noise_cluster FROM (SELECT *, {BODY} AS b, concat('http://h/', o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '.JPG' WHEN 1 THEN '.webp' WHEN 2 THEN '.png?x' ELSE '' END) AS u, CASE o_orderkey % 4 WHEN 0 THEN 'noise' WHEN 1 THEN 'noise_3' WHEN 2 THEN '' END AS t FROM orders)")
def post_predicates(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "orders").select("*", F.expr(BODY).alias("b"), F.expr("concat('http://h/', o_orderkey, case o_orderkey % 4 when 0 then '.JPG' when 1 then '.webp' when 2 then '.png?x' else '' end)").alias("u"), F.expr("case o_orderkey % 4 when 0 then 'noise' when 1 then 'noise_3' when 2 then '' end").alias("topic_id"))
    is_self, body, score = F.col("o_orderkey") % 3 == 0, F.col("b"), F.col("o_totalprice")
    return rows.select(F.col("o_orderkey").alias("post_id"), text.has_text(body, F.lit(None).cast("string")).alias("has_text"), ingest.wants_comments(is_self, body).alias("wants"), ingest.fetch_gate("smart", score, is_self, body).alias("smart"), text.is_image_url(F.col("u")).alias("image"), filters.lacks_topic().alias("lacks_topic"), filters.is_noise(F.col("topic_id")).alias("noise"), filters.is_noise_cluster(F.col("topic_id")).alias("noise_cluster"))


@query("SELECT min(o_orderkey) AS post_id, u AS url FROM (SELECT o_orderkey, concat('http://h/', o_custkey, '.png') AS u, o_custkey FROM orders) WHERE o_custkey % 3 <> 0 GROUP BY u")
def unprocessed_images(spark, sf_dir):
    posts = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post_id"), F.expr("concat('http://h/', o_custkey, '.png')").alias("url"), "o_custkey")
    done = ingest.mark_processed(posts.limit(0), posts.where("o_custkey % 3 = 0"))
    return ingest.unprocessed_images(posts, done).select("post_id", "url")


@query("SELECT DISTINCT CAST(o_custkey AS VARCHAR) AS custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0)")
def existing_ids(spark, sf_dir):
    wanted = tables.read(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").cast("string").alias("custkey"))
    return sets.existing_ids(wanted, tables.read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("custkey")), "custkey")


@query("SELECT CAST(n_nationkey AS VARCHAR) AS id, n_name AS name, n_regionkey AS rating FROM nation WHERE n_nationkey % 3 = 0")
def matched_by_id(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "nation")
    items = rows.select(F.col("n_nationkey").cast("string").alias("post_id"), F.col("n_nationkey").alias("place"), F.col("n_name").alias("name"))
    replies = rows.where("n_nationkey % 3 = 0").select(F.col("n_nationkey").cast("string").alias("post_id"), (-F.col("n_nationkey")).alias("place"), F.col("n_regionkey").alias("rating"))
    return sets.match_by_id_or_place(items, replies, "post_id").select(F.col("post_id").alias("id"), "name", "rating")


@query("SELECT CAST(c.o_custkey AS VARCHAR) AS topic_id, c.chunk AS chunk_id, string_agg(CAST(o_orderkey AS VARCHAR), ',' ORDER BY o_orderkey) AS posts FROM (SELECT DISTINCT o_custkey, CAST(o_orderkey % 3 AS INTEGER) AS chunk FROM orders WHERE o_custkey % 2 = 0) c JOIN orders o ON o.o_custkey = c.o_custkey AND o.o_orderkey % 3 = c.chunk WHERE o.o_orderkey % 3 <> 2 GROUP BY 1, 2")
def chunk_items(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("topic_id"), (F.col("o_orderkey") % 3).cast("int").alias("chunk_id"), "o_orderkey", "o_custkey")
    posts = rows.where("chunk_id <> 2").groupBy("topic_id", "chunk_id").agg(F.sort_array(F.collect_list("o_orderkey")).alias("posts"))
    found = files.chunk_items(rows.where("o_custkey % 2 = 0").select("topic_id", "chunk_id").distinct(), posts)
    return found.select("topic_id", "chunk_id", F.array_join(F.transform("posts", lambda p: p.cast("string")), ",").alias("posts"))


# --- samples

@query(sql("SELECT topic_id, post_id, CAST(rank AS INTEGER) AS rank FROM (SELECT topic_id, post_id, row_number() OVER (PARTITION BY topic_id ORDER BY score DESC, created_utc DESC, post_id) AS rank FROM posts WHERE topic_id IS NOT NULL AND CAST(post_id AS BIGINT) % 4 <> 0) WHERE rank <= 15"))
def top_texts(spark, sf_dir):
    posts = tables.bare_posts(spark, sf_dir).withColumn("topic_text", F.when(F.col("post_id").cast("long") % 4 != 0, F.col("title")).otherwise(F.lit("")))
    return sampling.top_texts(posts, 15).select("topic_id", "post_id", "rank")


@query(sql("SELECT topic_id, count(*) AS count FROM posts WHERE topic_id IS NOT NULL AND CAST(post_id AS BIGINT) % 4 <> 0 GROUP BY topic_id"))
def topic_counts(spark, sf_dir):
    posts = tables.bare_posts(spark, sf_dir).withColumn("topic_text", F.when(F.col("post_id").cast("long") % 4 != 0, F.col("title")))
    return sampling.topic_counts(posts)


@query(sql("""SELECT topic_id, post_id, how FROM (
  SELECT *, CASE WHEN s <= CASE WHEN dom THEN 14 ELSE 20 END THEN 'score' END AS a FROM (SELECT *, topic_id IN ('topic_1', 'topic_2') AS dom, row_number() OVER (PARTITION BY topic_id ORDER BY score DESC, post_id) AS s FROM posts WHERE topic_id IS NOT NULL))
  , LATERAL (SELECT a AS how) WHERE a IS NOT NULL
UNION ALL SELECT topic_id, post_id, CASE WHEN e <= 6 THEN 'early' ELSE 'late' END FROM (
  SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY created_utc DESC, post_id) AS l FROM (
    SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY created_utc, post_id) AS e FROM (SELECT *, row_number() OVER (PARTITION BY topic_id ORDER BY score DESC, post_id) AS s FROM posts WHERE topic_id IN ('topic_1', 'topic_2')) WHERE s > 14) QUALIFY e <= 6 OR row_number() OVER (PARTITION BY topic_id, e <= 6 ORDER BY created_utc DESC, post_id) <= 7)
UNION ALL SELECT topic_id, NULL, 'random ' || CASE WHEN topic_id IN ('topic_1', 'topic_2') THEN least(13, count(*) - 27) ELSE least(20, count(*) - 20) END FROM posts WHERE topic_id IS NOT NULL GROUP BY topic_id"""))
def sampled_rows(spark, sf_dir):
    """Which posts a stratified sample of 40 takes by votes and by time, and how many at random."""
    rows = tables.bare_posts(spark, sf_dir).where("topic_id is not null").select("topic_id", "post_id", "score", "created_utc")
    got = sampling.sample(rows, F.lit(40), F.col("topic_id").isin("topic_1", "topic_2"))
    named = got.where("taken <> 'random'").select("topic_id", "post_id", F.col("taken").alias("how"))
    others = got.groupBy("topic_id").agg(F.count_if(F.col("taken") == "random").alias("n")).select("topic_id", F.lit(None).cast("string").alias("post_id"), F.concat(F.lit("random "), F.col("n").cast("string")).alias("how"))
    return named.unionByName(others)


# --- texts, numbers and times

WORDS = "concat('a_', n_name, '_b-c')"


@query(rf"SELECT n_nationkey AS id, 'A ' || replace(n_name, '_', ' ') || ' B-c' AS titled, CASE WHEN length(n_comment) > 9 THEN substring(n_comment, 1, 9) || '...' ELSE n_comment END AS trimmed, CASE WHEN n_nationkey % 5 = 0 THEN '-' ELSE format('{{:,}}', n_nationkey * 1234567) || CASE n_nationkey % 2 WHEN 1 THEN '.5' ELSE '' END END AS number, CASE WHEN n_nationkey % 5 = 0 THEN '-' ELSE printf('%.1f%%', n_nationkey * 12.5) END AS share, strftime(TIMESTAMP '2024-01-01 11:05:00' + INTERVAL (n_nationkey) HOUR, '%b %d, %I:%M %p') AS at FROM (SELECT *, repeat(n_name, 2) AS n_comment FROM nation)")
def formatted(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "nation")
    key = F.when(F.col("n_nationkey") % 5 != 0, F.col("n_nationkey"))
    at = F.timestamp_seconds(F.lit(1_704_107_100) + F.col("n_nationkey") * 3600)
    return rows.select(F.col("n_nationkey").alias("id"), text.title_case(F.expr(WORDS)).alias("titled"), text.trim_text(F.repeat("n_name", 2), 9).alias("trimmed"), text.format_number(key.cast("long") * 1_234_567 + (key % 2) * 0.5).alias("number"), text.format_percent(key * 0.125).alias("share"), text.format_date_time(at).alias("at"))


@query("SELECT doc_id, CASE WHEN s THEN title || CASE WHEN c = '' THEN '' ELSE chr(10) || c END ELSE title END AS topic_text, CASE WHEN s THEN c ELSE '' END AS cleaned, CASE WHEN doc_id % 2 = 0 THEN 'kept' WHEN c = '' THEN title ELSE title || chr(10) || c END AS post_text, CASE WHEN length(c) > 50 THEN rtrim(substring(c, 1, 50)) || '...' ELSE c END AS short FROM (SELECT doc_id, doc_id % 3 = 0 AS s, 'About ' || source AS title, CASE WHEN doc_id % 5 = 0 THEN '' ELSE trim(regexp_replace(regexp_replace(substring(text, 1, 200), '[^A-Za-z ]', '', 'g'), ' +', ' ', 'g')) END AS c FROM documents)")
def post_texts(spark, sf_dir):
    """Texts of posts made of title and body, with what is kept of them."""
    body = F.expr("case when doc_id % 5 = 0 then ' ' else concat('  ', regexp_replace(substring(text, 1, 200), '[^A-Za-z ]', ''), ' ') end")
    rows = tables.read(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("**About** "), "source").alias("title"), body.alias("selftext"), (F.col("doc_id") % 3 == 0).alias("is_self"))
    rows = ingest.clean_posts(rows)
    kept = F.when(F.col("doc_id") % 2 == 0, F.lit(" kept ")).otherwise(F.lit("  "))
    full = text.post_text(kept, F.col("title"), F.when(F.trim("selftext") == "", F.lit("")).otherwise(F.col("selftext")))
    return rows.select("doc_id", "topic_text", F.col("cleaned_selftext").alias("cleaned"), full.alias("post_text"), text.shorten(F.col("selftext"), 50).alias("short"))


@query("SELECT event_id, CAST(floor(epoch(ts)) AS BIGINT) AS from_time, CASE event_id % 4 WHEN 0 THEN event_id WHEN 1 THEN event_id ELSE 0 END AS from_text, CAST(CASE event_id % 4 WHEN 0 THEN 0.75 WHEN 1 THEN 0 ELSE 1 END AS DOUBLE) AS confidence FROM events")
def parsed_numbers(spark, sf_dir):
    rows = tables.read(spark, sf_dir, "events").select("event_id", "ts")
    raw = F.expr("case event_id % 4 when 0 then concat(' ', event_id) when 1 then concat(event_id, '.7') when 2 then 'x' end")
    conf = F.expr("case event_id % 4 when 0 then ' 0.75 ' when 1 then '-3' when 2 then 'x' else '2e3' end")
    return rows.select("event_id", timeutil.to_epoch_seconds(F.col("ts").cast("timestamp"), True).alias("from_time"), timeutil.to_epoch_seconds(raw).alias("from_text"), labels.confidence(conf).alias("confidence"))


@query("SELECT event_id, CASE WHEN greatest(a, b, c) < 0.55 THEN 'NONE' WHEN a = greatest(a, b, c) THEN 'FAVOR' WHEN b = greatest(a, b, c) THEN 'AGAINST' ELSE 'NONE' END AS stance FROM (SELECT event_id, (event_id % 7) / 7.0::DOUBLE AS a, (event_id % 5) / 5.0::DOUBLE AS b, (event_id % 3) / 3.0::DOUBLE AS c FROM events)")
def scored_stances(spark, sf_dir):
    e = F.col("event_id")
    return tables.read(spark, sf_dir, "events").select("event_id", labels.nli_stance((e % 7) / 7, (e % 5) / 5, (e % 3) / 3).alias("stance"))


@query("SELECT o_orderkey AS id, abs(list_reduce(list_prepend(0::BIGINT, list_transform(string_split(o_orderpriority || o_orderkey, ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda h, x: (h * 31 + x + 139586437120) % 4294967296 - 2147483648)) AS hash FROM orders")
def string_hashes(spark, sf_dir):
    return tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), text.string_hash(F.concat("o_orderpriority", F.col("o_orderkey").cast("string"))).alias("hash"))


@query(f"""WITH s AS (SELECT conv_id, turn, concat('POST: ', role, chr(10), 'COMMENT: ', coalesce(text, '')) AS p FROM conversations),
x AS (SELECT conv_id, turn, h, exp((length(p) - length(replace(p, 'e', ''))) % 7 / 2) AS c, exp(length(p) % 5 / 2) AS n, exp(((length(p) - length(replace(p, 'a', ''))) + h) % 7 / 2) AS e FROM s, (SELECT unnest([32, 31]) AS h)),
y AS (SELECT conv_id, turn, h, c / (c + n + e) AS c, n / (c + n + e) AS n, e / (c + n + e) AS e FROM x),
z AS (SELECT conv_id, turn, max(CASE WHEN h = 32 THEN e ELSE c END) AS f, max(CASE WHEN h = 31 THEN e ELSE c END) AS a, max(n) AS n FROM y GROUP BY ALL),
l AS (SELECT *, CASE WHEN greatest(f, a, n) = f THEN 'FAVOR' WHEN greatest(f, a, n) = a THEN 'AGAINST' ELSE 'NONE' END AS best FROM z)
SELECT conv_id, turn, CASE WHEN best = 'NONE' OR greatest(f, a) < 0.55 THEN 'NONE' ELSE best END AS stance, {r("CASE WHEN best = 'NONE' OR greatest(f, a) < 0.55 THEN n ELSE greatest(f, a) END")} AS stance_score FROM l""")
def inferred_stances(spark, sf_dir):
    """Stances from raw scores of two hypotheses, by the stand-in for a model."""
    rows = tables.read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return inference.stances(rows, inference.rule_scorer, "role", "text").select("conv_id", "turn", "stance", "stance_score")


@query("SELECT label, count(*) AS posts, count(*) FILTER (WHERE vec_id % 3 > 0) AS with_vector FROM embeddings GROUP BY label")
def posts_with_vectors(spark, sf_dir):
    """Posts whose vector is there; a third are made null or empty."""
    lost = F.when(F.col("post_id").cast("long") % 6 == 0, F.array().cast("array<float>"))
    rows = tables.vectors(spark, sf_dir).withColumn("embedding", F.when(F.col("post_id").cast("long") % 3 > 0, F.col("embedding")).otherwise(lost))
    return rows.groupBy("label").agg(F.count("*").alias("posts"), F.count_if(filters.has_embedding()).alias("with_vector"))


SAID = "coalesce(comment_text, '') <> ''"


@query(sql(f"""SELECT p.post_id, title AS cleaned, n AS comments FROM (SELECT * FROM posts WHERE score >= 50 AND num_comments >= 3 AND (CAST(post_id AS BIGINT) % 3 <> 0 OR created_utc >= {tables.AS_OF} - 2000 * 86400)) p
  LEFT JOIN (SELECT post_id, count(*) AS n FROM comments WHERE {SAID} GROUP BY post_id HAVING count(*) >= 2) c ON p.post_id = c.post_id"""))
def ingested(spark, sf_dir):
    """Posts chosen, those that are there already left out unless recent, with the comments that come with them."""
    posts = tables.bare_posts(spark, sf_dir).withColumns({"selftext": F.lit("**body**"), "is_self": F.lit(False)})
    held = posts.where("cast(post_id as bigint) % 3 = 0")
    chosen, own = ingest.ingest(posts, held, tables.comments(spark, sf_dir), ingest.Selection(min_score=50, min_comments=3), tables.AS_OF, 2000, 2)
    counts = own.groupBy("post_id").agg(F.count("comment_text_clean").alias("comments"))
    return chosen.select("post_id", F.col("topic_text").alias("cleaned")).join(counts, "post_id", "left")


# --- replies

@query("SELECT conv_id, turn, concat('c', turn) AS id, turn % 4 AS n FROM conversations")
def salvaged_replies(spark, sf_dir):
    """Records out of replies: a list, one in prose, one in a fence, an object with results, an object behind a broken list."""
    one = "concat('{\"id\": \"c', turn, '\", \"n\": ', turn % 4, '}')"
    reply = F.expr(f"case turn % 5 when 0 then concat('[', {one}, ']') when 1 then concat('Sure, here: [', {one}, '] and done') when 2 then concat('```json\\n[', {one}, ']\\n```') when 3 then concat('{{\"results\": [', {one}, ']}}') else concat('no list [', {one}) end")
    rows = tables.read(spark, sf_dir, "conversations").select("conv_id", "turn", reply.alias("reply"))
    return rows.select("conv_id", "turn", F.explode(jsontext.rows_of(F.col("reply"), "struct<id:string,n:bigint>")).alias("r")).select("conv_id", "turn", "r.*")


@query("SELECT conv_id, turn, concat('x', turn) AS id FROM conversations WHERE turn % 3 <> 2")
def literal_replies(spark, sf_dir):
    """Replies that are Python literals or wrapped in an object by other names."""
    reply = F.expr("case turn % 3 when 0 then concat('[{''id'': ''x', turn, ''', ''ok'': True}]') when 1 then concat('{\"data\": [{\"id\": \"x', turn, '\"}]}') else 'none' end")
    rows = tables.read(spark, sf_dir, "conversations").select("conv_id", "turn", jsontext.loose_json(reply).alias("j"))
    return rows.select("conv_id", "turn", F.explode(F.from_json("j", "array<struct<id:string>>")).alias("r")).select("conv_id", "turn", "r.id")


@query("SELECT n_nationkey AS id, '{\"key\":' || n_nationkey || ',\"name\":\"' || n_name || '\"}' AS said, 'Say {\"key\":' || n_nationkey || ',\"name\":\"' || n_name || '\"} now' AS prompt FROM nation")
def rendered_prompts(spark, sf_dir):
    said = jsontext.compact(F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"))
    return tables.read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), said.alias("said"), text.render("Say {{X}} now", "{{X}}", said).alias("prompt"))


# --- reports and clusters

@query("SELECT 'posts' AS \"table\", f AS field, CASE f WHEN 'post_id' THEN 0 WHEN 'title' THEN (SELECT count(*) FROM orders WHERE o_orderkey % 2 = 0) ELSE (SELECT count(*) FROM orders) END AS nulls, (SELECT count(*) FROM orders) AS total FROM (SELECT unnest(['post_id', 'subreddit', 'title', 'selftext', 'cleaned_selftext', 'topic_text', 'embedding', 'embedding_model', 'embedding_dim', 'topic_id', 'topic_name', 'topic_description', 'stance_dist_weighted', 'sentiment_dist_weighted', 'polarization_score', 'snapshot_week', 'created_utc']) AS f) UNION ALL SELECT 'comments', f, CASE WHEN f = 'comment_id' THEN 0 ELSE (SELECT count(*) FROM nation) END, (SELECT count(*) FROM nation) FROM (SELECT unnest(['comment_id', 'post_id', 'comment_text', 'comment_text_clean', 'sentiment_label', 'stance_label', 'weight', 'llm_confidence', 'llm_comment_exp', 'snapshot_week', 'created_utc']) AS f)")
def table_reports(spark, sf_dir):
    """The report's own fields of both tables."""
    posts = tables.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("post_id"), F.expr("case when o_orderkey % 2 = 1 then 't' end").alias("title"))
    comments = tables.read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("comment_id"))
    return quality.table_reports(posts, comments).select("table", "field", "nulls", "total")


def dbscan_sql(eps: float) -> str:
    return f"""WITH RECURSIVE v AS (SELECT vec_id, embedding AS e FROM embeddings), p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND sqrt(list_sum(list_transform(list_zip(a.e, b.e), lambda x: (CAST(x[1] AS DOUBLE) - x[2]) * (CAST(x[1] AS DOUBLE) - x[2])))) <= {eps}),
  core AS (SELECT a FROM p GROUP BY a HAVING count(*) + 1 >= 5), link AS (SELECT p.a, p.b FROM p JOIN core x ON p.a = x.a JOIN core y ON p.b = y.a),
  reach AS (SELECT a, a AS b FROM core UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
  comp AS (SELECT a, min(CAST(b AS VARCHAR)) AS c FROM reach GROUP BY a), edge AS (SELECT p.b AS a, min(c) AS c FROM p JOIN comp ON p.a = comp.a WHERE p.b NOT IN (SELECT a FROM core) GROUP BY p.b),
  found AS (SELECT * FROM comp UNION ALL SELECT * FROM edge), names AS (SELECT c, row_number() OVER (ORDER BY c) - 1 AS label FROM (SELECT DISTINCT c FROM comp))
SELECT CAST(v.vec_id AS VARCHAR) AS post_id, CAST(coalesce(label, -1) AS INTEGER) AS label FROM v LEFT JOIN found ON v.vec_id = found.a LEFT JOIN names ON found.c = names.c"""


@query(dbscan_sql(0.55))
def dbscan_labels(spark, sf_dir):
    """Density clusters, their borders and noise, row by row."""
    return cluster.dbscan(cluster.usable(tables.vectors(spark, sf_dir)), eps=0.55, min_samples=5)


ORACLES["dbscan_clusters"] = dbscan_sql(0.6)
#: The stand-in model finds none of its words in these comments.
ORACLES["model_stance_labels"] = sql("SELECT c.post_id, comment_id, 'neutral' AS sentiment, 'unclear' AS stance, 0.75::DOUBLE AS confidence, 'by rule' AS rationale FROM comments c JOIN posts p ON c.post_id = p.post_id WHERE coalesce(stance_label, '') = '' AND coalesce(sentiment_label, '') = '' AND comment_text IS NOT NULL AND comment_text <> ' [Deleted] '")


@query(f"SELECT CAST(vec_id AS VARCHAR) AS post_id, {r('list_sum(list_transform(embedding, lambda x: abs(CAST(x AS DOUBLE)))) / sqrt(list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE) * x)))')} AS unit_sum FROM embeddings")
def unit_vectors(spark, sf_dir):
    unit = vectors.l2_normalize(F.col("embedding"))
    return tables.vectors(spark, sf_dir).select("post_id", F.aggregate(F.transform(unit, F.abs), F.lit(0.0), lambda a, x: a + x).alias("unit_sum"))
