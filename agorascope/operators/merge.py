"""Writes as new states of a table: upserts and keyed updates, for formats without MERGE."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.functions import timeutil
from agorascope.functions.labels import missing_labels
from agorascope.operators.ingest import first_of


def upsert(existing: DataFrame, incoming: DataFrame, key: str, now: Column, keep: list[str] | None = None, preserve: bool = False) -> DataFrame:
    """All rows of either side. Of incoming rows without a key none, of equal keys the last by order_ (if there) count.

    Incoming columns win, null or not, unless preserve; columns in keep, and those that incoming lacks, stay as they are.
    created_at is set on insert only, updated_at always."""
    keep = keep or []
    new = incoming.where(F.col(key).isNotNull())
    new = first_of(new, key, F.desc("order_")).drop("order_") if "order_" in new.columns else first_of(new, key, *sorted(c for c in new.columns if c != key))
    n, e = new.alias("n"), existing.alias("e")
    out = []
    for c in existing.columns:
        old, given = F.col(f"e.{c}"), F.col(f"n.{c}") if c in new.columns else None
        if c == key:
            col = F.coalesce(given, old)
        elif c == "created_at":
            col = F.coalesce(old, now)
        elif c == "updated_at":
            col = F.when(F.col(f"n.{key}").isNotNull(), now).otherwise(old)
        elif given is None or c in keep:
            col = old
        else:
            col = F.coalesce(given, old) if preserve else F.when(F.col(f"n.{key}").isNotNull(), given).otherwise(old)
        out.append(col.alias(c))
    return e.join(n, F.col(f"e.{key}") == F.col(f"n.{key}"), "full_outer").select(*out)


def flattened(posts: DataFrame, nested: str = "comments") -> tuple[DataFrame, DataFrame]:
    """Posts without their nested comments, and those with the post's id."""
    rows = posts.select("post_id", F.explode(nested).alias("c")).select("c.*", F.col("post_id").alias("parent_"))
    return posts.drop(nested), rows.drop("post_id").withColumnRenamed("parent_", "post_id")


def _given(rows: DataFrame, *names: str, kind: str = "string") -> Column:
    """The first of the columns by these names that is neither null nor empty."""
    have = [F.nullif(F.col(n).cast("string"), F.lit("")) if kind == "string" else F.col(n) for n in names if n in rows.columns]
    return F.coalesce(*have).cast(kind) if have else F.lit(None).cast(kind)


def _week(rows: DataFrame, created: Column) -> Column:
    return F.coalesce(_given(rows, "snapshot_week"), timeutil.snapshot_week(created))


def post_rows(raw: DataFrame) -> DataFrame:
    """Posts as they are stored: older names, defaults for texts and counts, nulls for what later steps add."""
    created = timeutil.to_epoch_seconds(_given(raw, "created_utc"))
    text = {c: F.coalesce(_given(raw, c), F.lit("")) for c in ("subreddit", "title", "selftext", "cleaned_selftext", "topic_text")}
    count = {c: F.coalesce(_given(raw, c).try_cast("double").cast("long"), F.lit(0)) for c in ("score", "num_comments")}
    later = {c: F.col(c) if c in raw.columns else F.lit(None).cast(t) for c, t in (("embedding", "array<float>"), ("topic_id", "string"), ("topic_name", "string"), ("topic_description", "string"), ("stance_dist_weighted", "struct<agree:double,disagree:double,neutral:double>"), ("sentiment_dist_weighted", "struct<positive:double,negative:double,neutral:double>"), ("polarization_score", "double"))}
    every = {"post_id": _given(raw, "post_id", "id")} | text | {"created_utc": created} | count | later | {"snapshot_week": _week(raw, created)}
    return raw.select(*[v.alias(k) for k, v in every.items()], *[c for c in ("order_",) if c in raw.columns])


def comment_rows(raw: DataFrame) -> DataFrame:
    """Comments as they are stored; those without both ids are left out. Labels and weights are reset to what is given."""
    created = timeutil.to_epoch_seconds(_given(raw, "created_utc"))
    every = {
        "comment_id": _given(raw, "comment_id", "id"), "post_id": _given(raw, "post_id"), "comment_text": F.coalesce(_given(raw, "comment_text", "body"), F.lit("")), "comment_text_clean": F.coalesce(_given(raw, "comment_text_clean", "body_clean"), F.lit("")),
        "upvote_score": F.coalesce(_given(raw, "upvote_score").try_cast("double").cast("long"), _given(raw, "score").try_cast("double").cast("long"), F.lit(0)), "created_utc": created,
        "sentiment_label": _given(raw, "sentiment_label"), "stance_label": _given(raw, "stance_label"), "weight": _given(raw, "weight", kind="double"), "snapshot_week": _week(raw, created),
    }
    rows = raw.select(*[v.alias(k) for k, v in every.items()], *[c for c in ("order_",) if c in raw.columns])
    return rows.where("comment_id is not null and post_id is not null")


def upsert_posts_and_comments(posts: DataFrame, comments: DataFrame, raw: DataFrame, now: Column, nested: str = "comments") -> tuple[DataFrame, DataFrame, DataFrame]:
    """New states of both tables from raw posts with nested comments, and one row of how many of each were taken.

    A comment without a post's id gets its parent's; confidences of comments stay as they are."""
    key = _given(raw, "post_id", "id")
    inner = raw.select(key.alias("parent_"), F.explode(nested).alias("c")).select("parent_", "c.*")
    own = F.coalesce(F.nullif("post_id", F.lit("")), "parent_") if "post_id" in inner.columns else F.col("parent_")
    new_posts, new_comments = post_rows(raw.drop(nested)).where("post_id is not null"), comment_rows(inner.withColumn("post_id", own).drop("parent_"))
    counts = new_posts.agg(F.count("*").alias("posts")).withColumn("one_", F.lit(1)).join(new_comments.agg(F.count("*").alias("comments")).withColumn("one_", F.lit(1)), "one_").drop("one_")
    return upsert(posts, new_posts, "post_id", now), upsert(comments, new_comments, "comment_id", now, keep=["llm_confidence"]), counts


def save_embeddings(posts: DataFrame, embedded: DataFrame, model: str) -> DataFrame:
    """embedding, embedding_model and embedding_dim of posts that embedded(post_id, embedding) holds; others stay."""
    new = embedded.select("post_id", "embedding", F.lit(model).alias("embedding_model"), F.size("embedding").alias("embedding_dim"))
    return update(posts, new, "post_id")


def save_projection(posts: DataFrame, flat: DataFrame, wide: DataFrame) -> DataFrame:
    """umap_x, umap_y and umap_50d of posts from projections(post_id, projected) to two and to many dimensions."""
    both = flat.select("post_id", F.get("projected", F.lit(0)).alias("umap_x"), F.get("projected", F.lit(1)).alias("umap_y")).join(wide.select("post_id", F.col("projected").alias("umap_50d")), "post_id")
    return update(posts, both, "post_id")


def update(existing: DataFrame, changes: DataFrame, key: str, only_finite: bool = False) -> DataFrame:
    """Values of changes where they are given (and finite), by key."""
    fields = [c for c in changes.columns if c != key]
    new = changes.select(key, *[F.col(c).alias(f"new_{c}") for c in fields])
    rows = existing.join(new, key, "left")
    for c in fields:
        value = F.col(f"new_{c}")
        if only_finite:
            value = F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
        rows = rows.withColumn(c, F.coalesce(value, F.col(c)) if c in existing.columns else value)
    return rows.select(*existing.columns, *[c for c in fields if c not in existing.columns])


def set_topics(posts: DataFrame, clusters: DataFrame, names: DataFrame, noise: str | None = "noise") -> DataFrame:
    """topic_id by cluster label; label -1 gets `noise`, or keeps its topic where noise is None."""
    labeled = clusters.join(names, "label", "left")
    topic = F.when(F.col("label") == -1, F.lit(noise)).otherwise(F.col("topic_id"))
    return update(posts, labeled.select("post_id", topic.alias("topic_id")), "post_id")


def set_topic_labels(posts: DataFrame, topic_labels: DataFrame) -> DataFrame:
    """Name, description and confidence of a topic on all its posts."""
    return update(posts, topic_labels, "topic_id")


def unset_noise(posts: DataFrame, fields: list[str]) -> DataFrame:
    return posts.withColumns({c: F.when(F.coalesce(F.col("topic_id") == "noise", F.lit(False)), F.lit(None)).otherwise(F.col(c)) for c in fields})


def save_labels(comments: DataFrame, incoming: DataFrame, only_missing: bool = True) -> DataFrame:
    """Labels of incoming rows (comment_id, sentiment, stance, confidence, rationale, order_) on comments.

    only_missing: comments with both labels empty, of repeated rows the first; else all, of repeated rows the last.
    Empty parts change nothing."""
    some = lambda c: F.nullif(F.col(c), F.lit(""))
    new = incoming.where("coalesce(comment_id, '') <> ''")
    new = first_of(new, "comment_id", F.col("order_") if only_missing else F.desc("order_"))
    new = new.select("comment_id", some("sentiment").alias("s_"), some("stance").alias("t_"), F.col("confidence").alias("c_"), some("rationale").alias("r_"))
    rows = comments.join(new, "comment_id", "left")
    may = missing_labels(F.col("stance_label"), F.col("sentiment_label")) if only_missing else F.lit(True)
    to = {"sentiment_label": "s_", "stance_label": "t_", "llm_confidence": "c_", "llm_comment_exp": "r_"}
    return rows.withColumns({c: F.when(may, F.coalesce(F.col(n), F.col(c))).otherwise(F.col(c)) for c, n in to.items() if c in comments.columns}).select(comments.columns)
