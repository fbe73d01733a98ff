"""Set operations, anti joins and audits of keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.operators.ingest import first_of


def missing_ids(wanted: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    """Sorted distinct keys that the table lacks."""
    return wanted.select(key).where(F.coalesce(F.col(key), F.lit("")) != "").distinct().join(existing.select(key), key, "left_anti").orderBy(key)


def existing_ids(wanted: DataFrame, existing: DataFrame, key: str) -> DataFrame:
    return existing.select(key).distinct().join(wanted.select(key), key, "left_semi")


def unresolved(results: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with a missing_result error that never succeeded, sorted."""
    lost = results.where("status = 'error' and error = 'missing_result'").select(keys).distinct()
    return lost.join(results.where("status = 'ok'").select(keys), keys, "left_anti").orderBy(*keys)


def pruned(results: DataFrame, keys: list[str]) -> DataFrame:
    """Results without the missing_result errors whose key succeeded elsewhere."""
    ok = results.where("status = 'ok'").select(keys).distinct().withColumn("ok_", F.lit(True))
    rows = results.join(ok, keys, "left")
    return rows.where("not (status = 'error' and coalesce(error, '') = 'missing_result' and coalesce(ok_, false))").drop("ok_")


def with_results(expected: DataFrame, parsed: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Expected keys with the last parsed row of each, or an error of missing_result."""
    last = first_of(parsed.withColumn("k_", F.struct(*keys)), "k_", F.desc(order)).drop("k_", order).withColumn("found_", F.lit(True))
    rows = expected.join(last, keys, "left")
    return rows.withColumns({"status": F.when(F.col("found_"), "ok").otherwise("error"), "error": F.when(F.col("found_"), "").otherwise("missing_result")}).drop("found_")


def best_per_topic(results: DataFrame, order: str, allow_empty: bool = False) -> DataFrame:
    """The row with most confidence per topic, the first of equals; rows of another status or without texts are left out."""
    rows = results.where("coalesce(status, '') in ('', 'ok')")
    if not allow_empty:
        rows = rows.where("coalesce(topic_name, '') <> '' and coalesce(topic_description, '') <> ''")
    return first_of(rows, "topic_id", F.desc(F.coalesce(F.col("confidence").try_cast("double"), F.lit(-1.0))), order)


def audit(expected: DataFrame, received: DataFrame, request: str) -> DataFrame:
    """Requests whose reply holds another number of records than expected, with the reason."""
    counts = expected.groupBy(request).agg(F.count("*").alias("expected")).join(received.groupBy(request).agg(F.count("*").alias("received")), request, "left")
    counts = counts.withColumn("received", F.coalesce("received", F.lit(0)))
    reason: Column = F.when(F.col("received") == 0, "empty_or_invalid_json").otherwise("count_mismatch")
    return counts.where("expected <> received").withColumn("reason", reason)


def match_by_id_or_place(items: DataFrame, replies: DataFrame, key: str) -> DataFrame:
    """Replies joined to items by id; where no reply has an id and there are as many, by place (row index from 0).

    Both need a column `place`; one plan serves both cases."""
    counts = replies.agg(F.count(key).alias("ids_"), F.count("*").alias("replies_")).withColumn("one_", F.lit(1)).join(items.agg(F.count("*").alias("items_")).withColumn("one_", F.lit(1)), "one_")
    mode = counts.select("one_", ((F.col("ids_") == 0) & (F.col("replies_") == F.col("items_"))).alias("by_place_"))
    named = replies.withColumn("one_", F.lit(1)).join(F.broadcast(mode), "one_")
    link = F.when(F.col("by_place_"), F.concat(F.lit("#"), F.col("place").cast("string"))).otherwise(F.concat(F.lit("="), F.col(key)))
    right = named.select(link.alias("link_"), *[F.col(c) for c in replies.columns if c not in (key, "place")])
    left = items.select(F.explode(F.array(F.concat(F.lit("#"), F.col("place").cast("string")), F.concat(F.lit("="), F.col(key)))).alias("link_"), *items.columns)
    return left.join(right, "link_").drop("link_")
