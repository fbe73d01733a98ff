"""All queries for one filter triple, as one JSON document."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.operators.filters import Filters
from agorascope.plans import dashboard as d


def results(posts: DataFrame, comments: DataFrame, f: Filters) -> dict[str, DataFrame]:
    """Every query in post mode; labels as stored, unclear apart from unknown."""
    return {
        "overview": d.overview(posts, comments, f),
        "stance_sentiment": d.stance_sentiment(posts, comments, f, merge=False),
        "trends_stance": d.trends(posts, comments, f, "stance", merge=False),
        "trends_sentiment": d.trends(posts, comments, f, "sentiment"),
        "topics": d.topics(posts, f),
        "subreddits": d.subreddits(posts, f),
        "opinion_map": d.opinion_map_posts(posts, f),
        "umap_landscape": d.umap_landscape(posts, f),
        "topic_insights": d.topic_insights(posts, f),
        "sankey": d.sankey(posts, comments, f),
        "polarization_timeline": d.polarization_timeline(posts, comments, f),
        "controversy_leaderboard": d.leaderboard_posts(posts, comments, f),
        "topic_heatmap": d.topic_heatmap(posts, f),
    }


def document(name: str, df: DataFrame) -> DataFrame:
    """One row: name, number of rows, and these as a JSON array."""
    rows = df.select(F.to_json(F.struct(*df.columns)).alias("j"))
    body = F.concat(F.lit("["), F.array_join(F.sort_array(F.collect_list("j")), ","), F.lit("]"))
    return rows.agg(F.count("*").alias("rows"), body.alias("document")).select(F.lit(name).alias("name"), "rows", "document")


def read_back(documents: DataFrame, like: DataFrame) -> DataFrame:
    """The rows that documents hold, in the columns and types of a result."""
    return documents.select(F.explode(F.from_json("document", f"array<{like.schema.simpleString()}>")).alias("r")).select("r.*")


def snapshot(posts: DataFrame, comments: DataFrame, f: Filters) -> DataFrame:
    """name, rows, document: a JSON array per query. All results are bounded by the queries' limits, labels or weeks."""
    out = None
    for name, df in results(posts, comments, f).items():
        row = document(name, df)
        out = row if out is None else out.unionByName(row)
    return out


def write(posts: DataFrame, comments: DataFrame, f: Filters, path: str) -> None:
    """One JSON document: the filters, and a field per query."""
    rows = snapshot(posts, comments, f).agg(F.array_join(F.sort_array(F.collect_list(F.concat(F.lit('"'), "name", F.lit('": '), "document"))), ",\n").alias("fields"))
    meta = f'"filters": {{"range": "{f.range}"}}'
    rows.select(F.concat(F.lit("{" + meta + ",\n"), "fields", F.lit("}")).alias("value")).coalesce(1).write.mode("overwrite").text(path)
