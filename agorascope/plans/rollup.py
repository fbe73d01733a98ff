"""Mergeable roll-ups of the query API: partial states per day, subreddit and topic, in parts by ISO week.

Three tables hold sums that any filter triple merges: cells of comments (also by labels), cells of posts (also by whether they
have distributions), and the sums of comments per post and day. A range reads the parts of its weeks only; where it begins
within a day, the rest of that day comes from the rows themselves, so results are those of the rows at any moment. A batch
of new or changed rows refreshes its weeks: their parts are worked out anew from the rows, all others stay as they lie
(sources.versioned). Sums per post keep nothing of the posts, whose polarization changes with every comment: posts join them when
they are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from agorascope.functions import labels, timeutil
from agorascope.functions.text import is_deleted
from agorascope.operators.filters import Filters, of_posts
from agorascope.plans import dashboard as d
from agorascope.sources.versioned import NO_PART, PART, Versioned

DAY = 86_400


def week() -> Column:
    """The part of a row."""
    return F.coalesce(timeutil.snapshot_week(F.col("created_utc")), F.lit(NO_PART))


def _day() -> Column:
    return F.floor(F.col("created_utc") / DAY).cast("int").alias("day")


def _size() -> Column:
    return F.coalesce("num_comments", F.lit(0))


def comment_cells(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Sums of comments by week, day, labels, and subreddit and topic of their posts (null without a post)."""
    labelled = (F.coalesce("stance_label", F.lit("")) != "") & (F.coalesce("sentiment_label", F.lit("")) != "")
    rows = comments.join(posts.select("post_id", "subreddit", "topic_id"), "post_id", "left").withColumn("labelled", labelled)
    sure = F.when(F.col("labelled"), F.col("llm_confidence"))
    return rows.groupBy(week().alias(PART), _day(), (F.col("created_utc") > 0).alias("dated"), "subreddit", "topic_id", "stance_label", "sentiment_label", "labelled").agg(
        F.count("*").alias("n"), F.count_if(is_deleted(F.col("comment_text"), blank=True)).alias("deleted"),
        F.count_if(F.col("labelled") & F.coalesce(F.col("llm_confidence") < 0.5, F.lit(True))).alias("low"),
        F.sum(sure).alias("conf_sum"), F.count(sure).alias("conf_n"), F.sum(F.coalesce("weight", F.lit(1.0))).alias("w"),
    )


def post_days(comments: DataFrame) -> DataFrame:
    """Sums of comments by week, day and post."""
    return comments.groupBy(week().alias(PART), _day(), "post_id").agg(F.sum(F.coalesce("upvote_score", F.lit(0))).alias("votes"), F.sum(F.coalesce("weight", F.lit(1.0))).alias("w"))


def post_cells(posts: DataFrame) -> DataFrame:
    """Sums of posts by week, day, subreddit, topic and whether they have distributions; `first` is the post with the smallest id."""
    have = F.col("stance_dist_weighted").isNotNull() & F.col("sentiment_dist_weighted").isNotNull()
    part = lambda kind, k: F.coalesce(F.col(f"{kind}_dist_weighted")[k], F.lit(0.0))
    by_size = lambda value, name: F.sum(value * _size()).alias(name)
    return posts.groupBy(week().alias(PART), _day(), "subreddit", "topic_id", "snapshot_week", have.alias("judged")).agg(
        F.count("*").alias("n"), F.min(F.struct("post_id", "topic_name", "topic_description")).alias("first"),
        F.sum("num_comments").alias("comments"), F.count("num_comments").alias("comments_n"), F.sum("score").alias("score"), F.count("score").alias("score_n"),
        F.sum("center_distance").alias("far"), F.count("center_distance").alias("far_n"), by_size(F.coalesce("center_distance", F.lit(0.0)), "far_by_size"),
        F.sum(F.when(F.col("center_distance").isNotNull(), _size()).otherwise(F.lit(0))).alias("far_size"), F.sum(_size()).alias("size"),
        by_size(F.coalesce("polarization_score", F.lit(0.0)), "polarization"),
        *[by_size(part("stance", k), f"stance_{k}") for k in labels.STANCES], *[by_size(part("sentiment", k), f"sentiment_{k}") for k in labels.SENTIMENTS],
    )


@dataclass
class Rollups:
    """The three tables below a folder, beside the rows that they are made of."""

    spark: SparkSession
    path: str
    posts: DataFrame
    comments: DataFrame

    def _made(self) -> dict[str, tuple[DataFrame, DataFrame]]:
        """By name: the rows that decide a table's weeks, and how the table is made of some of them."""
        return {"comment_cells": (self.comments, lambda c: comment_cells(c, self.posts)), "post_days": (self.comments, post_days), "post_cells": (self.posts, post_cells)}

    def table(self, name: str) -> Versioned:
        rows, make = self._made()[name]
        return Versioned(self.spark, f"{self.path}/{name}", lambda: make(rows).drop(PART).schema)

    def refresh(self, weeks: list[str] | None = None, names: tuple[str, ...] = ("comment_cells", "post_days", "post_cells"), batch: tuple[str, int] | None = None) -> dict[str, list[str]]:
        """Works the parts of these weeks (None: of all) out anew from the rows. The weeks written, by table."""
        done = {}
        for name in names:
            rows, make = self._made()[name]
            table = self.table(name)
            base = table.version()
            some = rows if weeks is None else rows.where(week().isin(weeks))
            made = make(some)
            touched = sorted({*table.parts(base), *(r[PART] for r in rows.select(week().alias(PART)).distinct().collect())}) if weeks is None else sorted(weeks)
            if not (batch and table.applied(batch)):
                table.replace(made, touched, base, batch)
                done[name] = touched
        return done

    def weeks_of(self, changed: DataFrame) -> list[str]:
        """The weeks that rows with created_utc fall in: few, as a batch is of few days."""
        return sorted(r[0] for r in changed.select(week()).distinct().collect())

    def rows(self, name: str, f: Filters, of: bool = True) -> DataFrame:
        """The cells of a range and, if asked for, of the filter's subreddit and topic."""
        rows, make = self._made()[name]
        table = self.table(name)
        if f.since is None:
            cells = table.read()
        else:
            first = "{}-W{:02}".format(*datetime.fromtimestamp(f.since, UTC).isocalendar()[:2])
            cells = table.read([p for p in table.parts() if p != NO_PART and p >= first]).where(F.col("day") >= -(-f.since // DAY))
            if f.since % DAY:
                rest = make(rows.where(F.col("created_utc").between(f.since, (f.since // DAY + 1) * DAY - 1))).drop(PART)
                cells = cells.unionByName(rest)
        return cells.where(of_posts(f, time=False)) if of else cells

    def _per_post(self, f: Filters, *columns: str) -> DataFrame:
        """Sums of comments per post in the range, with columns of the posts that the filters keep."""
        sums = self.rows("post_days", f, of=False).groupBy("post_id").agg(F.sum("w").alias("w"))
        return sums.join(self.posts.where(of_posts(f, time=False)).select("post_id", *columns), "post_id")

    # The query API, as plans.dashboard has it

    def overview(self, f: Filters) -> DataFrame:
        p = self.rows("post_cells", f).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("posts"), (F.sum("comments") / F.sum("comments_n")).alias("avg_comments_per_post"), (F.sum("score") / F.sum("score_n")).alias("avg_post_upvotes"))
        total = lambda c: F.coalesce(F.sum(c), F.lit(0))
        c = self.rows("comment_cells", f).agg(total("n").alias("comments"), total(F.when(F.col("labelled"), F.col("n"))).alias("labeled_comments"), total("deleted").alias("deleted_comments"), total("low").alias("low_confidence_comments"), F.sum("conf_sum").alias("s"), F.sum("conf_n").alias("k"))
        days = self.rows("post_days", f, of=False)
        if f.subreddit or f.topic:
            days = days.join(self.posts.where(of_posts(f, time=False)).select("post_id"), "post_id")
        v = days.groupBy("post_id").agg(F.sum("votes").alias("votes")).agg(F.avg("votes").alias("avg_comment_upvotes_per_post"))
        one = lambda df: df.withColumn("one", F.lit(1))
        both = one(p).join(one(c), "one").join(one(v), "one")
        return both.select("posts", "comments", "labeled_comments", d._ratio(F.col("labeled_comments"), F.col("comments")).alias("label_coverage"), d._ratio(F.col("s"), F.col("k"), None).alias("avg_confidence"), "avg_comments_per_post", "avg_post_upvotes", "avg_comment_upvotes_per_post", "deleted_comments", "low_confidence_comments")

    def stance_sentiment(self, f: Filters, merge: bool = True) -> DataFrame:
        return self.rows("comment_cells", f).groupBy(labels.known(F.col("stance_label"), merge).alias("stance"), labels.known(F.col("sentiment_label"), False).alias("sentiment")).agg(F.sum("n").alias("count"))

    def trends(self, f: Filters, field: str = "stance", merge: bool = True) -> DataFrame:
        label = labels.known(F.col(f"{field}_label"), merge and field == "stance")
        at = timeutil.bucket(F.col("day").cast("long") * DAY, timeutil.bucket_unit(f.days))
        return self.rows("comment_cells", f).where("dated").groupBy(at.alias("bucket"), label.alias("label")).agg(F.sum("n").alias("count"))

    def topics(self, f: Filters, limit: int = 80) -> DataFrame:
        found = self.rows("post_cells", f).where("topic_id is not null").groupBy("topic_id").agg(F.min("first").alias("first"), F.sum("n").alias("count"), (F.sum("comments") / F.sum("comments_n")).alias("avg_comments"), (F.sum("score") / F.sum("score_n")).alias("avg_score"), (F.sum("far") / F.sum("far_n")).alias("avg_center_distance"))
        name = lambda c: F.coalesce(F.col("first")[c], F.lit("")).alias(c)
        return found.select("topic_id", name("topic_name"), name("topic_description"), "count", "avg_comments", "avg_score", "avg_center_distance").orderBy(F.desc("count"), "topic_id").limit(limit)

    def subreddits(self, f: Filters, limit: int = 60) -> DataFrame:
        found = self.rows("post_cells", f).groupBy("subreddit").agg(F.sum("n").alias("count")).orderBy(F.desc("count"), "subreddit").limit(limit)
        return found.where("coalesce(subreddit, '') <> ''")

    def _judged(self, f: Filters) -> DataFrame:
        rows = self.rows("post_cells", f).where("judged and topic_id is not null")
        sums = ["size", "polarization", "far_by_size", "far_size", *[f"stance_{k}" for k in labels.STANCES], *[f"sentiment_{k}" for k in labels.SENTIMENTS]]
        return rows.groupBy("topic_id").agg(F.min("first")["topic_name"].alias("name"), *[F.sum(c).alias(c) for c in sums])

    def opinion_map_topics(self, f: Filters, limit: int = 80) -> DataFrame:
        mean = lambda x: d._ratio(x, F.col("size"))
        x, y = F.col("stance_agree") - F.col("stance_disagree"), F.col("sentiment_positive") - F.col("sentiment_negative")
        return self._judged(f).select(F.col("topic_id").alias("id"), F.coalesce("name", "topic_id").alias("label"), "topic_id", F.coalesce("name", F.lit("")).alias("topic_name"), mean(x).alias("x"), mean(y).alias("y"), mean(F.col("polarization")).alias("polarization_score"), "size").orderBy(F.desc("size"), "id").limit(limit)

    def topic_insights(self, f: Filters, limit: int = 40) -> DataFrame:
        own = self._judged(f)
        share = lambda kind, keys: sum((F.col(f"{kind}_{k}") for k in keys if f"{kind}_{k}" in own.columns), F.lit(0.0))
        shares = [d._ratio(share(kind, keys), F.col("size")).alias(f"{kind}_{name}") for kind, names in d.SHARES.items() for name, keys in names.items()]
        found = own.select("topic_id", F.coalesce("name", F.lit("")).alias("topic_name"), F.col("size").alias("total_comments"), d._ratio(F.col("polarization"), F.col("size")).alias("polarization_score"), d._ratio(F.col("far_by_size"), F.col("far_size"), None).alias("avg_center_distance"), *shares)
        return found.orderBy(F.desc("polarization_score"), "topic_id").limit(limit)

    def sankey(self, f: Filters) -> DataFrame:
        return self.rows("comment_cells", f).groupBy(labels.known(F.col("sentiment_label"), False).alias("source"), labels.known(F.col("stance_label")).alias("target")).agg(F.sum("w").alias("value"))

    def polarization_timeline(self, f: Filters) -> DataFrame:
        rows = self._per_post(f, F.col("snapshot_week").alias("week"), F.coalesce("polarization_score", F.lit(0.0)).alias("p"), d.SENTIMENT_BALANCE().alias("b")).where("week is not null")
        weeks = rows.groupBy("week").agg(F.sum("w").alias("weight"), F.sum(F.col("p") * F.col("w")).alias("ps"), F.sum(F.col("b") * F.col("w")).alias("bs"))
        return weeks.select("week", "weight", d._ratio(F.col("ps"), F.col("weight")).alias("polarization_score"), d._ratio(F.col("bs"), F.col("weight")).alias("sentiment_balance")).orderBy("week")

    def leaderboard_posts(self, f: Filters, limit: int = 30) -> DataFrame:
        found = self._per_post(f, "title", "subreddit", "topic_id", "topic_name", "polarization_score")
        return found.select(F.col("post_id").alias("id"), F.coalesce("title", "post_id").alias("label"), "subreddit", "topic_id", F.coalesce("topic_name", F.lit("")).alias("topic_name"), F.coalesce("polarization_score", F.lit(0.0)).alias("polarization_score"), F.col("w").alias("comment_weight_sum")).orderBy(F.desc(F.round("w", 6)), "id").limit(limit)

    def leaderboard_topics(self, f: Filters, limit: int = 30) -> DataFrame:
        rows = self._per_post(f, "topic_id", "topic_name", F.coalesce("polarization_score", F.lit(0.0)).alias("p")).where("topic_id is not null")
        sums = rows.groupBy("topic_id").agg(d.first("topic_name").alias("n"), F.sum("w").alias("w"), F.sum(F.col("p") * F.col("w")).alias("pw"))
        return sums.select(F.col("topic_id").alias("id"), F.coalesce("n", "topic_id").alias("label"), "topic_id", F.coalesce("n", F.lit("")).alias("topic_name"), F.col("w").alias("comment_weight_sum"), d._ratio(F.col("pw"), F.col("w")).alias("polarization_score")).orderBy(F.desc(F.round("comment_weight_sum", 6)), "id").limit(limit)

    def topic_heatmap(self, f: Filters, limit: int = 12) -> DataFrame:
        rows = self.rows("post_cells", f).where("topic_id is not null")
        top = rows.groupBy("topic_id").agg(F.sum("size").alias("size")).orderBy(F.desc("size"), "topic_id").limit(limit).where("topic_id <> ''").select("topic_id")
        cells = rows.where("snapshot_week is not null").join(top, "topic_id", "left_semi").groupBy("topic_id", F.col("snapshot_week").alias("week")).agg(F.sum("size").alias("n"), F.sum("polarization").alias("p"), *[F.sum(f"stance_{k}").alias(k) for k in labels.STANCES])
        return cells.select("topic_id", "week", d._ratio(F.col("p"), F.col("n")).alias("polarization_score"), labels.dominant(F.round("agree", 6), F.round("disagree", 6), F.round("neutral", 6)).alias("dominant_label"))
