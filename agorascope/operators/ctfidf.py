"""Class-based TF-IDF: the terms that set topics apart."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import partial
from itertools import pairwise

import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agorascope.sources import store

#: Letters, digits and underscores, two at least.
TOKEN = re.compile(r"\w{2,}")
#: Terms that a task counts before it passes them on; bytes of texts for each core below which they are dealt out.
HELD, SPREAD = 500_000, 16 << 20
TERMS = "topic_id string, term string, n long, post_id string, head string, tail string"
SEAMS = "topic_id string, before string, head string, edge int, part int"


def stop_words(spark, more: DataFrame | None = None) -> list[str]:
    """Spark's English list, and all the words of a table."""
    words = set(StopWordsRemover.loadDefaultStopWords("english"))
    return sorted(words | ({r["word"] for r in more.select("word").distinct().collect()} if more is not None else set()))


def _seams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over (topic_id, head, tail) in order: the tail of each row with the head of the next of its topic (edge 0), and the
    first head (edge 1) and last tail (edge 2) of the partition, which meet those of its neighbours."""
    part, last = TaskContext.get().partitionId(), None
    for batch in batches:
        rows = []
        for topic, head, tail in zip(*(batch.column(c).to_pylist() for c in ("topic_id", "head", "tail")), strict=True):
            if last is None:
                rows.append((topic, None, head, 1, part))
            elif last[0] == topic:
                rows.append((topic, last[1], head, 0, part))
            last = (topic, tail)
        yield _seam_rows(rows)
    if last is not None:
        yield _seam_rows([(last[0], last[1], None, 2, part)])


def _seam_rows(rows: list) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32())
    cols = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], [c.split()[0] for c in SEAMS.split(", ")])


def _seam_terms(ends: DataFrame) -> DataFrame:
    """topic_id, term, n of the bigrams that span neighbouring posts. Ranges of posts are independent tasks, so no topic is
    one task; what meets at the borders of ranges is two rows per range."""
    found = ends.repartitionByRange("topic_id", "post_id").sortWithinPartitions("topic_id", "post_id").select(F.col("topic_id").cast("string"), "head", "tail").mapInArrow(_seams, SEAMS)
    borders = found.where("edge > 0").withColumn("tail_", F.lag("before").over(Window.partitionBy("topic_id").orderBy("part", "edge")))
    meets = borders.where("edge = 1 and tail_ is not null").select("topic_id", F.col("tail_").alias("before"), "head")
    return found.where("edge = 0").select("topic_id", "before", "head").unionByName(meets).select("topic_id", F.concat_ws(" ", "before", "head").alias("term"), F.lit(1).cast("long").alias("n"))


def _spread(rows: DataFrame) -> DataFrame:
    """Rows of small files dealt over all cores; larger inputs stay as their files cut them."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(2 * cores) if store.size_of(rows) < cores * SPREAD else rows


def _counted(batches: Iterator[pa.RecordBatch], stop: frozenset, bigrams: bool, ends: bool) -> Iterator[pa.RecordBatch]:
    """Terms of each topic with their counts, summed in the task; and with `ends` a row per post with its first and last word."""
    kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
    names = [c.split()[0] for c in TERMS.split(", ")]
    held: dict[str, Counter] = defaultdict(Counter)
    size = 0

    def rows(columns: list[list]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    def summed() -> Iterator[pa.RecordBatch]:
        for topic, terms in held.items():
            n = len(terms)
            yield rows([[topic] * n, list(terms), list(terms.values()), [None] * n, [None] * n, [None] * n])
        held.clear()

    for batch in batches:
        edges: list[tuple] = []
        for topic, post, text in zip(*(batch.column(c).to_pylist() for c in ("topic_id", "post_id", "text")), strict=True):
            words = [w for w in TOKEN.findall(text) if w not in stop]
            if not words:
                continue
            own = held[topic]
            before = len(own)
            own.update(words)
            if bigrams:
                own.update(map(" ".join, pairwise(words)))
            size += len(own) - before
            if ends:
                edges.append((topic, None, None, post, words[0], words[-1]))
            if size > HELD:
                yield from summed()
                size = 0
        if edges:
            yield rows([list(c) for c in zip(*edges, strict=True)])
    yield from summed()


def term_scores(rows: DataFrame, stop: list[str], min_df: int = 2, max_df: float = 0.95, min_posts: int = 1, bigrams: bool = True, across_posts: bool = True) -> DataFrame:
    """rows(topic_id, post_id, text) -> topic_id, term, n, tf, df, score.

    Stop words go before bigrams are made. Bigrams also span neighbouring posts (in order of post_id) unless
    across_posts=False; then no topic's text is ever gathered in one row. df counts topics; max_df is their share.

    Texts are cut into words once: tasks sum the terms of their posts by topic, at most HELD at a time, and write these and
    the ends of posts to a table. Terms move once, by term: counts by topic and df are sums over one and the same exchange, and a
    term that too few or too many topics hold goes right there."""
    spark = rows.sparkSession
    kind = dict(rows.dtypes)["topic_id"]
    rows = rows.where("topic_id is not null")
    if min_posts > 1:
        many = rows.groupBy("topic_id").agg(F.count("*").alias("m_")).where(F.col("m_") >= min_posts).select("topic_id")
        rows = rows.join(many, "topic_id", "left_semi")
    texts = _spread(rows.select(F.col("topic_id").cast("string"), F.col("post_id").cast("string"), F.lower(F.coalesce("text", F.lit(""))).alias("text")))
    found = store.kept(texts.mapInArrow(partial(_counted, stop=frozenset(stop), bigrams=bigrams, ends=bigrams and across_posts), TERMS), "terms")
    counts = found.where("term is not null").select("topic_id", "term", "n")
    if bigrams and across_posts:
        counts = counts.unionByName(_seam_terms(found.where("term is null").select("topic_id", "post_id", "head", "tail")))
    counts = counts.repartition("term").groupBy("term", "topic_id").agg(F.sum("n").alias("n"))
    topics = rows.agg(F.countDistinct("topic_id")).first()[0]
    terms = counts.groupBy("term").agg(F.count("*").alias("df"), F.collect_list(F.struct("topic_id", "n")).alias("in_"))
    kept = store.kept(terms.where((F.col("df") >= min_df) & (F.col("df") <= max_df * topics)).select("term", "df", F.inline("in_")), "terms")
    totals = kept.groupBy("topic_id").agg(F.sum("n").alias("total"))
    idf = F.log((1 + F.lit(topics)) / (1 + F.col("df"))) + 1
    scored = kept.join(totals, "topic_id").withColumn("tf", F.col("n") / F.col("total"))
    return scored.select(F.col("topic_id").cast(kind).alias("topic_id"), "term", "n", "tf", "df", (F.col("tf") * idf).alias("score"))


def top_terms(scores: DataFrame, n: int = 12) -> DataFrame:
    """The best terms of each topic, by rank; ties by term."""
    w = Window.partitionBy("topic_id").orderBy(F.desc(F.round("score", 9)), "term")
    return scores.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n).select("topic_id", "rank", "term", "score")


def terms_table(top: DataFrame, posts: DataFrame) -> DataFrame:
    """The exchange form: terms and scores as lists with bars, and the number of posts."""
    lists = top.groupBy("topic_id").agg(F.sort_array(F.collect_list(F.struct("rank", "term", "score"))).alias("t"))
    counts = posts.groupBy("topic_id").agg(F.count("*").alias("post_count"))
    score = lambda x: F.format_string("%.6f", x["score"])
    return lists.join(counts, "topic_id").select("topic_id", "post_count", F.concat_ws("|", "t.term").alias("top_terms"), F.concat_ws("|", F.transform("t", score)).alias("top_scores"))
