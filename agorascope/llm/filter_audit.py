"""Filter interaction audit: every document is replayed through all orders of five filters.

Flags of documents, one bit per failed filter, are crossed with the 120 orders, which are broadcast; each pair explodes into
its five steps; the first failing filter of the order says at which step the document goes, and conditional sums per part,
order and step are combined on the map side, so what is shuffled is 600 rows per part and task at most.

Null texts are empty ones, a null part is the empty string. A copy is a row whose text some smaller id has; rows of one id
are no copies of each other, and a null id is neither smaller nor larger than another, and has no labels. Several labels of
one id count as their largest. Extra columns are ignored, repeated rows count each, an empty table gives no rows.
"""

from __future__ import annotations

import math
from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agorascope.llm.staging import Stage

FILTERS = "ABCDE"
#: Replayed steps in a task.
STEPS_A_TASK = 8_000_000


def failed(text: Column) -> dict[str, Column]:
    """Whether a text fails each filter that looks at nothing but the text."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    n = F.size(words)
    return {
        "A": n < 200,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 50 * n.cast("long"),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 2 * F.length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def mask(flags: dict[str, Column]) -> Column:
    """The flags as one number, a bit per filter in the order of FILTERS."""
    return sum((F.when(flag, 1 << FILTERS.index(name)).otherwise(0) for name, flag in flags.items()), F.lit(0))


def document_flags(docs: DataFrame, labels: DataFrame, stage: Stage, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """part, fails (bits of FILTERS), good, toxic: one row per document. Texts are read once; what moves is their digest."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text.alias("text"))
    rows = stage.table(rows.select("doc_id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask(failed(F.col("text"))).alias("own")), "own")
    # Written out, so that a hot text or id is one side of a join that adaptive execution can split.
    copied = stage.table(rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id")).where("first_id < last_id").drop("last_id"), "copied")
    marks = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic"))
    marks = stage.table(marks.where("doc_id is not null and (good or toxic)"), "marks")
    rows = rows.join(copied, "digest", "left").join(marks, "doc_id", "left")
    copy = F.when(F.col("doc_id") > F.col("first_id"), 1 << FILTERS.index("E")).otherwise(0)
    no = F.lit(False)
    return rows.select("part", (F.col("own") + copy).alias("fails"), F.coalesce("good", no).alias("good"), F.coalesce("toxic", no).alias("toxic"))


def orders(like: DataFrame) -> DataFrame:
    """The 120 orders: filter_order and bits, those of its filters from first to last."""
    rows = [("".join(p), [1 << FILTERS.index(x) for x in p]) for p in permutations(FILTERS)]
    return like.sparkSession.createDataFrame(rows, "filter_order string, bits array<int>")


def audit(docs: DataFrame, labels: DataFrame, **columns: str) -> DataFrame:
    """part, filter_order, step and the counts of each step; see the module."""
    stage = Stage(docs.sparkSession, "audit")
    flags = stage.table(document_flags(docs, labels, stage, **columns), "flags")
    stage.drop("own", "copied", "marks")
    tasks = math.ceil(flags.count() * 600 / STEPS_A_TASK)
    replay = flags.repartition(max(1, tasks)).crossJoin(F.broadcast(orders(docs)))
    fails, bit, step, first = F.col("fails"), F.col("bit"), F.col("step"), F.col("first")
    met = F.when(fails.bitwiseAND(F.element_at("bits", 1)) != 0, 1)
    for i in range(2, len(FILTERS) + 1):
        met = met.when(fails.bitwiseAND(F.element_at("bits", i)) != 0, i)
    replay = replay.withColumn("first", met.otherwise(len(FILTERS) + 1))
    steps = replay.select("part", "filter_order", "fails", "good", "toxic", "first", F.posexplode("bits").alias("place", "bit")).withColumn("step", F.col("place") + 1)
    number = lambda condition: F.sum(condition.cast("long"))
    counts = steps.groupBy("part", "filter_order", "step", "bit").agg(
        number(first > step).alias("kept"),
        number(first == step).alias("removed"),
        number((first < step) & (fails.bitwiseAND(bit) != 0)).alias("redundant"),
        number(fails == bit).alias("unique_fails"),
        number((first == step) & F.col("good")).alias("good_lost"),
        number((first == step) & F.col("toxic")).alias("toxic_lost"),
    )
    counts = stage.table(counts, "counts")
    share = counts.groupBy("part", "bit").agg(F.sum("removed").alias("shapley"))
    return counts.join(share, ["part", "bit"]).select("part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


#: The replay in DuckDB.
SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), first_ids AS (
  SELECT text AS same, min(doc_id) AS first_id FROM words GROUP BY text
), marks AS (
  SELECT doc_id AS marked, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY doc_id
), flags AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    concat(CASE WHEN len(w) < 200 THEN 'A' ELSE '' END,
      CASE WHEN 100 * len(list_distinct(w)) < 50 * len(w) THEN 'B' ELSE '' END,
      CASE WHEN 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 2 * length(text) THEN 'C' ELSE '' END,
      CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
      CASE WHEN doc_id > first_id THEN 'E' ELSE '' END) AS fails
  FROM words JOIN first_ids ON text = same LEFT JOIN marks ON doc_id = marked
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x
), orders AS (
  SELECT concat(a.x, b.x, c.x, d.x, e.x) AS filter_order FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), replay AS (
  SELECT *, coalesce(list_min(list_filter([CASE WHEN contains(fails, filter_order[i]) THEN i END FOR i IN [1, 2, 3, 4, 5]], lambda p: p IS NOT NULL)), 6) AS gone FROM flags, orders
), steps AS (
  SELECT *, filter_order[step] AS f FROM replay, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), counts AS (
  SELECT part, filter_order, step, f, count(*) FILTER (WHERE gone > step) AS kept, count(*) FILTER (WHERE gone = step) AS removed,
    count(*) FILTER (WHERE gone < step AND contains(fails, f)) AS redundant, count(*) FILTER (WHERE fails = f) AS unique_fails,
    count(*) FILTER (WHERE gone = step AND good = 1) AS good_lost, count(*) FILTER (WHERE gone = step AND toxic = 1) AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM counts
"""
