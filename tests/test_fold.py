"""The stateful fold against the batch over what the comments are in the end."""

import random

import pytest
from pyspark.sql import functions as F

from agorascope.operators import weights
from agorascope.sources import store
from agorascope.streaming import fold, incremental

ROW = "post_id string, comment_id string, comment_text string, upvote_score long, stance_label string, sentiment_label string, llm_confidence double, created_utc long, changed_utc long"
DAY = 86_400


@pytest.fixture
def rocks(spark):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", fold.STORE)
    yield spark
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def comment(r, post, n, created, changed=None):
    return (f"p{post}", f"c{post}-{n}", "text", r.randint(-2, 40), r.choice(["agree", "Support", "against", "neutral", "unclear", None]), r.choice(["pos", "negative", "neutral", None]), r.choice([None, 0.2, 0.9]), created, created if changed is None else changed)


def streamed(spark, tmp_path, batches, **options):
    """The last row of each post after all batches, each a file of its own, in their order."""
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, ROW).coalesce(1).write.parquet(f"{tmp_path}/in/{i:03}")
    spark.read.option("recursiveFileLookup", "true").schema(ROW).parquet(f"{tmp_path}/in")
    source = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    seen = []

    def take(rows, n):
        seen.append({r.post_id: tuple(r)[1:] for r in rows.collect()})

    fold.post_fold(source, **options).writeStream.foreachBatch(take).outputMode("update").option("checkpointLocation", f"{tmp_path}/k").trigger(availableNow=True).start().awaitTermination()
    return {k: v for batch in seen for k, v in batch.items()}, seen


def batch_of(spark, rows):
    from agorascope.queries.operators import _flat

    found = _flat(weights.post_distribution(fold.latest(spark.createDataFrame(rows, ROW))))
    return {r.post_id: tuple(r)[1:] for r in found.select("post_id", "agree", "disagree", "neutral", "positive", "negative", "neutral_sentiment", "polarization_score", "stance_count", "sentiment_count").collect()}


def assert_same(got, want):
    assert got.keys() == want.keys()
    for k, v in want.items():
        assert [x if x is None else pytest.approx(x, abs=1e-9) for x in v] == list(got[k]), k


def test_fold_equals_batch(rocks, tmp_path):
    """Comments out of order, twice, and corrected within the correction time, over several triggers."""
    r = random.Random(7)
    first = [comment(r, p, n, 100 * DAY + r.randint(0, 2 * DAY)) for p in range(12) for n in range(r.randint(1, 14))]
    r.shuffle(first)
    fixed = [comment(r, int(x[0][1:]), int(x[1].split("-")[1]), x[7], x[7] + r.randint(1, 2 * DAY)) for x in first if r.random() < 0.4]
    again = r.sample(first, 10) + r.sample(fixed, 5)
    more = [comment(r, p, 100 + n, 102 * DAY + r.randint(0, DAY)) for p in range(6) for n in range(3)]
    lost = [(None, "cx", "t", 1, "agree", "pos", None, 102 * DAY, 102 * DAY), ("p0", None, "t", 1, "agree", "pos", None, 102 * DAY, 102 * DAY)]
    batches = [first[:40], fixed[: len(fixed) // 2] + first[40:60], first[60:] + lost, again, fixed[len(fixed) // 2 :] + more]
    got, seen = streamed(rocks, tmp_path, batches, late="30 days")
    rows = [x for b in batches for x in b if x[0] and x[1]]
    assert_same(got, batch_of(rocks, rows))
    assert len(seen) >= 5 and any(v[7] for v in got.values())


def test_fold_forgets_after_the_correction_time(rocks, tmp_path):
    """An old comment's share stays, its later change is left out, and new comments of the post still count."""
    r = random.Random(8)
    old = [comment(r, 0, n, 100 * DAY + n) for n in range(8)]
    move = [comment(r, 1, 0, 120 * DAY)]
    change = [(*old[0][:4], "disagree", "negative", 1.0, old[0][7], 121 * DAY)]
    new = [comment(r, 0, 50, 121 * DAY)]
    got, _ = streamed(rocks, tmp_path, [old, move, move, change + new])
    assert_same(got, batch_of(rocks, [*old, *move, *new]))


def test_fold_of_the_tables(rocks, tmp_path, small):
    """Comments of the test table, a fifth of them relabelled a day later, equal the batch."""
    from agorascope.sources import tables

    rows = tables.comments(rocks, small).where("post_id < '2'").withColumn("changed_utc", F.lit(1_000 * DAY) + F.col("created_utc") % DAY).select([c.split()[0] for c in ROW.split(", ")])
    some = rows.where("xxhash64(comment_id) % 5 = 0").withColumns({"stance_label": F.lit("disagree"), "changed_utc": F.col("changed_utc") + DAY, "created_utc": F.col("changed_utc")})
    rows = rows.withColumn("created_utc", F.col("changed_utc"))
    for i, part in enumerate((rows, some)):
        part.coalesce(2).write.parquet(f"{tmp_path}/in/{i}")
    source = rocks.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
    last = {}
    fold.post_fold(source, late="30 days").writeStream.foreachBatch(lambda b, n: last.update({r.post_id: tuple(r)[1:] for r in b.collect()})).outputMode("update").option("checkpointLocation", f"{tmp_path}/k").trigger(availableNow=True).start().awaitTermination()
    every = [tuple(x) for x in store.kept(rows.unionByName(some), "all").select([c.split()[0] for c in ROW.split(", ")]).collect()]
    assert_same(last, batch_of(rocks, every))
    assert incremental.post_sums(rows).count() == len(last)
