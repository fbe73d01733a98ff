"""Tables that outlive a run: landed tables, versions by bucket, roll-ups, resumed steps, streams into them."""

import os
import shutil

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from agorascope.operators import merge
from agorascope.operators.filters import Filters, parse
from agorascope.plans import dashboard, runner
from agorascope.plans.rollup import DAY, PART, Rollups, week
from agorascope.queries.base import rounded
from agorascope.sources import store, tables, versioned
from agorascope.streaming import incremental

SMALL = "/root/testdata/sf0.001"


@pytest.fixture
def inputs(tmp_path):
    """Own copies of the inputs, written so that other numbers take as many bytes."""
    for name in ("orders", "lineitem"):
        plain(pq.read_table(f"{SMALL}/{name}.parquet"), f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


def plain(table, path):
    pq.write_table(table, path, compression="none", use_dictionary=False, write_statistics=False)


def rewrite(inputs):
    """All prices times ten, in a file of the same size."""
    path = f"{inputs}/orders.parquet"
    before, table = os.path.getsize(path), pq.read_table(path)
    at = table.schema.get_field_index("o_totalprice")
    import pyarrow.compute as pc

    plain(table.set_column(at, table.schema.field(at), pc.multiply(table.column(at), 10).cast(table.schema.field(at).type)), path)
    assert os.path.getsize(path) == before


def test_a_file_written_again_at_equal_size_gives_new_rows(spark, inputs):
    score = lambda: tables.posts(spark, inputs).agg(F.avg("score")).first()[0]
    before = score()
    assert score() == before
    rewrite(inputs)
    assert score() == pytest.approx(10 * before, rel=0.01)


def test_fingerprint(spark, inputs):
    paths = tables.sources(inputs)
    own = store.fingerprint(spark, *paths)
    assert own == store.fingerprint(spark, *reversed(paths)) and own != store.fingerprint(spark, paths[0]) and own != store.fingerprint(spark, *paths, more="x")
    os.utime(paths[0], (1, 1))
    assert store.fingerprint(spark, *paths) != own
    assert store.files_of(spark, *paths).count() == 2 and "content" not in store.files_of(spark, inputs).columns


def test_landed_tables_serve_later_sessions(spark, inputs):
    at = tables.version(spark, inputs)
    made = tables.posts(spark, inputs, at)
    want = made.count()
    root = f"{store.shared_dir(spark)}/landed"
    held = store.read_json(spark, f"{root}/posts-{at}.json")
    for t in spark.catalog.listTables():
        if t.name.startswith(("landed_", "posts_", "comments_")):
            spark.sql(f"DROP TABLE {t.name}")  # as a later session, whose catalog knows nothing

    def never():
        raise AssertionError("made again")

    again = store.landed(spark, "posts", tables.sources(inputs), at, 1, "post_id", never)
    assert again.count() == want
    plan = again.groupBy("post_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and again.schema == spark.read.parquet(held["place"]).schema


def test_replaced_tables_go(spark, inputs):
    first = tables.version(spark, inputs)
    tables.posts(spark, inputs, first)
    rewrite(inputs)
    second = tables.version(spark, inputs)
    tables.posts(spark, inputs, second)
    root = f"{store.shared_dir(spark)}/landed"
    assert not store.sweep(spark)  # others may read them still
    place = store.read_json(spark, f"{root}/posts-{first}.json")["place"]
    assert {f"posts-{first}.json", f"comments-{first}.json"} <= set(store.sweep(spark, 0))
    assert store.read_json(spark, f"{root}/posts-{first}.json") is None and not store.names(spark, place)
    assert tables.posts(spark, inputs, second).count()


def test_small_files_are_made_once(spark, tmp_path):
    path = f"file://{tmp_path}/a/b.json"
    assert store.read_json(spark, path) is None and store.create_json(spark, path, {"n": 1}) and not store.create_json(spark, path, {"n": 2})
    assert store.read_json(spark, path) == {"n": 1} and store.names(spark, f"file://{tmp_path}/a") == ["b.json"]
    left = f"file://{tmp_path}/a/c.json"
    (tmp_path / "a/c.json.lock").write_text("")
    os.utime(tmp_path / "a/c.json.lock", (1, 1))  # of a writer that died
    assert store.create_json(spark, left, {"n": 3}) and store.read_json(spark, left) == {"n": 3}


# --- versions


ROW = "id long, v string, n int"


def rows_of(spark, *rows):
    return spark.createDataFrame(list(rows), ROW)


def put(old, new):
    return merge.upsert(old, new, "id", F.current_timestamp())


def test_only_touched_buckets_are_written(spark, tmp_path):
    table = versioned.Keyed(spark, f"file://{tmp_path}/t", spark.createDataFrame([], ROW).schema, "id", 16)
    assert table.read().count() == 0 and table.version() == 0
    many = spark.range(400).select("id", F.lit("a").alias("v"), F.lit(1).alias("n"))
    assert len(table.apply(many, put)) == 16
    before = table.parts()
    few = rows_of(spark, (3, "b", 2), (401, "c", 3))
    touched = table.apply(few, put)
    after = table.parts()
    assert 1 <= len(touched) <= 2 and {k for k in after if after[k] != before[k]} == set(touched)
    want = merge.upsert(many, few, "id", F.current_timestamp())
    assert sorted(map(tuple, table.read().collect())) == sorted(map(tuple, want.collect()))
    assert table.read(version=1).where("v <> 'a'").count() == 0  # the version before stays readable
    assert table.read(touched).where("id in (3, 401)").count() == 2
    again = versioned.Keyed(spark, f"file://{tmp_path}/t")
    assert (again.key, again.buckets, again.version()) == ("id", 16, 2)
    assert table.apply(rows_of(spark, (3, "b", 2)).limit(0), put) == []


def test_parts_without_rows_go(spark, tmp_path):
    table = versioned.Keyed(spark, f"file://{tmp_path}/t", spark.createDataFrame([], ROW).schema, "id", 4)
    table.apply(spark.range(40).select("id", F.lit("a").alias("v"), F.lit(1).alias("n")), put)
    gone = table.apply(spark.range(40).where("id < 40").select("id", F.lit("a").alias("v"), F.lit(1).alias("n")), lambda old, new: old.where("false"))
    assert len(gone) == 4 and table.parts() == {} and table.read().count() == 0
    odd = rows_of(spark, (1, "x", 1)).withColumn(versioned.PART, F.lit("7"))
    with pytest.raises(ValueError, match="not to change"):
        table.replace(odd, ["1"], table.version())


def test_conflicts(spark, tmp_path):
    table = versioned.Keyed(spark, f"file://{tmp_path}/t", spark.createDataFrame([], ROW).schema, "id", 4)
    table.apply(rows_of(spark, (1, "a", 1)), put)
    other, turns = versioned.Keyed(spark, f"file://{tmp_path}/t"), []

    def slow(old, new):
        """Another writer comes in between, the first time."""
        if not turns:
            other.apply(rows_of(spark, (1, "other", 5), (9, "other", 5)), put)
        turns.append(1)
        return merge.upsert(old, new, "id", F.current_timestamp(), keep=["n"])

    table.apply(rows_of(spark, (1, "mine", 7)), slow)
    assert len(turns) == 2 and sorted(map(tuple, table.read().collect())) == [(1, "mine", 5), (9, "other", 5)]
    turns.clear()
    with pytest.raises(versioned.Conflict):
        table.apply(rows_of(spark, (1, "mine", 8)), slow, tries=1)
    assert table.read().where("id = 1").first()["v"] == "other"


def test_batches_count_once_and_vacuum(spark, tmp_path):
    table = versioned.Keyed(spark, f"file://{tmp_path}/t", spark.createDataFrame([], ROW).schema, "id", 4)
    for n in (0, 1, 1, 0):
        table.apply(rows_of(spark, (n, f"batch {n}", n), (9, f"batch {n}", n)), put, ("s", n))
    assert table.version() == 2 and table.read().where("id = 9").first()["v"] == "batch 1"
    for n in range(2, 6):
        table.apply(rows_of(spark, (9, f"batch {n}", n)), put, ("s", n))
    want = sorted(map(tuple, table.read().collect()))
    folders = len(store.names(spark, f"file://{tmp_path}/t/data"))
    table.vacuum(keep=1)
    assert table.versions() == [6] and len(store.names(spark, f"file://{tmp_path}/t/data")) < folders
    assert sorted(map(tuple, table.read().collect())) == want


def test_upsert_sink(spark, tmp_path):
    """Two runs of a stream: the second rewrites the buckets of its keys."""
    path, key = f"file://{tmp_path}/t", f"{tmp_path}/k"
    spark.range(100).select("id", F.lit("a").alias("v"), F.lit(1).alias("n")).coalesce(1).write.parquet(f"{tmp_path}/s")
    source = spark.readStream.schema(ROW).parquet(f"{tmp_path}/s")
    incremental.upsert_sink(source, spark, path, "id", key, F.current_timestamp(), 8).awaitTermination()
    table = versioned.Keyed(spark, path)
    before = table.parts()
    rows_of(spark, (5, "b", 2)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/s")
    incremental.upsert_sink(source, spark, path, "id", key, F.current_timestamp(), 8).awaitTermination()
    after = table.parts()
    assert sum(after[k] != before[k] for k in after) == 1 and table.read().count() == 100 and table.read().where("v = 'b'").count() == 1
    # A trigger that is lost after its commit runs again: the batch is known.
    shutil.rmtree(f"{key}/commits")
    incremental.upsert_sink(source, spark, path, "id", key, F.current_timestamp(), 8).awaitTermination()
    assert table.parts() == after


# --- roll-ups


def same(a, b):
    """Equal rows, doubles to six digits."""
    norm = lambda df: sorted((tuple(r[c] for c in sorted(df.columns)) for r in rounded(df).collect()), key=repr)
    x, y = norm(a), norm(b)
    near = lambda v: pytest.approx(v, abs=2e-6) if isinstance(v, float) else v
    assert x == [tuple(map(near, r)) for r in y]


CALLS = {
    "overview": lambda p, c, f: dashboard.overview(p, c, f), "stance_sentiment": lambda p, c, f: dashboard.stance_sentiment(p, c, f), "trends": lambda p, c, f: dashboard.trends(p, c, f), "topics": lambda p, c, f: dashboard.topics(p, f),
    "subreddits": lambda p, c, f: dashboard.subreddits(p, f), "opinion_map_topics": lambda p, c, f: dashboard.opinion_map_topics(p, f), "topic_insights": lambda p, c, f: dashboard.topic_insights(p, f), "sankey": lambda p, c, f: dashboard.sankey(p, c, f),
    "polarization_timeline": lambda p, c, f: dashboard.polarization_timeline(p, c, f), "leaderboard_posts": lambda p, c, f: dashboard.leaderboard_posts(p, c, f), "leaderboard_topics": lambda p, c, f: dashboard.leaderboard_topics(p, c, f), "topic_heatmap": lambda p, c, f: dashboard.topic_heatmap(p, f),
}


def odd_rows(spark):
    """Posts and comments with nulls, orphans, times of 0, and a range that begins within a day."""
    posts, comments = tables.posts_and_comments(spark, SMALL)
    last = comments.agg(F.max("created_utc")).first()[0]
    more = comments.limit(4).withColumns({"comment_id": F.concat(F.lit("odd"), "comment_id"), "post_id": F.lit("nowhere"), "created_utc": F.when(F.col("upvote_score") % 2 == 0, F.lit(None)).otherwise(F.lit(0)).cast("long")})
    late = comments.limit(6).withColumns({"comment_id": F.concat(F.lit("late"), "comment_id"), "created_utc": F.lit(last - 90 * DAY) + F.col("upvote_score") * 1000})
    dated = posts.withColumn("created_utc", F.col("created_utc") + F.col("post_id").cast("long") % 5 * 20_000)
    return dated, store.kept(comments.unionByName(more).unionByName(late), "odd"), last


def test_rollups_equal_the_rows_within_a_day(spark, tmp_path):
    posts, comments, last = odd_rows(spark)
    held = Rollups(spark, f"file://{tmp_path}/r", store.kept(posts, "odd"), comments)
    held.refresh()
    for f in (parse("all", now=0), parse("90d", now=last + 40_000), parse("365d", "1-URGENT", "topic_3", now=last + 7)):
        for name, work in CALLS.items():
            same(getattr(held, name)(f), work(held.posts, comments, f))
    nothing = Filters("all", subreddit="no such")
    for name, work in CALLS.items():
        same(getattr(held, name)(nothing), work(held.posts, comments, nothing))


def test_a_batch_refreshes_its_weeks(spark, tmp_path):
    posts, comments = tables.posts_and_comments(spark, SMALL)
    day = comments.agg(F.percentile_approx("created_utc", 0.5)).first()[0] // DAY * DAY
    late = F.col("created_utc").between(day, day + DAY - 1)
    Rollups(spark, f"file://{tmp_path}/r", posts, comments.where(~late)).refresh()
    held = Rollups(spark, f"file://{tmp_path}/r", posts, comments)
    before = {n: held.table(n).parts() for n in ("comment_cells", "post_days", "post_cells")}
    weeks = held.weeks_of(comments.where(late))
    assert len(weeks) == 1
    held.refresh(weeks, ("comment_cells", "post_days"), ("days", day))
    for name, old in before.items():
        new = held.table(name).parts()
        assert {k for k in {**old, **new} if old.get(k) != new.get(k)} == (set() if name == "post_cells" else set(weeks))
    f = parse("all", now=0)
    for name in ("overview", "stance_sentiment", "leaderboard_posts", "sankey"):
        same(getattr(held, name)(f), CALLS[name](posts, comments, f))
    assert held.refresh(weeks, ("comment_cells",), ("days", day)) == {}  # a batch that comes again
    assert comments.where(late).select(week()).distinct().count() == 1 and PART not in held.rows("post_days", f).columns


def test_a_range_reads_its_weeks(spark, tmp_path):
    posts, comments = tables.posts_and_comments(spark, SMALL)
    held = Rollups(spark, f"file://{tmp_path}/r", posts, comments)
    held.refresh()
    last = comments.agg(F.max("created_utc")).first()[0]
    files = held.rows("comment_cells", parse("30d", now=last - last % DAY)).inputFiles()
    assert 1 <= len({x.split(f"{PART}=")[1].split("/")[0] for x in files}) <= 6 < len(held.table("comment_cells").parts())


# --- steps


def steps_of(calls, fail=()):
    """A chain of six steps that say when they work."""
    def step(i):
        def work(df):
            calls.append(i)
            if i in fail:
                raise RuntimeError("lost")
            return df.withColumn(f"c{i}", F.lit(i))

        return runner.Step(f"s{i}", (f"s{i - 1}" if i > 1 else "in",), work)

    return [step(i) for i in range(1, 7)]


def test_a_run_goes_on_where_it_was_lost(spark, inputs):
    state, calls, log = runner.State(spark, "lost"), [], []
    rows = spark.read.parquet(f"{inputs}/orders.parquet").select("o_orderkey")
    versions = {"in": store.fingerprint(spark, f"{inputs}/orders.parquet")}
    with pytest.raises(RuntimeError, match="lost"):
        runner.run(steps_of(calls, {5}), {"in": rows}, state=state, versions=versions)
    assert calls == [1, 2, 3, 4, 5]
    calls.clear()
    later = runner.State(spark.newSession(), "lost")
    made, failed = runner.run(steps_of(calls), {"in": rows}, state=later, versions=versions, log=log)
    assert calls == [5, 6] and not failed and made["s6"].count() == 1500 and made["s6"].columns[-1] == "c6"
    assert log == [(f"s{i}", "found" if i < 5 else "made") for i in range(1, 7)]
    # The file is written again: everything works again, and the tables before go once they are old enough.
    rewrite(inputs)
    calls.clear()
    versions = {"in": store.fingerprint(spark, f"{inputs}/orders.parquet")}
    made, _ = runner.run(steps_of(calls), {"in": rows}, state=state, versions=versions)
    assert calls == [1, 2, 3, 4, 5, 6]
    current, before = {}, versions["in"]
    for s in steps_of([]):
        current[s.name] = before = runner.State.version(s, [before])
    assert len(state.sweep(current, 0)) == 6 and made["s6"].count() == 1500 and len(store.names(spark, state.root)) == 12


def test_a_step_of_another_version_runs_again_with_what_follows(spark, inputs):
    state, calls = runner.State(spark, "versions"), []
    rows, versions = spark.range(3), {"in": "given"}
    runner.run(steps_of(calls), {"in": rows}, state=state, versions=versions)
    changed = [runner.Step(s.name, s.needs, s.work, version="2" if s.name == "s4" else "") for s in steps_of(calls)]
    calls.clear()
    runner.run(changed, {"in": rows}, state=state, versions=versions)
    assert calls == [4, 5, 6]
    calls.clear()
    runner.run(changed, {"in": rows}, state=state)  # nobody knows what the input is
    assert calls == [1, 2, 3, 4, 5, 6]


def test_standard_steps_end_with_labels(spark, tmp_path):
    """Topics get names and ratings, comments labels, and distributions follow from these; a second run finds all."""
    posts = spark.createDataFrame([(f"{i:02d}", "cats purr" if i % 2 else "dogs bark", "and more of it", True) for i in range(40)], "post_id string, title string, selftext string, is_self boolean").withColumns({"topic_id": F.lit(None).cast("string"), "center_distance": F.lit(None).cast("double")})
    said = ["yes and the good one", "no, bad", "hm, well then"]
    comments = spark.createDataFrame([(f"{i % 4:02d}", f"c{i}", said[i % 3], 3, None if i else "agree", None if i else "positive", None, 1000 + i) for i in range(24)], "post_id string, comment_id string, comment_text string, upvote_score long, stance_label string, sentiment_label string, llm_confidence double, created_utc long")
    state, log = runner.State(spark, "standard"), []
    given = {"posts": store.kept(posts, "posts"), "comments": store.kept(comments, "comments")}
    made, failed = runner.run(runner.standard_steps(), given, state=state, versions={"posts": "1", "comments": "1"}, log=log)
    assert not failed and [x for x, _ in log] == runner.order(runner.standard_steps())
    names = {r.topic_id: r.topic_name for r in made["topic_names"].collect()}
    assert names and all(v == f"Name of {k}" for k, v in names.items())
    assert made["named_posts"].where("topic_id <> 'noise' and topic_name is null").count() == 0
    got = {r.comment_id: (r.stance_label, r.sentiment_label, r.llm_confidence) for r in made["labelled"].collect()}
    assert got["c0"] == ("agree", "positive", None) and got["c1"] == ("disagree", "negative", 0.75) and got["c2"] == ("unclear", "positive", 0.75) and got["c3"] == ("agree", "positive", 0.75) and len(got) == 24
    found = {r.post_id: r for r in made["distributions"].collect()}
    assert set(found) == {"00", "01", "02", "03"} and all(r.stance_count == 4 for r in found.values())
    log.clear()
    runner.run(runner.standard_steps(), given, state=state, versions={"posts": "1", "comments": "1"}, log=log)
    assert {x for _, x in log} == {"found"}
    log.clear()
    runner.run(runner.standard_steps(model_name="another"), given, state=state, versions={"posts": "1", "comments": "1"}, log=log)
    assert {n for n, x in log if x == "made"} == {"topic_names", "named_posts", "ratings", "labels", "labelled", "weighted", "distributions"}


# --- windows of streams


def streamed(spark, tmp_path, rows, make, name, mode="complete"):
    rows.repartition(3).write.parquet(f"{tmp_path}/c")
    found = make(incremental.comment_stream(spark, f"{tmp_path}/c", rows.schema, 1))
    q = found.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    q.awaitTermination()
    return sorted(map(tuple, spark.table(name).collect()), key=repr)


def test_sliding_stream_equals_batch(spark, tmp_path):
    rows = tables.comments(spark, SMALL)
    want = sorted(map(tuple, incremental.sliding(rows, late="36500 days").collect()), key=repr)
    assert streamed(spark, tmp_path, rows, lambda c: incremental.sliding(c, late="36500 days"), "slid") == want and len(want) > 100


def test_session_stream_equals_batch(spark, tmp_path):
    """Sessions whose end the watermark has passed come out once, whole, though their comments came out of order."""
    rows = tables.comments(spark, SMALL)
    make = lambda c: incremental.sessions(c, "10 days", late="36500 days")
    want = sorted(map(tuple, make(rows).collect()), key=repr)
    assert streamed(spark, tmp_path, rows, make, "sessions") == want and len(want) > 100
