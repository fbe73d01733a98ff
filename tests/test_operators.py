import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from agorascope.operators import cluster, ctfidf, ingest, manifold, merge, packing, quality, ranks, sampling, sets
from agorascope.plans import inference, labeling, runner


@pytest.mark.parametrize("total", [1, 20, 22, 25, 26])
def test_near_far(spark, total):
    rows = spark.createDataFrame([("t", f"{i:03d}", float(i // 2)) for i in range(total)], "topic_id string, post_id string, distance double")
    got = {r.post_index: r.tag for r in sampling.near_far(rows).collect()}
    assert sum(t == "NEAR" for t in got.values()) == min(20, total) and sum(t == "FAR" for t in got.values()) == max(0, min(5, total - 20))
    assert all(got[i] == "NEAR" for i in range(min(20, total)))


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 50), max_size=40), st.integers(1, 60), st.integers(1, 6))
def test_next_fit(sizes, budget, most):
    got = packing.next_fit(sizes, budget, most)
    assert [g is None for g in got] == [s > budget for s in sizes]
    kept = [(g, s) for g, s in zip(got, sizes, strict=True) if g is not None]
    assert [g for g, _ in kept] == sorted(g for g, _ in kept)
    for b in {g for g, _ in kept}:
        own = [s for g, s in kept if g == b]
        assert sum(own) <= budget and len(own) <= most


def test_first_fit_skip():
    assert packing.first_fit_skip([5, 9, 3, 2], 10) == [0, None, 0, 0] and packing.first_fit_skip([5], 10, 6) == [None]


def folded(sizes, budget, most, ends):
    """Next fit in one pass, by its definition."""
    out, batch, used, count = [], -1, 0, 0
    for s in sizes:
        if s is None or s > budget:
            used, count = (0, 0) if ends and s is not None else (used, count)
            out.append(None)
        elif not count or used + s > budget or (most and count >= most):
            batch, used, count = batch + 1, s, 1
            out.append(batch)
        else:
            used, count = used + s, count + 1
            out.append(batch)
    return out


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.integers(0, 12), max_size=9), max_size=6), st.integers(1, 10), st.sampled_from([None, 1, 2, 5]), st.booleans())
def test_ranges_compose(ranges, budget, most, ends):
    """Packing every range from the batch open where it begins is packing all in one pass."""
    sums = [(i, "", budget, "", *packing.summary(np.array([s for s in part if ends or s <= budget], int), budget, most, ends)) for i, part in enumerate(ranges)]
    entered = packing.entered(sums, most)
    whole, at = folded([s for part in ranges for s in part], budget, most, ends), 0
    for (_, batches, _, _, _), part in zip(entered, ranges, strict=True):
        begun = [b for b in whole[:at] if b is not None]
        assert batches == (max(begun) + 1 if begun else 0)
        at += len(part)


def by_group(groups, sizes, budget, most, ends):
    """Next fit of each group by itself, in one pass."""
    out = {}
    for g in set(groups):
        at = [i for i, x in enumerate(groups) if x == g]
        out |= {i: b for i, b in zip(at, folded([sizes[i] for i in at], budget, most, ends), strict=True) if b is not None}
    return out


@pytest.mark.parametrize("ends", [False, True])
@pytest.mark.parametrize("parts", [1, 4, 23])
def test_packed_by_group(spark, ends, parts):
    """A group with nearly all rows and many small ones, cut by ranges anywhere: each is packed by itself."""
    r = np.random.default_rng(parts)
    groups = [None if i % 97 == 0 else "hot" if i % 3 else f"g{i // 7}" for i in range(600)]
    sizes = [int(x) if x else None for x in r.integers(0, 26, 600)]
    rows = spark.createDataFrame([(i, g, s) for i, (g, s) in enumerate(zip(groups, sizes, strict=True))], "k long, g string, n long")
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": str(parts)}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        found = packing.packed_in_order(rows, ["k"], "n", 20, 4, ends, group=["g"])
        got = {x.k: x.batch for x in found.collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert found.columns == ["k", "g", "n", "batch"] and got == by_group(groups, sizes, 20, 4, ends)


def test_each_group_has_its_budget(spark):
    groups = [f"g{i // 9 % 5}" for i in range(300)]
    sizes = [1 + i * i % 11 for i in range(300)]
    rooms = {f"g{k}": 6 + 5 * k for k in range(5)}
    rows = spark.createDataFrame([(i, g, s, rooms[g]) for i, (g, s) in enumerate(zip(groups, sizes, strict=True))], "k long, g string, n long, room long")
    got = {x.k: x.batch for x in packing.packed_in_order(rows.repartition(5), ["k"], "n", "room", None, True, group=["g"]).collect()}
    want = {}
    for g, room in rooms.items():
        at = [i for i, x in enumerate(groups) if x == g]
        want |= {i: b for i, b in zip(at, folded([sizes[i] for i in at], room, None, True), strict=True) if b is not None}
    assert got == want


def test_no_group_is_packed_in_one_task(spark):
    plan = packing.packed_in_order(spark.range(9).selectExpr("id as k", "1 as g", "2L as n"), ["k"], "n", 20, group=["g"])._jdf.queryExecution().toString()
    assert "FlatMapGroupsInPandas" not in plan and "hashpartitioning(g" not in plan


def test_first_rows_leave_tasks_cut(spark):
    """A rank under a limit is cut before the shuffle, so a hot topic sends a few rows a task."""
    rows = spark.range(5000).repartition(3).selectExpr("if(id < 5000, 'hot', cast(id as string)) as topic_id", "cast(id as string) as post_id", "cast(id % 100 as double) as distance", "id as score", "id % 1000 as created_utc")
    plan = sampling.near_far(rows)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    got = {x.post_index: (x.tag, x.distance) for x in sampling.near_far(rows).collect()}
    assert sorted(got) == [*range(20), *range(4995, 5000)] and got[0] == ("NEAR", 0.0) and got[4999] == ("FAR", 99.0)
    taken = sampling.sample(rows, F.lit(31), F.lit(True)).groupBy("taken").count().collect()
    assert {x.taken: x["count"] for x in taken} == {"score": 11, "early": 5, "late": 5, "random": 10}


def sampled(rows, size, dominant):
    """Which row is taken how, step by step over all rows."""
    def third(n):
        return n // 3 + (n % 3 >= 1) if dominant else n // 2, n // 3 if dominant else 0

    out, (score, time) = {}, third(size)
    left = lambda: [r for r in rows if r["post_id"] not in out]
    for how, quota, key in (("score", score, lambda r: (-r["score"], r["post_id"])), ("early", time // 2, lambda r: (r["created_utc"], r["post_id"])), ("late", time - time // 2, lambda r: (-r["created_utc"], r["post_id"]))):
        out |= {r["post_id"]: how for r in sorted(left(), key=key)[:quota]}
    return out | {r["post_id"]: "random" for r in sorted(left(), key=lambda r: (r["hash"], r["post_id"]))[: size - len(out)]}


@pytest.mark.parametrize("dominant", [True, False])
def test_sample_is_that_over_all_rows(spark, dominant):
    """The candidates hold every row that a pass over whole topics would take, the random ones too."""
    r = np.random.default_rng(6)
    data = [(t, f"{t}{i:03d}", int(r.integers(0, 30)), int(r.integers(0, 60))) for t, n in (("a", 300), ("b", 12), ("c", 40)) for i in range(n)]
    rows = spark.createDataFrame(data, "topic_id string, post_id string, score long, created_utc long").withColumn("hash", sampling.shuffled(42))
    every = [x.asDict() for x in rows.collect()]
    got = {x.post_id: x.taken for x in sampling.sample(rows, F.lit(20), F.lit(dominant)).collect()}
    assert got == {k: v for t in "abc" for k, v in sampled([x for x in every if x["topic_id"] == t], 20, dominant).items()}


@pytest.mark.parametrize("parts", [1, 9])
def test_places_by_ranges(spark, parts):
    """Running sums over a hot group, cut by ranges anywhere."""
    data = [(None if i % 50 == 0 else "hot" if i % 4 else "cold", i * 7 % 500, i % 5) for i in range(500)]
    rows = spark.createDataFrame(data, "g string, k long, w long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {x.k: (x.before_, x.all_) for x in ranks.placed(rows, ["g"], ["k"], "w").collect()}
        counted = {x.k: (x.before_, x.all_) for x in ranks.placed(rows, [], ["k"]).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    for g, k, _ in data:
        own = sorted((b, c) for a, b, c in data if a == g)
        assert got[k] == (sum(c for b, c in own if b < k), sum(c for _, c in own)) and counted[k] == (k, 500)


@pytest.mark.parametrize("ends", [False, True])
@pytest.mark.parametrize("parts", [1, 7])
def test_packed_in_order(spark, ends, parts):
    sizes = [1 + (i * i) % 7 for i in range(200)] + [50, 3, None, 4, 50]
    rows = spark.createDataFrame(list(enumerate(sizes)), "k long, n long")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {r.k: r.batch for r in packing.packed_in_order(rows, ["k"], "n", 20, 5, ends).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == {k: b for k, b in enumerate(folded(sizes, 20, 5, ends)) if b is not None}


def kept_neighbours(points, placed, k=15):
    """The share of each point's nearest that are its nearest in the layout as well."""
    near, _ = manifold.nearest(manifold.unit(points), manifold.unit(points), k + 1)
    far = ((placed[:, None] - placed[None]) ** 2).sum(-1)
    return np.mean([len(set(a) & set(b)) / (k + 1) for a, b in zip(near, np.argsort(far, 1)[:, : k + 1], strict=True)])


def test_umap(spark):
    r = np.random.default_rng(3)
    groups = [r.normal(0, 1, 16) for _ in range(3)]
    points = np.vstack([g + r.normal(0, 0.15, (80, 16)) for g in groups] + [groups[0][None], groups[0][None], np.zeros((1, 16))])
    rows = spark.createDataFrame([(f"{i:03d}", p.tolist(), "x") for i, p in enumerate(points)], "post_id string, embedding array<double>, more string")
    for sample in (4_000, 120):
        found = manifold.umap(rows, 2, sample=sample, epochs=100)
        assert found.columns == ["post_id", "embedding", "more", "projected"]
        got = {x.post_id: x.projected for x in found.collect()}
        again = {x.post_id: x.projected for x in manifold.umap(rows.repartition(5), 2, sample=sample, epochs=100).collect()}
        assert set(got) == set(again) and all(got[i] == pytest.approx(again[i], abs=1e-9) for i in got)
        y = np.array([got[f"{i:03d}"] for i in range(len(points))])
        assert np.isfinite(y).all()
        middles = [y[i * 80 : (i + 1) * 80].mean(0) for i in range(3)]
        nearest = np.argmin([((y[:240] - m) ** 2).sum(1) for m in middles], axis=0)
        assert (nearest == np.repeat([0, 1, 2], 80)).mean() > 0.98
    assert [x.projected for x in manifold.umap(rows.limit(1), 3).collect()] == [[0.0] * 3]
    assert manifold.umap(rows.where("false"), 3).collect() == []
    assert all(np.isfinite(x.projected).all() for x in manifold.umap(rows.limit(2), 2, epochs=20).collect())


def test_umap_keeps_more_neighbours_than_axes(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").select(F.col("vec_id").cast("string").alias("post_id"), "embedding")
    got = cluster.project(manifold.umap(cluster.usable(rows)), 2, out="flat").collect()
    points, placed, flat = (np.array([x[c] for x in got], float) for c in ("embedding", "projected", "flat"))
    assert kept_neighbours(points, placed) > 1.5 * kept_neighbours(points, flat)


def test_neighbour_pairs_are_all(spark):
    r = np.random.default_rng(4)
    for dim in (1, 2, 6):
        points = r.normal(0, 1, (60, dim))
        rows = spark.createDataFrame([(i, p.tolist()) for i, p in enumerate(points)], "k long, v array<double>")
        want = {(i, j) for i in range(60) for j in range(60) if i != j and np.linalg.norm(points[i] - points[j]) <= 0.7}
        got = [tuple(x) for x in cluster.neighbour_pairs(rows, 0.7, "k", "v").collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_packed_in_order_empty(spark):
    rows = spark.createDataFrame([], "k long, n long")
    assert packing.packed_in_order(rows, ["k"], "n", 20).collect() == []


def test_upsert(spark):
    old = spark.createDataFrame([("a", 1, "x", "t0"), ("b", 2, "y", "t0")], "id string, v int, extra string, created_at string")
    new = spark.createDataFrame([("a", None), ("c", 3), (None, 9)], "id string, v int")
    got = {r.id: (r.v, r.extra, r.created_at) for r in merge.upsert(old, new, "id", F.lit("t1")).collect()}
    assert got == {"a": (None, "x", "t0"), "b": (2, "y", "t0"), "c": (3, None, "t1")}
    assert {r.id: r.v for r in merge.upsert(old, new, "id", F.lit("t1"), preserve=True).collect()}["a"] == 1


def test_save_labels(spark):
    comments = spark.createDataFrame([("1", None, None, None, None), ("2", "agree", None, 0.1, None)], "comment_id string, stance_label string, sentiment_label string, llm_confidence double, llm_comment_exp string")
    new = spark.createDataFrame([(1, "1", "positive", "", 0.7, "r"), (2, "1", "negative", "disagree", 0.2, ""), (3, "2", "neutral", "disagree", 0.9, "z")], "order_ int, comment_id string, sentiment string, stance string, confidence double, rationale string")
    first = {r.comment_id: tuple(r)[1:] for r in merge.save_labels(comments, new).collect()}
    assert first == {"1": (None, "positive", 0.7, "r"), "2": ("agree", None, 0.1, None)}
    last = {r.comment_id: tuple(r)[1:] for r in merge.save_labels(comments, new, only_missing=False).collect()}
    assert last == {"1": ("disagree", "negative", 0.2, None), "2": ("disagree", "neutral", 0.9, "z")}


def test_best_per_topic(spark):
    rows = spark.createDataFrame([(1, "t", "a", "d", "0.5", "ok"), (2, "t", "b", "d", "0.5", ""), (3, "t", "", "d", "0.9", "ok"), (4, "t", "c", "d", "0.9", "error"), (5, "u", "e", "d", None, None)], "i int, topic_id string, topic_name string, topic_description string, confidence string, status string")
    assert {r.topic_id: r.topic_name for r in sets.best_per_topic(rows, "i").collect()} == {"t": "a", "u": "e"}


def test_match_by_id(spark):
    items = spark.createDataFrame([("a", 0), ("b", 1)], "post_id string, place int")
    named = spark.createDataFrame([("b", 0, 9)], "post_id string, place int, score int")
    assert [(r.post_id, r.score) for r in sets.match_by_id_or_place(items, named, "post_id").collect()] == [("b", 9)]
    bare = spark.createDataFrame([(None, 0, 5), (None, 1, 6)], "post_id string, place int, score int")
    assert sorted((r.post_id, r.score) for r in sets.match_by_id_or_place(items, bare, "post_id").collect()) == [("a", 5), ("b", 6)]


def test_apply_filters(spark):
    rows = spark.createDataFrame([("a", 5, 3, 100, "x"), ("a", 9, 3, 90, "x"), ("b", 7, 0, 100, None), ("c", 8, 9, 1, "y")], "post_id string, score long, num_comments long, created_utc long, category string")
    ids = lambda **k: [r.post_id for r in ingest.apply_filters(rows, ingest.Selection(**k), 100).collect()]
    assert ids() == ["a", "c", "b"] and ids(min_score=8) == ["a", "c"] and ids(deny=["y"]) == ["a", "b"] and ids(allow=["y"]) == ["c"] and ids(top_n=1) == ["a"] and ids(min_comments=0) == ["a", "c", "b"]


def test_sample_sizes(spark):
    rows = spark.createDataFrame([(t, f"{t}{i}", i % 10, i) for t, n in (("big", 100), ("small", 5)) for i in range(n)], "topic_id string, post_id string, score long, created_utc long")
    got = sampling.sample(rows, F.lit(11), F.col("topic_id") == "big")
    assert {r.topic_id: r.n for r in got.groupBy("topic_id").agg(F.countDistinct("post_id").alias("n")).collect()} == {"big": 11, "small": 5}


def test_dbscan(spark):
    r = np.random.default_rng(1)
    points = np.vstack([r.normal(0, 0.1, (20, 3)), r.normal(4, 0.1, (25, 3)), [[10, 10, 10], [-9, 3, 2]]])
    rows = spark.createDataFrame([(f"{i:03d}", p.tolist()) for i, p in enumerate(points)], "post_id string, embedding array<double>")
    got = [x.label for x in cluster.dbscan(rows, 0.6, 5).orderBy("post_id").collect()]
    assert got == [0] * 20 + [1] * 25 + [-1, -1]


def test_dbscan_of_a_dense_group(spark, monkeypatch):
    """Tables grow with the rows of a dense group and not with its pairs; labels are those of brute force, over several tiles."""
    r = np.random.default_rng(5)
    points = np.vstack([np.tile(r.normal(0, 1, 8), (900, 1)), r.normal(0, 0.5, (500, 8)), r.normal(9, 1.2, (100, 8))])
    keys = [f"{i:04d}" for i in r.permutation(len(points))]
    far = np.sqrt(((points[:, None] - points) ** 2).sum(2))
    near, n = (far <= 0.9) & ~np.eye(len(points), dtype=bool), len(points)
    core = near.sum(1) + 1 >= 5
    comp = {i: keys[i] for i in np.flatnonzero(core)}
    while (moved := {i: min([comp[i], *(comp[j] for j in np.flatnonzero(near[i] & core))]) for i in comp}) != comp:
        comp = moved
    numbers = {c: k for k, c in enumerate(sorted(set(comp.values())))}
    ends = {i: min((comp[j] for j in np.flatnonzero(near[i] & core)), default=None) for i in range(n) if not core[i]}
    want = {keys[i]: numbers.get(comp.get(i) or ends.get(i), -1) for i in range(n)}
    assert 0 < sum(c is not None for c in ends.values()) and len(numbers) > 1 and -1 in want.values()
    sizes, kept = [], cluster.store.kept
    monkeypatch.setattr(cluster.store, "kept", lambda df, name: (out := kept(df, name), sizes.append(out.count()))[0])
    rows = spark.createDataFrame([(k, p.tolist()) for k, p in zip(keys, points, strict=True)] + [("x", [float("nan")] * 8), (None, [0.0] * 8)], "post_id string, embedding array<double>")
    got = {x.post_id: x.label for x in cluster.dbscan(rows, 0.9, 5).collect()}
    assert got == want | {"x": -1, None: -1} and max(sizes) < 12 * n < near.sum() / 20


@pytest.mark.parametrize("direct", [0, 32_768])
def test_dbscan_compares_rows_once(spark, monkeypatch, direct):
    """One comparison gives cores, links and borders, whether tiles come by place or by hash; labels are those of brute force."""
    r = np.random.default_rng(11)
    points = np.vstack([r.normal(0, 1, (260, 2)), r.normal(5, 0.1, (60, 2)), r.uniform(-4, 8, (80, 2))])
    keys = [f"{i:03d}" for i in r.permutation(len(points))]
    near = np.sqrt(((points[:, None] - points) ** 2).sum(2)) <= 0.3
    np.fill_diagonal(near, False)
    core = near.sum(1) + 1 >= 6
    comp = np.where(core, keys, "~")
    while (moved := [min([comp[i], *comp[near[i] & core]]) if core[i] else "~" for i in range(len(keys))]) != comp.tolist():
        comp = np.array(moved)
    numbers = {c: k for k, c in enumerate(sorted(set(comp[core])))} | {"~": -1}
    want = {k: numbers[comp[i] if core[i] else min(["~", *comp[near[i] & core]])] for i, k in enumerate(keys)}
    assert len(numbers) > 4 and sum(want[k] >= 0 for k in keys) > core.sum()
    monkeypatch.setattr(cluster.tiles, "LEAST", 64)
    monkeypatch.setattr(cluster.tiles, "DIRECT", direct, raising=False)
    calls, compare = [], cluster.tiles.Tiles.compare
    monkeypatch.setattr(cluster.tiles.Tiles, "compare", lambda *a, **k: (calls.append(a), compare(*a, **k))[1])
    rows = spark.createDataFrame([(k, p.tolist()) for k, p in zip(keys, points, strict=True)], "post_id string, embedding array<double>")
    got = {x.post_id: x.label for x in cluster.dbscan(rows, 0.3, 6).collect()}
    assert got == want and len(calls) == 1


@pytest.mark.parametrize("kind", ["float32", "float64"])
def test_within(kind):
    """Rows far from others, at the bound, of very different lengths and beyond what squares can hold."""
    r = np.random.default_rng(2)
    a, b = (r.normal(0, s, (40, 8)).astype(kind) for s in (1, 3))
    a[:3], b[:3] = 0, 0
    b[1, 0], b[2, 0] = 1.5, np.nextafter(np.array(1.5, kind), np.array(2, kind))
    a[3:5], b[3:5] = 2e19, 2e19
    b[5:20] = a[5:20] + r.normal(0, 0.53, (15, 8)).astype(kind)
    want = np.sqrt(((a[:, None].astype(float) - b) ** 2).sum(2)) <= 1.5
    got = cluster.tiles.within(a, b, 1.5)
    assert (got == want).all() and want[0, 1] and not want[0, 2] and want[3, 4]
    assert not cluster.tiles.within(a[5:], b[:5], 1e-3).any()


def test_hdbscan():
    r = np.random.default_rng(0)
    got = cluster.hdbscan_labels(np.vstack([r.normal(0, 0.1, (30, 2)), r.normal(5, 0.1, (40, 2)), [[20, 20]]]))
    assert set(got[:30]) == {0} and set(got[30:70]) == {1} and got[70] == -1
    assert cluster.hdbscan_labels(np.zeros((3, 2))).tolist() == [-1] * 3


@pytest.mark.parametrize("apart", [0, 6])
def test_hdbscan_beyond_one_task(spark, monkeypatch, apart):
    """The spanning tree by tiles has the weight of one made from all distances, and its clusters those of hdbscan_labels."""
    r = np.random.default_rng(7)
    points = np.vstack([r.normal(c * apart, s, (60, 4)) for c, s in ((0, 0.3), (1, 0.6), (2, 0.4))] + [np.tile(r.normal(3, 1, 4), (30, 1))])
    keys = [f"{i:03d}" for i in range(len(points))]
    rows = spark.createDataFrame([(k, p.tolist()) for k, p in zip(keys, points, strict=True)], "post_id string, embedding array<double>")
    monkeypatch.setattr(cluster.tiles, "LEAST", 64)
    far = np.sqrt(((points[:, None] - points) ** 2).sum(2))
    core = np.sort(far, axis=1)[:, 7]
    reach = np.maximum(np.maximum(far, core), core[:, None])
    best, total = reach[0].copy(), 0.0
    left = set(range(1, len(points)))
    while left:
        at = min(left, key=lambda i: best[i])
        total, best = total + best[at], np.minimum(best, reach[at])
        left.remove(at)
    tree = cluster.spanning_tree(rows, 8).collect()
    assert len(tree) == len(points) - 1 and sum(e.w for e in tree) == pytest.approx(total)
    got = {x.post_id: x.label for x in cluster.hdbscan(rows, most=100).collect()}
    assert [got[k] for k in keys] == cluster.hdbscan_labels(points).tolist()


def test_usable_vectors(spark):
    rows = spark.createDataFrame([("a", [1.0, 2.0]), ("b", []), ("c", None), ("d", [1.0]), ("e", [0.0, 0.0])], "post_id string, embedding array<double>")
    assert sorted(r.post_id for r in cluster.usable(rows).collect()) == ["a", "e"]


def test_ctfidf_seams(spark):
    rows = spark.createDataFrame([("t", "1", "red blue"), ("t", "2", "the green"), ("u", "1", "red green blue")], "topic_id string, post_id string, text string")
    terms = lambda **k: {r.term for r in ctfidf.term_scores(rows, ["the"], min_df=1, max_df=1.0, **k).where("topic_id = 't'").collect()}
    assert terms() == {"red", "blue", "green", "red blue", "blue green"} and terms(across_posts=False) == {"red", "blue", "green", "red blue"}


def test_null_report(spark):
    rows = spark.createDataFrame([(None, "", []), ("x", None, None), ("y", "z", [1])], "a string, b string, c array<int>")
    got = {r.field: (r.nulls, r.empty_strings, r.empty_arrays, r.total) for r in quality.null_report(rows, ["a", "b", "c", "d"]).collect()}
    assert got == {"a": (1, 0, 0, 3), "b": (1, 1, 0, 3), "c": (1, 0, 1, 3), "d": (3, 0, 0, 3)}


def test_retries():
    assert labeling.halving([1, 2, 3, 4], lambda x: x if len(x) <= 2 else None) == [1, 2]
    assert labeling.halving([], lambda x: x) is None
    assert sorted(labeling.splitting([1, 2, 3, 4, 5], lambda x: x if len(x) <= 2 else None)) == [1, 2, 3, 4, 5][:2] + [3, 4, 5][:1] + [4, 5]
    assert labeling.splitting([1, 2, 3], lambda x: None) == []


def test_model_audit(spark):
    exported = spark.createDataFrame([("p", "text", [("c1", "yes and"), ("c2", "no")])], "post_id string, post_text string, comments array<struct<comment_id:string,comment_text:string>>")
    requests = labeling.stance_requests(exported, "{{POSTS_JSON}}")
    got, audit = labeling.stance_labels(requests, labeling.rule_model)
    assert {r.comment_id: r.stance for r in got.collect()} == {"c1": "agree", "c2": "disagree"} and audit.count() == 0
    _, audit = labeling.stance_labels(requests, lambda p: "sorry")
    assert [(r.expected, r.received, r.reason) for r in audit.collect()] == [(2, 0, "empty_or_invalid_json")]


def test_long_comments(spark):
    """Comments that fit alone are all asked for, in order, by next fit on count and tokens; only one over budget is not."""
    import json

    comments = [(f"c{i}", "word " * n) for i, n in enumerate([100, 100, 100, 100, 1, 1, 1, 1, 1, 900, 1, 20])]
    exported = spark.createDataFrame([("p", "text", comments), ("q", 'é "x"', [("d", "y")]), ("r", None, [])], "post_id string, post_text string, comments array<struct<comment_id:string,comment_text:string>>")
    requests = labeling.stance_requests(exported, "Label: {{POSTS_JSON}}", budget=160, most_batches=1).collect()
    asked = [json.loads(r.prompt.removeprefix("Label: ")) for r in requests]
    assert sorted([c["comment_id"] for c in e["comments"]] for x in asked for e in x) == [["c0"], ["c1"], ["c10", "c11"], ["c2"], ["c3", "c4"], ["c5", "c6", "c7", "c8"], ["d"]]
    assert all(len(r.prompt) <= 4 * 160 and r.comment_ids == [c["comment_id"] for e in x for c in e["comments"]] for r, x in zip(requests, asked, strict=True))
    tight = [-(-len(r.prompt) // 4) for r in requests if r.comment_ids == ["c0"]][0]
    exact = lambda budget: {c for r in labeling.stance_requests(exported, "Label: {{POSTS_JSON}}", budget=budget, most_comments=1).collect() for c in r.comment_ids}
    assert "c0" in exact(tight) and "c0" not in exact(tight - 1)


def test_ratings(spark):
    rows = spark.createDataFrame([("a", "n", "d", "t"), ("b", "n", "d", "t")], "post_id string, topic_name string, topic_description string, text string")
    reply = lambda p: str([{"post_id": "a", "matches": True, "fit_score": 80}])
    assert [(r.post_id, r.fit_score) for r in labeling.rate(rows, reply).distinct().collect()] == [("a", 80.0)]


def test_runner(spark):
    df = spark.range(3)
    steps = [runner.Step("c", ("b",), lambda b: b.limit(1)), runner.Step("b", ("a",), lambda a: a), runner.Step("bad", ("a",), lambda a: 1 / 0, optional=True)]
    made, failed = runner.run(steps, {"a": df})
    assert made["c"].count() == 1 and list(failed) == ["bad"]
    assert set(runner.run(steps, {"a": df}, dry_run=True)[0]) == {"a"}


def test_standard_steps(spark):
    posts = spark.createDataFrame([(f"{i:02d}", "cats purr" if i % 2 else "dogs bark", "and more of it", True) for i in range(40)], "post_id string, title string, selftext string, is_self boolean").withColumns({"topic_id": F.lit(None).cast("string"), "center_distance": F.lit(None).cast("double")})
    comments = spark.createDataFrame([("00", "c1", "ok", 3, "agree", "positive", 0.5)], "post_id string, comment_id string, comment_text string, upvote_score long, stance_label string, sentiment_label string, llm_confidence double")
    made, failed = runner.run(runner.standard_steps(), {"posts": posts, "comments": comments}, continue_on_error=True)
    assert "topics" in made and made["topics"].where("topic_id is not null").count() == 40 and made["distributions"].count() == 1


def test_runner_catches_what_fails_when_run(spark):
    """A step that fails on its rows counts as failed, and what needs it is left out; others go on."""
    bad = F.udf(lambda x: 1 // 0, "int")
    steps = [runner.Step("one", ("t",), lambda t: t.withColumn("b", F.lit(1))), runner.Step("two", ("one",), lambda t: t.withColumn("c", bad("a"))), runner.Step("three", ("two",), lambda t: t), runner.Step("four", ("one",), lambda t: t.limit(1))]
    made, failed = runner.run(steps, {"t": spark.createDataFrame([(1,), (2,)], "a int")}, continue_on_error=True)
    assert set(made) == {"t", "one", "four"} and set(failed) == {"two"} and made["one"].count() == 2
    with pytest.raises(Exception, match="division"):
        runner.run(steps, {"t": spark.createDataFrame([(1,)], "a int")})
    assert runner.run(steps, {}, dry_run=True) == ({}, {})


def test_answered():
    import time

    calls = []

    def flaky(prompt):
        calls.append(prompt)
        if len(calls) < 3:
            raise OSError("busy")
        return "yes"

    assert labeling.answered(flaky, "p") == ("yes", None) and len(calls) == 3
    assert labeling.answered(lambda p: 1 // 0, "p", tries=2) == ("", "ZeroDivisionError: integer division or modulo by zero")
    reply, error = labeling.answered(lambda p: time.sleep(0.5), "p", tries=1, timeout=0.05)
    assert reply == "" and error.startswith("TimeoutError")


def test_windows_are_encoded_in_batches(spark):
    """Texts of all lengths: vectors are the weighted means of their windows, and the encoder is called for 32 windows at a time."""
    r = np.random.default_rng(11)
    texts = [" ".join(f"w{int(x)}" for x in r.integers(0, 50, n)) for n in [*r.integers(1, 40, 150).tolist(), 300, 800, 95, 96, 94]] + ["", "  ", None]
    rows = spark.createDataFrame(list(enumerate(texts)), "post_id long, text string").coalesce(1)
    calls = spark.sparkContext.accumulator(0)
    most = spark.sparkContext.accumulator(0)
    hashed = cluster.hashing_encoder(16)

    def encode(batch):
        calls.add(1)
        longest = max(len(t.split()) for t in batch)
        assert len(batch) <= 32 and (len(batch) == 1 or longest * len(batch) <= 2000)
        most.add(len(batch))
        return hashed(batch) + 0.01

    got = {x.post_id: x.embedding for x in cluster.embed_texts(rows, encode, max_tokens=98, overlap=10, batch_tokens=2000, held=100).collect()}
    windows = 0
    for i, t in enumerate(texts):
        words = (t or "").split()
        if not words:
            assert i not in got
            continue
        cut = [words] if len(words) <= 96 else [words[a : a + 96] for a in range(0, len(words), 86) if a == 0 or a + 10 < len(words)]
        windows += len(cut)
        mean = np.average(hashed([" ".join(c) for c in cut]) + 0.01, axis=0, weights=[len(c) for c in cut])
        assert got[i] == pytest.approx((mean / np.linalg.norm(mean)).tolist(), abs=1e-9), i
    assert most.value == windows and windows / 32 <= calls.value <= windows / 32 + 12


def test_batches_of_windows():
    sizes = [5, 1, 9, 100, 2, 2, 2, 50]
    got = cluster.batches_of(sizes, 3, 20)
    assert sorted(i for b in got for i in b) == list(range(8)) and all(len(b) <= 3 and (len(b) == 1 or len(b) * max(sizes[i] for i in b) <= 20) for b in got)
    assert cluster.batches_of([], 3, 20) == []


def test_terms_in_pieces(spark, monkeypatch):
    """However few terms a task holds at a time, and of whatever type topics are, scores are the same; by plain counting too."""
    import math

    r = np.random.default_rng(5)
    posts = [(int(i % 4), int(i), " ".join(f"Wort{int(x)} é_{int(x) % 3}" for x in r.integers(0, 30, int(r.integers(0, 40))))) for i in range(60)] + [(None, 99, "nobody"), (2, 100, None)]
    rows = spark.createDataFrame(posts, "topic_id long, post_id long, text string")
    key = lambda df: {(x.topic_id, x.term): (x.n, x.df, round(x.score, 12)) for x in df.collect()}
    want = key(ctfidf.term_scores(rows, ["wort1"]))
    monkeypatch.setattr(ctfidf, "HELD", 5)
    assert key(ctfidf.term_scores(rows.repartition(5), ["wort1"])) == want
    plain: dict = {}
    for t in range(4):
        words = [w for _, _, x in sorted((p for p in posts if p[0] == t), key=lambda p: str(p[1])) for w in (x or "").lower().split() if w != "wort1"]
        for term in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
            plain.setdefault(term, {}).setdefault(t, 0)
            plain[term][t] += 1
    held = {term: c for term, c in plain.items() if 2 <= len(c) <= 0.95 * 4}
    totals = {t: sum(c.get(t, 0) for c in held.values()) for t in range(4)}
    assert want == {(t, term): (n, len(c), round(n / totals[t] * (math.log(5 / (1 + len(c))) + 1), 12)) for term, c in held.items() for t, n in c.items()}


def test_parts_are_asked_again(spark):
    """A model that fails on long prompts: halves down to a depth, or the first half only."""
    import json

    def model(prompt):
        own = json.loads(prompt)
        if len(own) > 2 or "bad" in own:
            return "sorry"
        return json.dumps([{"got": own}])

    rows = spark.createDataFrame([(1, [str(i) for i in range(8)]), (2, ["a", "bad", "b"]), (3, ["x"]), (4, [])], "k long, items array<string>")
    render = lambda own: json.dumps(list(own))
    got = {}
    for r in labeling.ask_parts(rows, model, render).collect():
        got.setdefault(r.k, []).append(r.asked)
    assert {k: sorted(v) for k, v in got.items()} == {1: [["0", "1"], ["2", "3"], ["4", "5"], ["6", "7"]], 2: [["a"], ["b"]], 3: [["x"]], 4: [[]]}
    halved = {r.k: r.asked for r in labeling.ask_parts(rows, model, render, split=False).collect()}
    assert halved == {1: ["0", "1"], 2: ["a"], 3: ["x"]}
    assert labeling.ask_parts(rows, lambda p: 1 // 0, render).count() == 0


def test_topics_by_halves(spark):
    import json

    def model(prompt):
        own = json.loads(prompt)
        return json.dumps([{"topic_name": f"of {len(own)}", "topic_description": own[0]["text"], "confidence": 0.5}]) if len(own) <= 3 else ""

    rows = spark.createDataFrame([(t, i + 1, f"{t}{i}") for t, n in (("a", 9), ("b", 2), ("c", 40)) for i in range(n)], "topic_id string, rank int, text string")
    got = {r.topic_id: (r.topic_name, r.topic_description, r.posts) for r in labeling.label_topic(rows, model, most=10).collect()}
    assert got == {"a": ("of 2", "a0", 2), "b": ("of 2", "b0", 2), "c": ("of 2", "c0", 2)}


def test_stances_by_inference(spark):
    """From raw scores of both hypotheses, as the definition has it, in batches that mix rows."""
    import math

    r = np.random.default_rng(2)
    texts = [("p" * int(r.integers(0, 9)) + "ea" * int(r.integers(0, 9)), "c" + "ae" * int(r.integers(0, 7))) for _ in range(75)] + [(None, "x"), ("", None)]
    rows = spark.createDataFrame([(i, *t, "kept") for i, t in enumerate(texts)], "k long, post_text string, comment_text string, stance_scores_ string")

    def scorer(pairs):
        assert 0 < len(pairs) <= 10 and all(p.startswith("POST: ") and h.startswith("The commenter ") for p, h in pairs)
        return inference.rule_scorer(pairs)

    got = {x.k: x for x in inference.stances(rows, scorer, batch=10).collect()}
    assert len(got) == len(texts)
    for k, (post, comment) in enumerate(texts):
        p = f"POST: {post or ''}\nCOMMENT: {comment or ''}"
        shares = []
        for h in ("The commenter supports the post.", "The commenter opposes the post."):
            raw = [math.exp(x) for x in inference.rule_scorer([(p, h)])[0]]
            shares.append([x / sum(raw) for x in raw])
        (c1, n1, e1), (c2, n2, e2) = shares
        scores = {"FAVOR": max(e1, c2), "AGAINST": max(e2, c1), "NONE": max(n1, n2)}
        best = max(scores, key=scores.get)
        label = best if scores[best] >= 0.55 else "NONE"
        assert got[k].stance_scores.asDict() == pytest.approx(scores) and (got[k].stance, got[k].stance_score) == (label, pytest.approx(scores[label]))
    assert len({x.stance for x in got.values()}) == 3


def test_hash_beyond_the_basic_plane(spark):
    """UTF-16 units, as scripts of a browser count them."""
    from agorascope.functions import text

    def of(s):
        h = 0
        for i in range(0, len(u := s.encode("utf-16-be")), 2):
            h = (h * 31 + int.from_bytes(u[i : i + 2], "big")) & 0xFFFFFFFF
        return abs(h - 2**32 if h >= 2**31 else h)

    texts = ["", "a", "topic_12", "😀 grin", "né🇩🇪", "中文" * 20]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", text.string_hash(F.col("t")).alias("h"))
    assert {x.t: x.h for x in rows.collect()} == {t: of(t) for t in texts}


def test_stop_words_have_no_limit(spark):
    more = spark.range(20_500).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("word"))
    assert {f"w{i}" for i in range(20_500)} <= set(ctfidf.stop_words(spark, more))


@pytest.mark.parametrize("parts", [1, 7])
def test_ctfidf_seams(spark, parts):
    """Bigrams across posts, however the posts are dealt."""
    posts = [(f"t{i % 3}", f"{i:03d}", f"w{i} common" if i % 5 else "") for i in range(40)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        got = {(r.topic_id, r.term): r.n for r in ctfidf.term_scores(spark.createDataFrame(posts, "topic_id string, post_id string, text string"), [], min_df=1, max_df=1.0).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    want: dict = {}
    for t in ("t0", "t1", "t2"):
        words = " ".join(x for topic, _, x in sorted(posts, key=lambda p: p[1]) if topic == t).split()
        for term in words + [f"{a} {b}" for a, b in zip(words, words[1:])]:
            want[t, term] = want.get((t, term), 0) + 1
    # One-letter words are no terms; here all have two letters at least.
    assert got == want


def test_settings(tmp_path):
    from agorascope import config

    path = tmp_path / "s.json"
    path.write_text('{"embedding": {"batch": 7}, "key": "from file"}')
    assert config.load(str(path))["embedding"] == {"batch": 7, "max_tokens": 512, "overlap": 50} and config.load(str(tmp_path / "none.json")) == config.DEFAULTS
    with pytest.raises(FileNotFoundError):
        config.load(str(tmp_path / "none.json"), required=True)
    assert config.credential({"a": {"key": "x"}}, ("a", "key"), "SOME_KEY", {}) == "x" and config.credential({"a": {"key": "x"}}, ("a", "key"), "SOME_KEY", {"SOME_KEY": "env"}) == "env" and config.credential({}, ("a",), "SOME_KEY", {}) is None


def test_label_files(spark, tmp_path):
    from agorascope.sources import files, schema

    assert [files.posts_path(p) for p in ("a/topic_label_chunks.csv", "x_chunk.csv", "s3a://b/c/other.csv", "plain")] == ["a/topic_label_posts.csv", "x_posts.csv", "s3a://b/c/other_posts.csv", "plain_posts"]
    chunks = spark.createDataFrame([("t", 1, 2, 1, 1, 9, 9, ["a", "b c"])], "topic_id string, chunk_id int, post_count int, near_count int, far_count int, token_estimate int, cluster_token_sum int, terms array<string>")
    files.write_chunks(chunks, f"file://{tmp_path}/c.csv")
    assert [(r.topic_id, r.chunk_id, r.ctfidf_terms) for r in files.read_chunks(spark, f"file://{tmp_path}/c.csv").collect()] == [("t", 1, "a|b c")]
    posts = spark.createDataFrame([("t", 1, 0, "NEAR", "p", 0.5, 'two\nlines, "quoted"')], "topic_id string, chunk_id int, post_index int, tag string, post_id string, distance double, text string")
    files.write_chunk_posts(posts, f"file://{tmp_path}/p.csv")
    back = files.read_chunk_posts(spark, f"file://{tmp_path}/p.csv").first()
    assert (back.posts[0].distance, back.posts[0].text) == ("0.500000", 'two\nlines, "quoted"')
    names = [c.split()[0] for c in schema.RESULTS_CSV.split(", ")]
    rows = spark.createDataFrame([tuple(str(i) for i in range(len(names)))], names)
    files.write_results(rows, f"file://{tmp_path}/r.csv")
    files.write_results(rows, f"file://{tmp_path}/r.csv", append=True)
    assert files.read_results(spark, f"file://{tmp_path}/r.csv").count() == 2


def test_landed_tables_join_without_shuffle(spark):
    """Posts and comments are bucketed alike, so grouping and joining them by post needs no exchange but the last."""
    from agorascope.sources import tables

    d = "/root/testdata/sf0.001"
    posts, comments = tables.posts(spark, d), tables.weighted_comments(spark, d)
    both = comments.groupBy("post_id").agg(F.sum("weight").alias("w")).join(posts.hint("merge"), "post_id")
    plan = both._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and posts.count() == 1500 and tables.posts(spark, d).count() == 1500
