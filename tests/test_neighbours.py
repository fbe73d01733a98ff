"""Neighbours by inverted lists against all distances."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from agorascope import catalog
from agorascope.operators import neighbours
from agorascope.sources import tables


def brute(points, keys, queries, k, itself=False):
    out = {}
    for q, key in queries:
        far = sorted((float(np.sqrt(((p - q) ** 2).sum())), other) for p, other in zip(points, keys, strict=True) if itself or other != key)
        out[key] = far[:k]
    return out


@pytest.mark.parametrize("tile", [4096, 20])
def test_all_lists_are_exact(spark, monkeypatch, tile):
    """Ties, a dense region cut into many tiles, vectors that are missing or of another length."""
    monkeypatch.setattr(neighbours, "TILE", tile)
    r = np.random.default_rng(3)
    points = np.vstack([r.normal(0, 1, (60, 4)), np.repeat(r.normal(5, 0.001, (1, 4)), 90, 0), r.normal(5, 0.01, (50, 4))]).round(3)
    keys = [f"k{i:03d}" for i in range(200)]
    rows = spark.createDataFrame([*zip(keys, points.tolist(), strict=True), ("z1", None), ("z2", []), ("z3", [1.0])], "post_id string, embedding array<double>").repartition(5)
    got: dict = {}
    for x in neighbours.graph(rows, 7, probes=None).orderBy("post_id", "rank").collect():
        got.setdefault(x.post_id, []).append((x.distance, x.neighbour))
    want = brute(points, keys, zip(points, keys, strict=True), 7)
    assert got.keys() == want.keys() and all([n for _, n in got[i]] == [n for _, n in want[i]] and [d for d, _ in got[i]] == pytest.approx([d for d, _ in want[i]]) for i in want)


def test_few_rows(spark):
    rows = spark.createDataFrame([("a", [1.0]), ("b", [3.0])], "post_id string, embedding array<double>")
    assert [tuple(x) for x in neighbours.graph(rows).orderBy("post_id").collect()] == [("a", 1, "b", 2.0), ("b", 1, "a", 2.0)]
    assert [tuple(x) for x in neighbours.search(rows.limit(1), rows, 1).collect()] == [("a", 1, "a", 0.0)]
    assert neighbours.graph(rows.limit(0)).count() == 0 and neighbours.graph(rows.limit(1)).count() == 0


def test_recall(spark):
    """At least 0.95 of the 15 nearest of every vector, on the table and on groups of very unequal size."""
    rows = tables.vectors(spark, "/root/testdata/sf0.1")
    found, exact = catalog.QUERIES["nearest_graph"](spark, "/root/testdata/sf0.1"), neighbours.graph(rows, probes=None)
    assert found.count() == 15 * rows.count() and neighbours.recall(found, exact) >= 0.95
    r = np.random.default_rng(4)
    points = np.vstack([r.normal(r.normal(0, 3, 8), 0.5, (n, 8)) for n in (900, 300, 100, 50, 20, 10)])
    rows = spark.createDataFrame([(f"{i:04d}", p.tolist()) for i, p in enumerate(points)], "post_id string, embedding array<double>")
    assert neighbours.recall(neighbours.graph(rows), neighbours.graph(rows, probes=None)) >= 0.95


def test_no_task_holds_all(spark, monkeypatch):
    """Tiles of a list with nearly all rows are as small as others'."""
    monkeypatch.setattr(neighbours, "TILE", 50)
    r = np.random.default_rng(5)
    points = np.vstack([r.normal(0, 0.001, (400, 3)), r.normal(9, 1, (30, 3))])
    rows = spark.createDataFrame([(f"{i:04d}", p.tolist()) for i, p in enumerate(points)], "post_id string, embedding array<double>")
    got = neighbours.graph(rows, 3, probes=None, lists=4)
    plan = got._jdf.queryExecution().toString()
    assert "FlatMapCoGroupsInPandas" in plan and "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert got.groupBy("post_id").count().where(F.col("count") != 3).count() == 0 and got.select("post_id").distinct().count() == 430
