"""Every query with a SQL twin against DuckDB on the smallest tables."""

import glob
import os

import duckdb
import pytest

from agorascope import catalog

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for f in glob.glob(f"{SMALL}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def norm(v):
    return round(v, 6) + 0.0 if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(catalog.ORACLES))
def test_matches_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SMALL)
    cursor = duck.execute(catalog.ORACLES[name])
    rows, names = cursor.fetchall(), [d[0] for d in cursor.description]
    keys = sorted(df.columns)
    assert keys == sorted(names)
    want = sorted((tuple(norm(r[names.index(k)]) for k in keys) for r in rows), key=repr)
    assert sorted((tuple(norm(r[k]) for k in keys) for r in df.collect()), key=repr) == want


def test_top_comments_that_begin_like_bots(spark, tmp_path):
    """Words such as "bota" begin no comment of a bot; empty and missing turns are left out as by the SQL."""
    texts = ["Bota ciónasciado", "a", "b", None, "", "c", "d", "x", "bot", "  **bottles"]
    rows = [(k // 5, k % 5, "user", t) for k, t in enumerate(texts)] + [(2, 0, "user", "Botte"), (2, 1, "user", "e"), (2, 2, "user", "")]
    spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    with duckdb.connect() as con:
        con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
        want = sorted(con.execute(catalog.ORACLES["top_comments"]).fetchall())
    got = catalog.QUERIES["top_comments"](spark, str(tmp_path)).collect()
    assert sorted((r.conv_id, r.turn) for r in got) == want and (0, 0) in want and (1, 3) in want


def test_without_sql(spark):
    """What SQL cannot express is held against what it must be."""
    import json

    import numpy as np

    rows = lambda name: catalog.QUERIES[name](spark, SMALL).collect()
    assert set(catalog.QUERIES) - set(catalog.ORACLES) == {"q13_snapshot", "random_rows", "hdbscan_clusters", "projected_vectors", "umap_vectors", "embedded_texts", "nearest_graph"}
    snapshot = {r["name"]: (r["rows"], json.loads(r["document"])) for r in rows("q13_snapshot")}
    assert len(snapshot) == 13 and all(n == len(d) for n, d in snapshot.values())
    posts = catalog.QUERIES["q6_opinion_map_posts_all"](spark, SMALL).collect()
    assert {p["id"] for p in snapshot["opinion_map"][1]} == {p["id"] for p in posts}
    some = {(r.post_id, r.score) for r in rows("random_rows")}
    every = {(str(r.o_orderkey), int(r.o_totalprice // 1000)) for r in spark.read.parquet(f"{SMALL}/orders.parquet").collect()}
    assert len(some) == 100 and some <= every and some == {(r.post_id, r.score) for r in rows("random_rows")}
    vectors = {str(r.vec_id): r.embedding for r in spark.read.parquet(f"{SMALL}/embeddings.parquet").collect()}
    found = {r.post_id: r.label for r in rows("hdbscan_clusters")}
    assert set(found) == set(vectors) and min(found.values()) >= -1
    keys = sorted(vectors)
    x = np.array([vectors[k] for k in keys], float)
    _, _, axes = np.linalg.svd(x - x.mean(0), full_matrices=False)
    want = dict(zip(keys, np.abs(x @ axes[:2].T).round(4).tolist(), strict=True))
    assert all([r.x, r.y] == pytest.approx(want[r.post_id], abs=2e-3) for r in rows("projected_vectors"))
    placed = {r.post_id: (r.x, r.y) for r in rows("umap_vectors")}
    assert set(placed) == set(vectors) and np.isfinite(list(placed.values())).all()
    texts = {str(r.doc_id): r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}
    embedded = rows("embedded_texts")
    assert {r.post_id for r in embedded} == {k for k, t in texts.items() if (t or "").split()} and all(r["size"] == 16 and r.norm in (0.0, 1.0) for r in embedded)


def test_marginals_are_row_sums(spark):
    matrix = {(r.stance, r.sentiment): r["count"] for r in catalog.QUERIES["q2_stance_sentiment_all"](spark, SMALL).collect()}
    for r in catalog.QUERIES["q2_marginals_all"](spark, SMALL).collect():
        i = 0 if r.side == "stance" else 1
        assert r["count"] == sum(n for k, n in matrix.items() if k[i] == r.label)


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
