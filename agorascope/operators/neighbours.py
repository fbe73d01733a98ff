"""Nearest neighbours: a search of queries by inverted lists, and a graph of all rows by these and rounds of NN-descent.

A list is what lies nearest to one of about sqrt(n) rows drawn by a hash of their keys; these centres, LISTS at most, are all that is
collected and broadcast. Each row is a member of its nearest list and asks the `probes` lists nearest to it. Lists are cut
into tiles of about TILE members and TILE questions, so a dense region is many tasks and no task holds all vectors, and from each
tile come k rows per question at most. Probing all lists gives exact results at the price of all comparisons.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.operators.cluster import usable
from agorascope.operators.ranks import first_rows
from agorascope.sources import store

LISTS, TILE = 65_536, 4096
#: Lists that a row asks by default.
PROBES = 16


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0.0)


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float)


def _lists(rows: DataFrame, centres, probes: int) -> DataFrame:
    """(list, key, v, nearest): the lists of each row, the nearest first."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 1024):
                some = frame.iloc[at : at + 1024]
                far = squared(_matrix(some["v"]), centres.value)
                near = np.argsort(far, axis=1, kind="stable")[:, :probes]
                own = some.loc[some.index.repeat(near.shape[1])]
                yield own.assign(list=near.ravel().astype("int32"), nearest=np.tile(np.arange(near.shape[1]) == 0, len(some)))

    return rows.mapInPandas(run, "key string, v array<double>, list int, nearest boolean")


def search(queries: DataFrame, rows: DataFrame, k: int = 15, key: str = "post_id", vector: str = "embedding", probes: int | None = PROBES, lists: int | None = None, seed: int = 7, itself: bool = True) -> DataFrame:
    """key, rank, neighbour, distance: of each query the k nearest rows that its lists hold, ties by key.

    probes: None asks all lists. Vectors that are missing, or of another length than most-first ones (cluster.usable), are left
    out; without itself a row of the query's key does not count. Keys are unique."""
    spark = rows.sparkSession
    slim = lambda df: usable(df.select(F.col(key).cast("string").alias("key"), F.col(vector).cast("array<double>").alias("v")), "key", "v")
    rows = store.kept(slim(rows), "vectors")
    n = rows.count()
    if not n:
        return spark.createDataFrame([], "key string, rank int, neighbour string, distance double").withColumnRenamed("key", key)
    lists = min(LISTS, n, lists or math.ceil(math.sqrt(n)))
    drawn = rows.orderBy(F.xxhash64(F.lit(seed), "key"), "key").limit(lists).collect()
    centres = spark.sparkContext.broadcast(np.array([r["v"] for r in drawn], float))
    dim = centres.value.shape[1]
    members = store.kept(_lists(rows, centres, 1).drop("nearest"), "members")
    asked = store.kept(_lists(slim(queries).where(F.size("v") == dim), centres, lists if probes is None else min(probes, lists)).drop("nearest"), "asked")

    # A row per list, LISTS at most: how many tiles its members and its questions make.
    count = lambda df, name: df.groupBy("list").agg(F.ceil(F.count("*") / TILE).cast("int").alias(name))
    tiles = F.broadcast(store.kept(count(members, "m_").join(count(asked, "q_"), "list"), "tiles"))
    dealt = lambda df, own, other: df.join(tiles, "list").withColumns({own: F.pmod(F.xxhash64(F.lit(own), "key"), F.col(f"{own}_")).cast("int"), other: F.explode(F.sequence(F.lit(0), F.col(f"{other}_") - 1))}).select("list", "m", "q", "key", "v")

    def compare(held: pd.DataFrame, questions: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(held) and len(questions):
            held = held.sort_values("key", kind="stable")
            keys, x = held["key"].to_numpy(), _matrix(held["v"])
            for at in range(0, len(questions), 256):
                some = questions.iloc[at : at + 256]
                q = _matrix(some["v"])
                far = squared(q, x)
                for i, own in enumerate(some["key"]):
                    best = np.argpartition(far[i], k + 1)[: k + 2] if len(keys) > k + 2 else np.arange(len(keys))
                    # Distances anew for the few, as the fast form loses digits; what ties with the last may be beyond the cut.
                    best = np.flatnonzero(far[i] <= far[i][best].max() + 1e-9)
                    exact = np.sqrt(((x[best] - q[i]) ** 2).sum(1))
                    some_keys = [(d, keys[j]) for d, j in zip(exact.tolist(), best.tolist(), strict=True) if itself or keys[j] != own]
                    out += [(own, other, d) for d, other in sorted(some_keys)[:k]]
        return pd.DataFrame(out, columns=["key", "neighbour", "distance"])

    cells = ["list", "m", "q"]
    found = dealt(members, "m", "q").groupBy(*cells).cogroup(dealt(asked, "q", "m").groupBy(*cells)).applyInPandas(compare, "key string, neighbour string, distance double")
    best = first_rows(found, ["key"], k, "distance", "neighbour", rank="rank")
    return best.select(F.col("key").alias(key), "rank", "neighbour", "distance")


def _around(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Over rows (pivot, key, v, bar) sorted by pivot: pairs of rows of one pivot that are nearer than what either holds."""
    held: list[pd.DataFrame] = []

    def pairs(some: pd.DataFrame) -> pd.DataFrame:
        x, bar, keys = _matrix(some["v"]), some["bar"].to_numpy(), some["key"].to_numpy()
        cuts = np.append(np.flatnonzero(np.append(True, some["pivot"].to_numpy()[1:] != some["pivot"].to_numpy()[:-1])), len(some))
        out: list[tuple] = []
        for at, end in zip(cuts[:-1], cuts[1:], strict=True):
            far = np.sqrt(squared(x[at:end], x[at:end]))
            i, j = np.nonzero((far < bar[at:end, None]) & ~np.eye(end - at, dtype=bool))
            i, j = i + at, j + at
            out.append((keys[i], keys[j], np.sqrt(((x[i] - x[j]) ** 2).sum(1))))
        cols = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pd.DataFrame(dict(zip(("key", "neighbour", "distance"), cols, strict=True)))

    for frame in frames:
        held.append(frame)
        whole = pd.concat(held)
        # The last pivot may go on in the next frame.
        cut = int(np.flatnonzero(whole["pivot"].to_numpy() == whole["pivot"].iloc[-1])[0]) if len(whole) else 0
        if cut:
            yield pairs(whole.iloc[:cut])
        held = [whole.iloc[cut:]]
    if held and len(held[0]):
        yield pairs(held[0])


def _descended(found: DataFrame, vectors: DataFrame, width: int) -> DataFrame:
    """A round of NN-descent: what is near to one row is compared with each other, 2 * width rows and itself at most."""
    bars = found.groupBy("key").agg(F.when(F.count("*") >= width, F.max("distance")).otherwise(F.lit(float("inf"))).alias("bar"))
    ahead = found.select(F.col("key").alias("pivot"), F.col("neighbour").alias("key"))
    back = found.select(F.col("neighbour").alias("pivot"), "key")
    back = first_rows(back, ["pivot"], width, F.xxhash64("pivot", "key"), "key").drop("n_")
    around = ahead.unionByName(back).unionByName(vectors.select(F.col("key").alias("pivot"), "key")).distinct()
    rows = around.join(vectors, "key").join(bars, "key", "left").select("pivot", "key", "v", F.coalesce("bar", F.lit(float("inf"))).alias("bar"))
    more = rows.repartition("pivot").sortWithinPartitions("pivot").mapInPandas(_around, "key string, neighbour string, distance double")
    best = found.select("key", "neighbour", "distance").unionByName(more).groupBy("key", "neighbour").agg(F.min("distance").alias("distance"))
    return store.kept(first_rows(best, ["key"], width, "distance", "neighbour", rank="rank"), "descent")


def graph(rows: DataFrame, k: int = 15, key: str = "post_id", vector: str = "embedding", probes: int | None = 8, rounds: int = 3, width: int | None = None, **options) -> DataFrame:
    """The k nearest other rows of each row.

    A first graph of `width` neighbours (10 more than k) from inverted lists, then rounds of NN-descent: the neighbours of a row, and
    those that it is a neighbour of, meet and keep what is nearer than what they have. Work and rows grow with the number of
    vectors times width squared, whatever the lists. probes=None is exact and needs no rounds."""
    if probes is None:
        return search(rows, rows, k, key, vector, None, itself=False, **options)
    width = width or k + 10
    found = store.kept(search(rows, rows, width, key, vector, probes, itself=False, **options).withColumnRenamed(key, "key"), "graph")
    vectors = store.kept(usable(rows.select(F.col(key).cast("string").alias("key"), F.col(vector).cast("array<double>").alias("v")), "key", "v"), "vectors")
    for _ in range(rounds):
        found = _descended(found, vectors, width)
    return found.where(F.col("rank") <= k).select(F.col("key").alias(key), "rank", "neighbour", "distance")


def recall(found: DataFrame, exact: DataFrame, key: str = "post_id") -> float:
    """The share of exact neighbours that were found, of the keys in `exact`."""
    hit = exact.select(key, "neighbour").join(found.select(key, "neighbour").withColumn("hit_", F.lit(1)), [key, "neighbour"], "left")
    return float(hit.agg(F.count("hit_") / F.count("*")).first()[0] or 0.0)
