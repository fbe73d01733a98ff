"""UMAP: a layout that keeps neighbourhoods, fitted to a bounded sample and applied to every row.

The method is that of McInnes, Healy and Melville (2018). Memory and the driver's work follow `sample`, a documented
bound; all other rows are placed on the workers by their nearest rows of the sample.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Rows compared with the sample at a time.
BLOCK = 1_000


def unit(points: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(points, axis=1, keepdims=True)
    return points / np.where(length > 0, length, 1)


def nearest(points: np.ndarray, sample: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in the sample and distances of the k nearest by cosine, nearest first; both sides of unit length."""
    at, far = [], []
    for i in range(0, len(points), BLOCK):
        d = np.maximum(1 - points[i : i + BLOCK] @ sample.T, 0)
        d[d < 1e-12] = 0
        near = np.argpartition(d, k - 1, axis=1)[:, :k]
        own = np.take_along_axis(d, near, 1)
        order = np.lexsort((near, own), axis=1)
        at.append(np.take_along_axis(near, order, 1))
        far.append(np.take_along_axis(own, order, 1))
    return np.concatenate(at), np.concatenate(far)


def memberships(far: np.ndarray) -> np.ndarray:
    """Fuzzy weights of neighbours: 1 up to the nearest of another place, and log2(k) in all."""
    rho = np.where((far > 0).any(1), np.where(far > 0, far, np.inf).min(1), 0)[:, None]
    over, want = np.maximum(far - rho, 0), np.log2(far.shape[1])
    low, high, sigma = np.zeros(len(far)), np.full(len(far), np.inf), np.ones(len(far))
    for _ in range(64):
        more = np.exp(-over / sigma[:, None]).sum(1) > want
        high, low = np.where(more, sigma, high), np.where(more, low, sigma)
        sigma = np.where(np.isinf(high), sigma * 2, (low + high) / 2)
    floor = 1e-3 * far.mean(1) + 1e-12
    return np.exp(-over / np.maximum(sigma, floor)[:, None])


def curve(min_dist: float) -> tuple[float, float]:
    """a, b of 1 / (1 + a x^2b), closest to 1 up to min_dist and an exponential beyond: least squares by shrinking grids."""
    x = np.linspace(0, 3, 300)[1:]
    want = np.where(x < min_dist, 1, np.exp(-(x - min_dist)))
    a, b, reach = 1.5, 1.0, 0.9
    for _ in range(12):
        grid = [(a * (1 + u * reach), b * (1 + v * reach)) for u in np.linspace(-1, 1, 13) for v in np.linspace(-1, 1, 13)]
        a, b = min(grid, key=lambda g: float(((1 / (1 + g[0] * x ** (2 * g[1])) - want) ** 2).sum()))
        reach *= 0.5
    return a, b


def fit(points: np.ndarray, k: int, neighbours: int, min_dist: float, epochs: int, seed: int) -> np.ndarray:
    """Coordinates of unit vectors: attraction along a graph of neighbours against random repulsion, from principal axes."""
    n, rng = len(points), np.random.Generator(np.random.PCG64(seed))
    at, far = nearest(points, points, min(neighbours + 1, n))
    # A row is no neighbour of its own, and stands anywhere among those at distance 0.
    others = at != np.arange(n)[:, None]
    others[others.all(1), -1] = False
    at, far = at[others].reshape(n, -1), far[others].reshape(n, -1)
    weight = memberships(far)
    head, tail = np.repeat(np.arange(n), at.shape[1]), at.ravel()
    key, place = np.unique(np.concatenate([head * n + tail, tail * n + head]), return_inverse=True)
    there = np.bincount(place[: len(tail)], weight.ravel(), len(key))
    back = np.bincount(place[len(tail) :], weight.ravel(), len(key))
    w = there + back - there * back
    head, tail = key // n, key % n
    centred = points - points.mean(0)
    axes = np.linalg.svd(centred, full_matrices=False)[2][:k]
    y = centred @ axes.T
    y = np.hstack([y, np.zeros((n, k - y.shape[1]))]) * (10 / max(1e-9, np.abs(y).max())) + rng.normal(0, 1e-2, (n, k))
    a, b = curve(min_dist)
    every = w.max() / np.maximum(w, 1e-9)
    due = every.copy()
    for epoch in range(1, epochs + 1):
        now = np.flatnonzero(due <= epoch)
        due[now] += every[now]
        i, j = head[now], tail[now]
        apart = y[i] - y[j]
        sq = (apart**2).sum(1)
        pull = np.where(sq > 0, -2 * a * b * sq ** np.where(sq > 0, b - 1, 1) / (1 + a * sq**b), 0)
        step = np.clip(pull[:, None] * apart, -4, 4)
        who = np.repeat(i, 5)
        random = rng.integers(0, n, len(who))
        apart = y[who] - y[random]
        sq = (apart**2).sum(1)
        push = np.where(who != random, 2 * b / ((0.001 + sq) * (1 + a * sq**b)), 0)
        shove = np.clip(push[:, None] * apart, -4, 4)
        rate = 1 - (epoch - 1) / epochs
        index = np.concatenate([i, j, who])
        for c in range(k):
            y[:, c] += rate * np.bincount(index, np.concatenate([step[:, c], -step[:, c], shove[:, c]]), n)
    return y


def umap(rows: DataFrame, k: int = 2, key: str = "post_id", vector: str = "embedding", out: str = "projected", neighbours: int = 15, min_dist: float = 0.1, epochs: int = 200, seed: int = 42, sample: int = 4_000) -> DataFrame:
    """Adds k coordinates by cosine neighbourhoods. Vectors are of one length (see cluster.usable).

    Fitted to the `sample` rows of smallest key hash, whose coordinates are those fitted; any other row is the mean of
    its nearest ones there, weighted as neighbours. One row, or none, has nothing to lay out and gives zeros; equal
    vectors of the sample keep their own places, and a row equal to one of them takes the first. The same rows give
    the same coordinates, but for the last digits of rows outside the sample, which follow the batches they come in."""
    bare = rows.select(F.col(key).cast("string").alias("k"), F.transform(vector, lambda x: x.cast("double")).alias("v"))
    held = bare.orderBy(F.xxhash64("k", F.lit(seed)), "k").limit(sample).collect()
    if len(held) <= 1:
        return rows.withColumn(out, F.array_repeat(F.lit(0.0), k))
    points = unit(np.array([r["v"] for r in held]))
    count = max(2, min(neighbours, len(held) - 1))
    placed = fit(points, k, count, min_dist, epochs, seed)
    model = rows.sparkSession.sparkContext.broadcast((points, placed, {r["k"]: i for i, r in enumerate(held)}))
    schema = rows.withColumn(out, F.array(F.lit(0.0)).cast("array<double>")).schema

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        points, placed, fitted = model.value
        for frame in frames:
            if frame.empty:
                continue
            own = unit(np.stack(frame[vector].to_numpy()).astype(float))
            at, far = nearest(own, points, min(count, len(points)))
            w = memberships(far)
            y = (w[:, :, None] * placed[at]).sum(1) / w.sum(1)[:, None]
            same = far[:, 0] == 0
            y[same] = placed[at[same, 0]]
            where = np.array([fitted.get(str(x), -1) for x in frame[key]])
            y[where >= 0] = placed[where[where >= 0]]
            yield frame.assign(**{out: list(y)})

    return rows.mapInPandas(run, schema)
