"""Vectors in tiles: all rows against all others in blocks, by tasks that hold two tiles each.

Rows go to the nearest of some rows drawn by a hash of their keys; these centres, CENTRES at most, are put in an order in which
neighbours follow each other, and runs of them make tiles of about TILE rows (a centre with more rows makes several). So tiles
have bounds in space, and pairs of tiles that are too far apart are left out; what is left is compared by matrix products.
Tables of up to DIRECT rows go without centres.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from agorascope.sources import store

CENTRES, TILE, LEAST, BLOCK = 1024, 8192, 512, 256
#: Up to so many rows are dealt by a hash, as comparing all of them takes less time than finding their places.
DIRECT = 4 * TILE
#: Tasks for pairs of tiles at most; more pairs share them.
TASKS = 20_000


def finite(vector: str | Column) -> Column:
    """Whether all components are there and finite."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of a to all of b, but for rounding."""
    far = a @ b.T
    far *= -2
    far += (a * a).sum(1)[:, None]
    far += (b * b).sum(1)
    return far


def within(a: np.ndarray, b: np.ndarray, eps: float) -> np.ndarray:
    """Which rows of a lie within eps of which of b: components are summed up in their order wherever rounding might matter."""
    with np.errstate(over="ignore", invalid="ignore"):
        own, other = (a * a).sum(1)[:, None], (b * b).sum(1)
        slack = 8 * (a.shape[1] + 8) * float(np.finfo(a.dtype).eps) * (float(own.max()) + float(other.max()) + eps * eps)
        far = a @ b.T
        # Most blocks end here: no product is large enough even for the shortest rows.
        near = far < (float(own.min()) + float(other.min()) - eps * eps - slack) / 2
        if near.all():
            return ~near
        far *= -2
        far += own
        far += other
        near = far <= eps * eps - slack
        i, j = np.divmod(np.flatnonzero(~(near | (far > eps * eps + slack))), near.shape[1])
    for at in range(0, len(i), 1 << 18):
        p, q = i[at : at + (1 << 18)], j[at : at + (1 << 18)]
        total = np.zeros(len(p))
        for k in range(a.shape[1]):
            gap = a[p, k].astype(float) - b[q, k]
            total += gap * gap
        near[p, q] = np.sqrt(total) <= eps
    return near


def _in_order(centres: np.ndarray) -> list[int]:
    """Places of centres, halved again and again along the direction in which they spread most."""
    out, stack = [], [np.arange(len(centres))]
    while stack:
        own = stack.pop()
        if len(own) < 3:
            out += own.tolist()
            continue
        own = own[np.argsort(centres[own, centres[own].var(0).argmax()], kind="stable")]
        stack += [own[len(own) // 2 :], own[: len(own) // 2]]
    return out


class Tiles:
    """rows(tile, key); tiles(tile, keys, x): the same, packed; bounds: centre and radius by tile."""

    def __init__(self, rows: DataFrame, key: str, vector: str, most: int | None = None):
        single = rows.select(F.element_at(vector, 1)).schema[0].dataType != DoubleType()
        held = rows.where(F.col(key).isNotNull() & finite(vector)).select(F.col(key).cast("string").alias("key"), F.col(vector).cast("array<double>").alias("v"))
        self.spark, held = rows.sparkSession, store.kept(held, "vectors")
        self.count = n = held.count()
        most = most or min(TILE, max(LEAST, n // 8))
        rows = self._by_place(held, most) if n > DIRECT else held.withColumn("tile", F.pmod(F.xxhash64(F.lit("tile"), "key"), F.lit(max(1, -(-n // most)))))
        self.kind = np.dtype("float32" if single else "float64")
        kind = self.kind

        def pack(frame: pd.DataFrame) -> pd.DataFrame:
            frame = frame.sort_values("key", kind="stable")
            x = np.stack(frame["v"].to_numpy())
            centre = x.mean(0)
            return pd.DataFrame({"tile": frame["tile"].iloc[:1].to_numpy(), "keys": [frame["key"].tolist()], "x": [x.astype(kind).tobytes()], "centre": [centre], "radius": [np.sqrt(((x - centre) ** 2).sum(1).max())]})

        packed = store.kept(rows.groupBy("tile").applyInPandas(pack, "tile long, keys array<string>, x binary, centre array<double>, radius double"), "tiles")
        self.tiles = packed.select("tile", "keys", "x")
        self.rows = packed.select("tile", F.explode("keys").alias("key"))
        self.bounds = {r["tile"]: (np.array(r["centre"]), r["radius"]) for r in packed.select("tile", "centre", "radius").collect()}

    def _by_place(self, held: DataFrame, most: int) -> DataFrame:
        """tile, key, v: tiles of rows that lie together."""
        drawn = held.orderBy(F.xxhash64("key"), "key").limit(min(CENTRES, max(1, math.isqrt(self.count)))).collect()
        points = np.array([r["v"] for r in drawn], float).reshape(len(drawn), -1)
        centres = self.spark.sparkContext.broadcast(points[_in_order(points)])

        def nearest(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for at in range(0, len(frame), 1024):
                    some = frame.iloc[at : at + 1024]
                    yield some.assign(list=squared(np.stack(some["v"].to_numpy()), centres.value).argmin(1))

        listed = store.kept(held.mapInPandas(nearest, "key string, v array<double>, list long"), "lists")
        # A row per centre comes to the driver.
        plan, tile, filled = [], 0, 0
        for own, size in sorted(map(tuple, listed.groupBy("list").count().collect())):
            parts = -(-size // most)
            if filled and filled + size > most:
                tile, filled = tile + 1, 0
            plan.append((own, tile, parts))
            tile, filled = (tile + parts, 0) if parts > 1 else (tile, filled + size)
        plan = F.broadcast(self.spark.createDataFrame(plan, "list long, first long, parts long"))
        return listed.join(plan, "list").select((F.col("first") + F.pmod(F.xxhash64(F.lit("tile"), "key"), "parts")).alias("tile"), "key", "v")

    def near(self, eps: float) -> list[tuple[int, int]]:
        """Pairs of tiles (a <= b) that may hold rows within eps."""
        at = sorted(self.bounds)
        centres, radii = np.array([self.bounds[t][0] for t in at]), np.array([self.bounds[t][1] for t in at])
        out = []
        for i, t in enumerate(at):
            gap = np.sqrt(((centres[i:] - centres[i]) ** 2).sum(1)) - radii[i:] - radii[i]
            out += [(t, at[i + j]) for j in np.flatnonzero(~(gap > eps + 1e-9 * (1 + eps + np.abs(gap)))).tolist()]
        return out

    def compare(self, pairs: DataFrame, pairs_count: int, work: Callable[..., Iterator[tuple]], schema: str, more: DataFrame | None = None) -> DataFrame:
        """What work(a, b) gives for pairs(a, b), a and b being dicts of tile, keys, x and the columns of `more` by tile."""
        kind = self.kind
        held = self.tiles if more is None else self.tiles.join(more, "tile", "left")
        names = held.columns
        left, right = (held.select(*[F.col(c).alias(f"{side}_{c}") for c in names]) for side in "ab")
        both = left.join(F.broadcast(pairs), F.col("a") == F.col("a_tile")).join(right, F.col("b") == F.col("b_tile"))
        out_names = [c.split()[0] for c in schema.split(", ")]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                for i in range(batch.num_rows):
                    sides = []
                    for side in "ab":
                        own = {c: batch.column(f"{side}_{c}")[i] for c in names}
                        own = {c: v.as_buffer() if c == "x" else v.values.to_numpy(zero_copy_only=False) if isinstance(v, pa.ListScalar) and v.is_valid else v.as_py() for c, v in own.items()}
                        own["x"] = np.frombuffer(own["x"], kind).reshape(len(own["keys"]), -1)
                        sides.append(own)
                    for cols in work(*sides):
                        if len(cols[-1]):
                            yield pa.RecordBatch.from_pandas(pd.DataFrame(dict(zip(out_names, cols, strict=True))), preserve_index=False)

        return both.repartition(max(1, min(TASKS, pairs_count))).mapInArrow(run, schema)
