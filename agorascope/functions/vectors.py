"""Vectors as arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def l2_normalize(v: Column) -> Column:
    """A vector of length 1; the zero vector stays."""
    return F.when(norm(v) == 0, F.transform(v, lambda x: x.cast("double"))).otherwise(F.transform(v, lambda x: x.cast("double") / norm(v)))


def distance(v: Column, c: Column, metric: str = "euclidean") -> Column:
    """cosine (1 where a vector is zero), manhattan, else euclidean."""
    if metric == "cosine":
        both = norm(v) * norm(c)
        return F.when(both == 0, F.lit(1.0)).otherwise(1 - dot(v, c) / F.nullif(both, F.lit(0.0)))
    gap = F.zip_with(v, c, lambda x, y: x.cast("double") - y.cast("double"))
    if metric == "manhattan":
        return F.aggregate(gap, F.lit(0.0), lambda s, x: s + F.abs(x))
    return F.sqrt(F.aggregate(gap, F.lit(0.0), lambda s, x: s + x * x))
