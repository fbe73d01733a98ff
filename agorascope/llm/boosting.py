"""Gradient-boosted trees of small depth for logistic loss: fitted with numpy, applied as Spark columns."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def _tree(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, depth: int, least: float, ridge: float):
    g, h = grad.sum(), hess.sum()
    leaf = float(-g / (h + ridge))
    if depth == 0:
        return leaf
    best = (1e-6, None, None)
    for f in range(x.shape[1]):
        order = np.argsort(x[:, f], kind="stable")
        v, gs, hs = x[order, f], np.cumsum(grad[order])[:-1], np.cumsum(hess[order])[:-1]
        gain = gs**2 / (hs + ridge) + (g - gs) ** 2 / (h - hs + ridge) - g**2 / (h + ridge)
        gain[(v[1:] == v[:-1]) | (hs < least) | (h - hs < least)] = -1
        if len(gain) and gain.max() > best[0]:
            at = int(gain.argmax())
            best = (float(gain[at]), f, float((v[at] + v[at + 1]) / 2))
    if best[1] is None:
        return leaf
    left = x[:, best[1]] <= best[2]
    return (best[1], best[2], _tree(x[left], grad[left], hess[left], depth - 1, least, ridge), _tree(x[~left], grad[~left], hess[~left], depth - 1, least, ridge))


def _apply(tree, x: np.ndarray) -> np.ndarray:
    if not isinstance(tree, tuple):
        return np.full(len(x), tree)
    f, cut, low, high = tree
    return np.where(x[:, f] <= cut, _apply(low, x), _apply(high, x))


def calibrated(score: np.ndarray, target: np.ndarray, precision: float) -> float:
    """The least score from which on the precision among these rows is as asked for; halfway to the next row below."""
    order = np.argsort(-score, kind="stable")
    s, t = score[order], target[order]
    good = (np.cumsum(t) / np.arange(1, len(t) + 1) >= precision) & (np.append(s[1:], -np.inf) < s)
    if not good.any():
        return float(s[0]) + 1.0
    last = int(np.flatnonzero(good)[-1])
    return float((s[last] + (s[last + 1] if last + 1 < len(s) else s[last] - 1)) / 2)


class Boosted:
    def __init__(self, trees: list, bias: float):
        self.trees, self.bias = trees, bias

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = 3, rate: float = 0.3) -> Boosted:
        bias = float(np.log((y.mean() + 1e-6) / (1 - y.mean() + 1e-6)))
        score, trees = np.full(len(x), bias), []
        for _ in range(rounds):
            p = 1 / (1 + np.exp(-score))
            tree = _tree(x, p - y, p * (1 - p), depth, 1.0, 1.0)
            score += _apply(tree, x) * rate
            trees.append((tree, rate))
        return cls(trees, bias)

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.bias)
        for t, rate in self.trees:  # in the order of column(), so the last bits agree
            out = out + _apply(t, x) * rate
        return out

    def column(self, features: list[Column]) -> Column:
        """The score as an expression over the features."""
        def expr(tree) -> Column:
            if not isinstance(tree, tuple):
                return F.lit(float(tree))
            f, cut, low, high = tree
            return F.when(features[f] <= cut, expr(low)).otherwise(expr(high))

        return reduce(lambda a, b: a + b, [expr(t) * rate for t, rate in self.trees], F.lit(self.bias))
