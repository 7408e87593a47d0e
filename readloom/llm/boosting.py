"""Gradient-boosted trees and isotonic calibration on a bounded sample, in numpy."""

from __future__ import annotations

import numpy as np


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Boosted:
    """Logistic boosting: trees of one depth, split over quantile bins, Newton leaves."""

    def __init__(self, trees: int = 80, depth: int = 3, rate: float = 0.15, bins: int = 32, ridge: float = 2.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boosted:
        n, m = x.shape
        self.base = float(np.log((y.sum() + 0.5) / (n - y.sum() + 0.5)))
        cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(m)]
        code = np.column_stack([np.searchsorted(cuts[j], x[:, j], "left") for j in range(m)])
        f, self.feature, self.cut, self.leaf = np.full(n, self.base), [], [], []
        for _ in range(self.trees):
            p = _sigmoid(f)
            g, h = y - p, p * (1 - p)
            node = np.zeros(n, np.int64)
            feature, cut = np.zeros((self.depth, 2**self.depth), np.int64), np.full((self.depth, 2**self.depth), np.inf)
            for level in range(self.depth):
                width, best = 2**level, np.full(2**level, 1e-6)
                chosen, where = np.zeros(width, np.int64), np.full(width, self.bins + 1)
                for j in range(m):
                    if not len(cuts[j]):
                        continue
                    at, size = node * (self.bins + 1) + code[:, j], width * (self.bins + 1)
                    gl = np.bincount(at, g, size).reshape(width, -1).cumsum(1)
                    hl = np.bincount(at, h, size).reshape(width, -1).cumsum(1)
                    gt, ht = gl[:, -1:], hl[:, -1:]
                    gain = gl**2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt**2 / (ht + self.ridge)
                    gain = gain[:, : len(cuts[j])]
                    k = gain.argmax(1)
                    top = gain[np.arange(width), k]
                    better = top > best
                    best[better], chosen[better], where[better] = top[better], j, k[better]
                for k in range(width):
                    feature[level, k] = chosen[k]
                    cut[level, k] = cuts[chosen[k]][where[k]] if where[k] <= self.bins else np.inf
                node = 2 * node + (x[np.arange(n), feature[level][node]] > cut[level][node])
            leaves = 2**self.depth
            value = self.rate * np.bincount(node, g, leaves) / (np.bincount(node, h, leaves) + self.ridge)
            f = f + value[node]
            self.feature.append(feature)
            self.cut.append(cut)
            self.leaf.append(value)
        return self

    def raw(self, x: np.ndarray) -> np.ndarray:
        f, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = 2 * node + (x[rows, feature[level][node]] > cut[level][node])
            f += leaf[node]
        return f


class Isotonic:
    """Pool adjacent violators; between the pools' middles the score runs straight."""

    def fit(self, s: np.ndarray, y: np.ndarray) -> Isotonic:
        order = np.argsort(s, kind="stable")
        values, first = np.unique(s[order], return_index=True)
        total, weight = np.add.reduceat(y[order].astype(float), first), np.diff([*first, len(s)])
        pools: list[list[float]] = []
        for v, t, w in zip(values, total, weight, strict=True):
            pools.append([v * w, t, w])
            while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
                last = pools.pop()
                pools[-1] = [a + b for a, b in zip(pools[-1], last, strict=True)]
        self.x = np.array([p[0] / p[2] for p in pools])
        self.y = np.array([p[1] / p[2] for p in pools])
        return self

    def apply(self, s: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(s, self.x, self.y), 0, 1)


class Constant:
    """What is left where one of the classes has no rows."""

    def __init__(self, value: float):
        self.value = value

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


class Calibrated:
    """Boosting with calibration on predictions for rows that the trees have not seen (cross-fitting over `parts`)."""

    def __init__(self, parts: int = 3, **how):
        self.parts, self.how = parts, how

    def fit(self, x: np.ndarray, y: np.ndarray) -> Calibrated:
        part = np.random.Generator(np.random.PCG64(5)).permutation(len(y)) % self.parts
        out = np.zeros(len(y))
        for k in range(self.parts):
            out[part == k] = Boosted(**self.how).fit(x[part != k], y[part != k]).raw(x[part == k])
        self.isotonic, self.model = Isotonic().fit(out, y), Boosted(**self.how).fit(x, y)
        return self

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self.isotonic.apply(self.model.raw(x))


def fit_scores(x: np.ndarray, y: np.ndarray, **how):
    """A function from features to scores in [0, 1]."""
    if len(y) < 20 or y.min() == y.max():
        return Constant(float(y.mean()) if len(y) else 0.0)
    return Calibrated(**how).fit(x, y.astype(float))
