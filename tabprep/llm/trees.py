"""Histogram gradient-boosted trees for a bounded training matrix, stored as
flat arrays and traversed by numpy for all rows at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class FlatTrees:
    """Complete trees of one depth, node k with children 2k+1 and 2k+2.
    A node that does not split has threshold +inf, so every row goes left."""
    feature: np.ndarray        # trees x inner nodes
    threshold: np.ndarray      # trees x inner nodes
    leaf: np.ndarray           # trees x leaves
    start: float

    def margin(self, x: np.ndarray) -> np.ndarray:
        rows = np.arange(len(x))
        out = np.full(len(x), self.start)
        depth = int(np.log2(self.leaf.shape[1]))
        for f, t, leaf in zip(self.feature, self.threshold, self.leaf):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, f[node]] > t[node])
            out += leaf[node - (len(leaf) - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.margin(x), -30, 30)))


def fit(x: np.ndarray, y: np.ndarray, *, trees: int = 60, depth: int = 4, bins: int = 64, rate: float = 0.15,
        l2: float = 1.0, least_hessian: float = 2.0) -> FlatTrees:
    """Logistic loss, second-order splits on quantile bins.  Without rows of
    both classes the model is the (smoothed) share of class 1."""
    prior = (y.sum() + 0.5) / (len(y) + 1.0)
    start = float(np.log(prior / (1 - prior)))
    inner, leaves = 2 ** depth - 1, 2 ** depth
    if len(y) == 0 or y.min() == y.max():
        return FlatTrees(np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)), start)
    n, wide = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(wide)]
    code = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1)   # x <= edge[c] iff code <= c
    margin = np.full(n, start)
    made = ([], [], [])
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-6)
        feature, threshold = np.zeros(inner, np.int64), np.full(inner, np.inf)
        node = np.zeros(n, np.int64)
        for level in range(depth):
            width, first = 2 ** level, 2 ** level - 1
            local = node - first
            best = np.full(width, 1e-6)
            cut = np.full(width, -1)
            sum_g, sum_h = np.bincount(local, g, width), np.bincount(local, h, width)
            for j in range(wide):
                if not len(edges[j]):
                    continue
                size = len(edges[j]) + 1
                at = local * size + code[:, j]
                left_g = np.bincount(at, g, width * size).reshape(width, size).cumsum(1)[:, :-1]
                left_h = np.bincount(at, h, width * size).reshape(width, size).cumsum(1)[:, :-1]
                right_g, right_h = sum_g[:, None] - left_g, sum_h[:, None] - left_h
                gain = left_g ** 2 / (left_h + l2) + right_g ** 2 / (right_h + l2) - (sum_g ** 2 / (sum_h + l2))[:, None]
                gain[(left_h < least_hessian) | (right_h < least_hessian)] = 0
                k = gain.argmax(1)
                better = gain[np.arange(width), k] > best
                best[better], cut[better] = gain[np.arange(width), k][better], k[better]
                feature[first:first + width][better] = j
            for k in np.flatnonzero(cut >= 0):
                threshold[first + k] = edges[feature[first + k]][cut[k]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > threshold[node])
        local = node - inner
        value = -rate * np.bincount(local, g, leaves) / (np.bincount(local, h, leaves) + l2)
        margin += value[local]
        for store, part in zip(made, (feature, threshold, value)):
            store.append(part)
    return FlatTrees(np.array(made[0]), np.array(made[1]), np.array(made[2]), start)
