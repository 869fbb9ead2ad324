"""Boosted regression trees on binned features, for logistic loss; fitted on a bounded sample."""

from __future__ import annotations

import numpy as np

BINS = 32


def _binned(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], axis=1).astype(np.int64)


class BoostedTrees:
    """Trees of fixed depth, all nodes of one level being split at once; leaves are Newton steps."""

    def __init__(self, trees: int = 40, depth: int = 4, rate: float = 0.2, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.ridge = trees, depth, rate, ridge
        self.edges: list[np.ndarray] = []
        self.base = 0.0
        self.splits: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> BoostedTrees:
        weight = np.ones(len(y)) if weight is None else weight
        self.edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
        bins = _binned(x, self.edges)
        share = np.clip((weight * y).sum() / weight.sum(), 1e-6, 1 - 1e-6)
        self.base = float(np.log(share / (1 - share)))
        margin = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-margin))
            tree = self._tree(bins, weight * (y - p), weight * p * (1 - p) + 1e-9)
            self.splits.append(tree)
            margin += self._leaves(tree, bins)
        return self

    def _tree(self, bins, gradient, curvature):
        rows, columns = bins.shape
        features = np.zeros((1 << self.depth) - 1, np.int64)
        limits = np.full((1 << self.depth) - 1, BINS, np.int64)
        node = np.zeros(rows, np.int64)
        for level in range(self.depth):
            first, count = (1 << level) - 1, 1 << level
            best = np.full(count, 1e-6)
            for j in range(columns):
                cell = (node - first) * (BINS + 1) + bins[:, j]
                g = np.bincount(cell, gradient, count * (BINS + 1)).reshape(count, -1)
                h = np.bincount(cell, curvature, count * (BINS + 1)).reshape(count, -1)
                left_g, left_h = g.cumsum(1), h.cumsum(1)
                all_g, all_h = left_g[:, -1:], left_h[:, -1:]
                gain = (left_g**2 / (left_h + self.ridge) + (all_g - left_g) ** 2 / (all_h - left_h + self.ridge)
                        - all_g**2 / (all_h + self.ridge))
                at = gain.argmax(1)
                better = gain[np.arange(count), at] > best
                best = np.where(better, gain[np.arange(count), at], best)
                features[first : first + count][better] = j
                limits[first : first + count][better] = at[better]
            node = 2 * node + 1 + (bins[np.arange(rows), features[node]] > limits[node])
        leaf = node - ((1 << self.depth) - 1)
        g = np.bincount(leaf, gradient, 1 << self.depth)
        h = np.bincount(leaf, curvature, 1 << self.depth)
        return features, limits, self.rate * g / (h + self.ridge)

    def _leaves(self, tree, bins):
        features, limits, values = tree
        node = np.zeros(len(bins), np.int64)
        rows = np.arange(len(bins))
        for _ in range(self.depth):
            node = 2 * node + 1 + (bins[rows, features[node]] > limits[node])
        return values[node - ((1 << self.depth) - 1)]

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of label 1."""
        if not len(x):
            return np.empty(0)
        bins = _binned(x, self.edges)
        return self.base + sum(self._leaves(tree, bins) for tree in self.splits)


def platt(margin: np.ndarray, y: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and offset that turn margins into calibrated log-odds, by damped Newton steps."""
    high, low = (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2)
    target = np.where(y > 0, high, low)

    def loss(at: np.ndarray) -> float:
        odds = at[0] * margin + at[1]
        return float((np.logaddexp(0, odds) - target * odds).sum())

    at = np.array([0.0, np.log((y.sum() + 1) / ((1 - y).sum() + 1))])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(at[0] * margin + at[1], -30, 30)))
        w = p * (1 - p)
        slope = np.array([((p - target) * margin).sum(), (p - target).sum()])
        curve = np.array([[(w * margin * margin).sum(), (w * margin).sum()], [(w * margin).sum(), w.sum()]])
        step, now = np.linalg.solve(curve + 1e-6 * np.eye(2), slope), loss(at)
        size = 1.0
        while size > 1e-6 and loss(at - size * step) > now:
            size /= 2
        at = at - size * step
        if np.abs(size * step).sum() < 1e-8:
            break
    return float(at[0]), float(at[1])
