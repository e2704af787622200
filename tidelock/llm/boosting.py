"""Gradient-boosted trees for two classes, in numpy, with monotonic constraints.

Trees are grown depth by depth over quantile bins and end as flat node arrays,
which score a batch by stepping all rows through all trees at once.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class FlatTrees:
    """All nodes of all trees; a leaf points to itself and holds a value."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    base: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of class 1 per row."""
        at = np.broadcast_to(self.roots, (len(x), len(self.roots))).copy()
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            at = np.where(x[row, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.scores(x)))


def fit(
    x: np.ndarray, y: np.ndarray, monotone: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 48, ridge: float = 1.0, least: float = 3.0
) -> FlatTrees:
    """monotone: per feature 1 (score may not fall as it grows), -1 (may not rise) or 0.

    A constrained split is taken only if its sides' values are in order, and the values below each side are kept on
    its side of their middle, so that the whole ensemble is monotone in that feature.  least: hessian sum of a side.
    """
    n, m = x.shape
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(m)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(m)], 1)
    rate_one = min(max(y.mean(), 1e-3), 1 - 1e-3)
    base = float(np.log(rate_one / (1 - rate_one)))
    score = np.full(n, base)
    feature, threshold, left, right, value, roots = [], [], [], [], [], []

    def leaf(v: float) -> int:
        feature.append(0), threshold.append(np.inf), left.append(len(left)), right.append(len(right)), value.append(v)
        return len(value) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = y - p, p * (1 - p)
        root = leaf(0.0)
        roots.append(root)
        level = [(root, np.arange(n), -np.inf, np.inf)]
        for d in range(depth + 1):
            below = []
            for node, rows, lo, hi in level:
                own = float(np.clip(grad[rows].sum() / (hess[rows].sum() + ridge), lo, hi))
                split = _split(binned, edges, grad, hess, rows, lo, hi, monotone, ridge, least, bins) if d < depth else None
                if split is None:
                    value[node] = rate * own
                    score[rows] += rate * own
                    continue
                j, b, low, high = split
                goes = binned[rows, j] <= b
                middle = (low + high) / 2
                first, second = leaf(0.0), leaf(0.0)
                feature[node], threshold[node], left[node], right[node] = j, float(edges[j][b]), first, second
                below.append((first, rows[goes], middle if monotone[j] < 0 else lo, middle if monotone[j] > 0 else hi))
                below.append((second, rows[~goes], middle if monotone[j] > 0 else lo, middle if monotone[j] < 0 else hi))
            level = below
    return FlatTrees(np.array(roots), np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value), depth, base)


def _split(binned, edges, grad, hess, rows, lo, hi, monotone, ridge, least, bins):
    """The best (feature, bin, value at or below it, value above it), or None."""
    g_all, h_all = grad[rows].sum(), hess[rows].sum()
    best, found = 1e-6, None
    for j in range(binned.shape[1]):
        if not len(edges[j]):
            continue
        g = np.cumsum(np.bincount(binned[rows, j], grad[rows], len(edges[j]) + 1))[:-1]
        h = np.cumsum(np.bincount(binned[rows, j], hess[rows], len(edges[j]) + 1))[:-1]
        low, high = np.clip(g / (h + ridge), lo, hi), np.clip((g_all - g) / (h_all - h + ridge), lo, hi)
        # gain of values low and high over the second-order loss
        gain = g * low - (h + ridge) * low**2 / 2 + (g_all - g) * high - (h_all - h + ridge) * high**2 / 2
        own = np.clip(g_all / (h_all + ridge), lo, hi)
        gain -= g_all * own - (h_all + ridge) * own**2 / 2
        gain[(h < least) | (h_all - h < least) | (monotone[j] * (high - low) < 0)] = -np.inf
        if gain.max() > best:
            b = int(gain.argmax())
            best, found = gain[b], (j, b, low[b], high[b])
    return found
