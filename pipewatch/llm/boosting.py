"""Gradient-boosted trees with monotonic constraints, flattened into numpy node arrays.

Fitting is for a bounded sample on the driver: histograms over quantile bins, logistic loss, trees
of a fixed depth. A fitted model is four arrays in heap order (the children of node i are 2i + 1
and 2i + 2), and scoring walks all rows of a batch down one level at a time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    feature: np.ndarray  # trees x nodes; -1 in a leaf
    threshold: np.ndarray
    value: np.ndarray
    base: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        depth = int(np.log2(self.feature.shape[1] + 1)) - 1
        for feature, threshold, value in zip(self.feature, self.threshold, self.value):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                own = feature[node]
                right = x[rows, np.maximum(own, 0)] > threshold[node]
                node = np.where(own >= 0, 2 * node + 1 + right, node)
            total += value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -40, 40)))


def fit_forest(
    x: np.ndarray,
    y: np.ndarray,
    monotone: Sequence[int],
    trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    l2: float = 1.0,
    min_rows: int = 5,
) -> Forest:
    """``monotone`` has 1, -1 or 0 per feature: the probability may only rise, only fall, or do both."""
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f], side="left") for f, e in enumerate(edges)], axis=1)
    mean = np.clip(y.mean(), 1e-6, 1 - 1e-6)
    base = float(np.log(mean / (1 - mean)))
    score = np.full(len(y), base)
    nodes = 2 ** (depth + 1) - 1
    features, thresholds, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-score))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        feature, threshold = np.full(nodes, -1), np.zeros(nodes)
        value, place = np.zeros(nodes), np.zeros(len(y), np.int64)
        low, high = np.full(nodes, -np.inf), np.full(nodes, np.inf)
        value[0] = -grad.sum() / (hess.sum() + l2)
        for level in range(depth):
            for node in range(2**level - 1, 2 ** (level + 1) - 1):
                inside = np.flatnonzero(place == node)
                if len(inside) < 2 * min_rows:
                    continue
                best = _best_split(binned[inside], grad[inside], hess[inside], edges, monotone, (low[node], high[node]), l2, min_rows)
                if best is None:
                    continue
                f, b, left_value, right_value = best
                feature[node], threshold[node] = f, edges[f][b]
                left, right = 2 * node + 1, 2 * node + 2
                place[inside] = np.where(binned[inside, f] <= b, left, right)
                value[left], value[right] = left_value, right_value
                low[[left, right]], high[[left, right]] = low[node], high[node]
                middle = (left_value + right_value) / 2
                if monotone[f] > 0:
                    high[left] = low[right] = middle
                elif monotone[f] < 0:
                    low[left] = high[right] = middle
        value *= rate
        score += value[place]
        features.append(feature)
        thresholds.append(threshold)
        values.append(value)
    return Forest(np.array(features), np.array(thresholds), np.array(values), base)


def _best_split(binned, grad, hess, edges, monotone, bounds, l2, min_rows):
    best, gain = None, 1e-6
    g_all, h_all = grad.sum(), hess.sum()
    for f, e in enumerate(edges):
        if not len(e):
            continue
        size = len(e) + 1
        g = np.cumsum(np.bincount(binned[:, f], grad, size))[:-1]
        h = np.cumsum(np.bincount(binned[:, f], hess, size))[:-1]
        n = np.cumsum(np.bincount(binned[:, f], minlength=size))[:-1]
        left, right = np.clip(-g / (h + l2), *bounds), np.clip(-(g_all - g) / (h_all - h + l2), *bounds)
        won = -(g * left + 0.5 * (h + l2) * left**2) - ((g_all - g) * right + 0.5 * (h_all - h + l2) * right**2)
        won -= 0.5 * g_all**2 / (h_all + l2)
        ok = (n >= min_rows) & (len(binned) - n >= min_rows) & (monotone[f] * (right - left) >= 0)
        won = np.where(ok, won, -np.inf)
        b = int(np.argmax(won))
        if won[b] > gain:
            best, gain = (f, b, left[b], right[b]), won[b]
    return best
