"""Gradient-boosted regression trees for two classes on a bounded table of dense features, and isotonic calibration."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """Complete binary trees: a split per inner node, a value per leaf."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray  # go right where the feature is greater
    value: np.ndarray  # (trees, leaves)

    def raw(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            total += value[node - inner]
        return total


def fit_trees(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64) -> Trees:
    """Logistic loss, second-order splits over quantile bins, shrinkage and an L2 penalty of 1."""
    n, width = x.shape
    share = np.clip(y.mean() if n else 0.0, 1e-4, 1 - 1e-4)
    base, inner, leaves = float(np.log(share / (1 - share))), 2**depth - 1, 2**depth
    if not n or y.min() == y.max():
        return Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(width)]
    binned = np.stack([np.searchsorted(edges[j], x[:, j], "left") for j in range(width)], axis=1)
    raw = np.full(n, base)
    features, cuts, values = [], [], []
    for _ in range(trees):
        p = 1 / (1 + np.exp(-raw))
        gradient, hessian = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            best = np.zeros(count)
            for j in range(width):
                k = len(edges[j]) + 1
                cell = (node - first) * k + binned[:, j]
                g = np.bincount(cell, gradient, count * k).reshape(count, k).cumsum(axis=1)
                h = np.bincount(cell, hessian, count * k).reshape(count, k).cumsum(axis=1)
                gain = g**2 / (h + 1) + (g[:, -1:] - g) ** 2 / (h[:, -1:] - h + 1) - g[:, -1:] ** 2 / (h[:, -1:] + 1)
                if k < 2:
                    continue
                at = gain[:, :-1].argmax(axis=1)
                better = gain[np.arange(count), at] > best + 1e-9
                best[better] = gain[np.arange(count), at][better]
                feature[first:first + count][better] = j
                cut[first:first + count][better] = edges[j][at[better]]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        leaf = node - inner
        value = -rate * np.bincount(leaf, gradient, leaves) / (np.bincount(leaf, hessian, leaves) + 1)
        raw += value[leaf]
        features.append(feature)
        cuts.append(cut)
        values.append(value)
    return Trees(base, np.array(features), np.array(cuts), np.array(values))


def fit_isotonic(raw: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the non-decreasing function from raw scores to probabilities, by pooling adjacent violators."""
    order = np.argsort(raw, kind="stable")
    blocks: list[list[float]] = []  # sum, count, least and greatest raw score
    for r, label in zip(raw[order].tolist(), y[order].tolist(), strict=True):
        blocks.append([label, 1, r, r])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            s, n, _, high = blocks.pop()
            blocks[-1][0] += s
            blocks[-1][1] += n
            blocks[-1][3] = high
    knots = [(x, s / n) for s, n, low, high in blocks for x in ({low, high} if low < high else {low})]
    knots.sort()
    return np.array([x for x, _ in knots]), np.array([p for _, p in knots])
