"""Gradient-boosted trees for small tables: logistic loss, histogram splits, calibrated scores."""

from __future__ import annotations

import numpy as np

BINS = 32


class Boosted:
    """Full binary trees of one depth; ``edges`` are the bin limits of each feature."""

    def __init__(self, edges: list[np.ndarray], feature: np.ndarray, cut: np.ndarray, leaf: np.ndarray, scale: tuple[float, float] = (1.0, 0.0)):
        self.edges, self.feature, self.cut, self.leaf, self.scale = edges, feature, cut, leaf, scale

    def margin(self, rows: np.ndarray) -> np.ndarray:
        total = np.zeros(len(rows))
        if not len(rows):
            return total
        bins = _binned(rows, self.edges)
        everyone = np.arange(len(rows))
        depth = int(np.log2(self.leaf.shape[1]))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(rows), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (bins[everyone, feature[node]] > cut[node])
            total += leaf[node - (2**depth - 1)]
        return total

    def probability(self, rows: np.ndarray) -> np.ndarray:
        """Calibrated: a logistic curve of the margin fitted on rows that the trees did not see."""
        slope, shift = self.scale
        return 1.0 / (1.0 + np.exp(-np.clip(slope * self.margin(rows) + shift, -30, 30)))


def _binned(rows: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    return np.stack([np.searchsorted(e, rows[:, j], "left") for j, e in enumerate(edges)], 1)


def fit(rows: np.ndarray, labels: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, ridge: float = 1.0) -> Boosted:
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, BINS)[1:-1], method="lower")) for j in range(rows.shape[1])]
    bins = _binned(rows, edges)
    n, width = bins.shape
    flat = bins + BINS * np.arange(width)
    margin = np.zeros(n)
    features, cuts, leaves = [], [], []
    for _ in range(rounds):
        p = 1.0 / (1.0 + np.exp(-np.clip(margin, -30, 30)))
        slope, bend = labels - p, np.maximum(p * (1 - p), 1e-6)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(2**depth - 1, np.int64), np.full(2**depth - 1, BINS)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            at = (node - first)[:, None] * (width * BINS) + flat
            sums = [np.bincount(at.ravel(), np.repeat(w, width), many * width * BINS).reshape(many, width, BINS) for w in (slope, bend)]
            left = [s.cumsum(2) for s in sums]
            whole = [x[:, :1, -1:] for x in left]
            gain = left[0] ** 2 / (left[1] + ridge) + (whole[0] - left[0]) ** 2 / (whole[1] - left[1] + ridge)
            best = gain.reshape(many, -1).argmax(1)
            feature[first : first + many], cut[first : first + many] = best // BINS, best % BINS
            node = 2 * node + 1 + (bins[np.arange(n), feature[node]] > cut[node])
        place = node - (2**depth - 1)
        leaf = rate * np.bincount(place, slope, 2**depth) / (np.bincount(place, bend, 2**depth) + ridge)
        margin += leaf[place]
        features.append(feature)
        cuts.append(cut)
        leaves.append(leaf)
    return Boosted(edges, np.array(features), np.array(cuts), np.array(leaves))


def calibrate(model: Boosted, rows: np.ndarray, labels: np.ndarray, steps: int = 30) -> None:
    """Fit the logistic curve of the margins by Newton steps; targets are smoothed by one row a class."""
    x = model.margin(rows)
    good = labels.sum()
    target = np.where(labels > 0, (good + 1) / (good + 2), 1 / (len(labels) - good + 2))
    weight = np.array([1.0, 0.0])
    columns = np.stack([x, np.ones(len(x))], 1)
    for _ in range(steps):
        p = 1.0 / (1.0 + np.exp(-np.clip(columns @ weight, -30, 30)))
        bend = (columns * (p * (1 - p))[:, None]).T @ columns + 1e-3 * np.eye(2)
        weight = weight + np.linalg.solve(bend, columns.T @ (target - p))
    model.scale = (max(float(weight[0]), 1e-3), float(weight[1]))


def threshold(scores: np.ndarray, labels: np.ndarray, precision: float, least: float = 0.5) -> float:
    """Smallest score, ``least`` or more, from which on the rows reach ``precision``; above 1 if none does."""
    order = np.argsort(-scores, kind="stable")
    share = labels[order].cumsum() / np.arange(1, len(order) + 1)
    ends = np.append(scores[order][1:] != scores[order][:-1], True) if len(order) else np.zeros(0, bool)
    good = np.flatnonzero((share >= precision) & ends & (scores[order] >= least))
    return float(scores[order][good[-1]]) if len(good) else 2.0


def auc(scores: np.ndarray, labels: np.ndarray) -> float:
    _, inverse, counts = np.unique(scores, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - (counts - 1) / 2)[inverse]
    good = labels > 0
    a, b = good.sum(), (~good).sum()
    return float((rank[good].sum() - a * (a + 1) / 2) / (a * b)) if a and b else float("nan")
