"""Gradient-boosted trees over dense features, and isotonic calibration, for models fitted on a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class BoostedTrees:
    """Binary logistic boosting: complete trees of one depth over quantile bins, second-order leaf values."""

    rounds: int = 80
    depth: int = 3
    rate: float = 0.15
    bins: int = 48
    leaf_weight: float = 2.0  # least sum of second derivatives in a leaf
    ridge: float = 1.0
    base: float = 0.0
    features: list[np.ndarray] = field(default_factory=list)
    cuts: list[np.ndarray] = field(default_factory=list)
    leaves: list[np.ndarray] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> BoostedTrees:
        n, k = x.shape
        weight = np.ones(n) if weight is None else weight
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, self.bins + 1)[1:-1])) for j in range(k)]
        # Values apart from a feature's mass at one point (often 0) get a cut of their own just above it.
        edges = [np.unique(np.r_[e, x[:, j].min()]) for j, e in enumerate(edges)]
        width = max(len(e) for e in edges) + 1
        codes = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        mean = np.clip(np.average(y, weights=weight), 1e-4, 1 - 1e-4) if n else 0.5
        self.base = float(np.log(mean / (1 - mean)))
        raw = np.full(n, self.base)
        for _ in range(self.rounds):
            p = sigmoid(raw)
            g, h = weight * (y - p), weight * np.maximum(p * (1 - p), 1e-9)
            feature, cut = np.zeros((1 << self.depth) - 1, np.int32), np.full((1 << self.depth) - 1, np.inf)
            node = np.zeros(n, np.int64)
            for level in range(self.depth):
                first, count = (1 << level) - 1, 1 << level
                at = (node - first) * width
                best = np.zeros(count)
                for j in range(k):
                    slot = at + codes[:, j]
                    sg = np.bincount(slot, g, count * width).reshape(count, width)
                    sh = np.bincount(slot, h, count * width).reshape(count, width)
                    lg, lh = np.cumsum(sg, 1), np.cumsum(sh, 1)
                    tg, th = lg[:, -1:], lh[:, -1:]
                    gain = lg**2 / (lh + self.ridge) + (tg - lg) ** 2 / (th - lh + self.ridge) - tg**2 / (th + self.ridge)
                    gain[(lh < self.leaf_weight) | (th - lh < self.leaf_weight)] = 0
                    gain = gain[:, : len(edges[j])]
                    top = gain.argmax(1)
                    value = gain[np.arange(count), top]
                    better = value > best + 1e-9
                    best[better] = value[better]
                    feature[first : first + count][better] = j
                    cut[first : first + count][better] = edges[j][top[better]]
                node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
            leaf = node - ((1 << self.depth) - 1)
            sums_g, sums_h = np.bincount(leaf, g, 1 << self.depth), np.bincount(leaf, h, 1 << self.depth)
            values = self.rate * sums_g / (sums_h + self.ridge)
            raw += values[leaf]
            self.features.append(feature), self.cuts.append(cut), self.leaves.append(values)
        return self

    def decision(self, x: np.ndarray) -> np.ndarray:
        """Log odds."""
        raw, rows = np.full(len(x), self.base), np.arange(len(x))
        for feature, cut, values in zip(self.features, self.cuts, self.leaves):
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            raw += values[node - len(feature)]
        return raw


@dataclass
class Isotonic:
    """Non-decreasing map from scores to probabilities by pooling adjacent violators; linear between blocks."""

    at: np.ndarray = field(default_factory=lambda: np.array([0.0]))
    to: np.ndarray = field(default_factory=lambda: np.array([0.0]))

    def fit(self, score: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Isotonic:
        order = np.argsort(score, kind="stable")
        blocks: list[list[float]] = []  # mean, weight, lowest and highest score
        for s, t, w in zip(score[order], y[order], weight[order]):
            blocks.append([float(t), float(w), float(s), float(s)])
            while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
                m, v, _, hi = blocks.pop()
                a = blocks[-1]
                blocks[-1] = [(a[0] * a[1] + m * v) / (a[1] + v), a[1] + v, a[2], hi]
        # A block's mean is drawn towards one half by one row, so that no score is exactly 0 or 1.
        smooth = [(b[0] * b[1] + 0.5) / (b[1] + 1) for b in blocks]
        self.at = np.array([p for b in blocks for p in (b[2], b[3])])
        self.to = np.maximum.accumulate(np.repeat(smooth, 2))
        return self

    def __call__(self, score: np.ndarray) -> np.ndarray:
        return np.interp(score, self.at, self.to)
