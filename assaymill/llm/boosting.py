"""A small gradient-boosted tree classifier over binned numeric features, for bounded training samples."""

from __future__ import annotations

import numpy as np

BINS = 32


class Trees:
    """Logistic boosting with complete trees: each tree has 2 ** depth - 1 (feature, threshold) splits and 2 ** depth leaves."""

    def __init__(self, depth: int = 4, rounds: int = 40, rate: float = 0.3, ridge: float = 1.0):
        self.depth, self.rounds, self.rate, self.ridge = depth, rounds, rate, ridge
        self.trees: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.base = 0.0

    def fit(self, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> Trees:
        share = np.clip(np.average(y, weights=weight), 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)])
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree, leaf = self._grow(binned, edges, weight * (y - p), weight * np.maximum(p * (1 - p), 1e-6))
            self.trees.append(tree)
            score += tree[2][leaf]
        return self

    def _grow(self, binned, edges, slope, curve):
        node = np.zeros(binned.shape[1], np.int64)
        feature, threshold = np.zeros(2 ** self.depth - 1, np.int64), np.full(2 ** self.depth - 1, np.inf)
        for level in range(self.depth):
            width, start = 2 ** level, 2 ** level - 1
            best = np.zeros(width)
            cut = np.full(width, BINS)
            for f, bins in enumerate(binned):
                cell = node * BINS + bins
                g = np.bincount(cell, weights=slope, minlength=width * BINS).reshape(width, BINS)
                h = np.bincount(cell, weights=curve, minlength=width * BINS).reshape(width, BINS)
                gl, hl = np.cumsum(g, 1), np.cumsum(h, 1)
                gt, ht = gl[:, -1:], hl[:, -1:]
                gain = gl ** 2 / (hl + self.ridge) + (gt - gl) ** 2 / (ht - hl + self.ridge) - gt ** 2 / (ht + self.ridge)
                gain[:, len(edges[f]):] = 0
                at = gain.argmax(1)
                top = gain[np.arange(width), at]
                better = top > best + 1e-9
                best = np.where(better, top, best)
                cut = np.where(better, at, cut)
                feature[start:start + width][better] = f
            for k in range(width):
                if cut[k] < BINS:
                    threshold[start + k] = edges[feature[start + k]][cut[k]]
            mine = feature[start + node]
            right = binned[mine, np.arange(len(node))] > cut[node]
            node = node * 2 + right
        g = np.bincount(node, weights=slope, minlength=2 ** self.depth)
        h = np.bincount(node, weights=curve, minlength=2 ** self.depth)
        return (feature, threshold, self.rate * g / (h + self.ridge)), node

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, threshold, leaves in self.trees:
            node = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                at = 2 ** level - 1 + node
                node = node * 2 + (x[rows, feature[at]] > threshold[at])
            out += leaves[node]
        return out
