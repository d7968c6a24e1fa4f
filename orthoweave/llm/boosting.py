"""Gradient-boosted trees for a yes-or-no label: logistic loss, histogram splits, Newton leaves; numpy only."""

from __future__ import annotations

import numpy as np


class BoostedTrees:
    """Trees of fixed depth, held as arrays: a node tests whether a feature is above a cut."""

    def __init__(self, trees: int = 40, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.ridge = trees, depth, rate, bins, ridge
        self.start, self.grown = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1)
        share = min(max(y.mean(), 1e-3), 1 - 1e-3)
        self.start = float(np.log(share / (1 - share)))
        at = np.full(len(y), self.start)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-at))
            g, h = p - y, p * (1 - p)
            leaf = np.zeros(len(y), np.int64)
            feature, cut = np.zeros(2**self.depth - 1, np.int64), np.full(2**self.depth - 1, np.inf)
            for level in range(self.depth):
                for k in range(2**level):
                    rows = np.flatnonzero(leaf == k)
                    best = (1e-9, 0, None)
                    for f, c in enumerate(cuts):
                        if len(rows) < 8 or not len(c):
                            continue
                        gs = np.cumsum(np.bincount(binned[rows, f], g[rows], len(c) + 1))
                        hs = np.cumsum(np.bincount(binned[rows, f], h[rows], len(c) + 1))
                        own = lambda a, b: a * a / (b + self.ridge)
                        gain = own(gs[:-1], hs[:-1]) + own(gs[-1] - gs[:-1], hs[-1] - hs[:-1]) - own(gs[-1], hs[-1])
                        if (i := int(gain.argmax())) >= 0 and gain[i] > best[0]:
                            best = (gain[i], f, c[i])
                    if best[2] is not None:
                        feature[2**level - 1 + k], cut[2**level - 1 + k] = best[1], best[2]
                node = 2**level - 1 + leaf
                leaf = leaf * 2 + (x[np.arange(len(y)), feature[node]] > cut[node])
            value = -self.rate * np.bincount(leaf, g, 2**self.depth) / (np.bincount(leaf, h, 2**self.depth) + self.ridge)
            at += value[leaf]
            self.grown.append((feature, cut, value))
        return self

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.full(len(x), self.start)
        for feature, cut, value in self.grown:
            leaf = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = 2**level - 1 + leaf
                leaf = leaf * 2 + (x[np.arange(len(x)), feature[node]] > cut[node])
            at += value[leaf]
        return 1 / (1 + np.exp(-at))
