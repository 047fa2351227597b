"""Gradient-boosted trees for two classes: logistic loss, histogram splits, numpy only.

A fit needs rows only by the bins of their features: equal ones count as one row with its weight, so a table of any
size is fitted whole by the distinct ones. The model is a few kilobytes in a task's closure.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


def in_bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """The number of the bin of each feature: how many of its edges are less."""
    return np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T, strict=True)], axis=1).astype(np.uint8) if edges else np.zeros((len(x), 0), np.uint8)


@dataclass
class BoostedTrees:
    rounds: int = 40
    depth: int = 3
    rate: float = 0.3
    bins: int = 32
    min_leaf: int = 5
    l2: float = 1.0
    base: float = 0.0
    trees: list = field(default_factory=list)

    @property
    def cuts(self) -> np.ndarray:
        """Ranks of a feature's values, as parts of one, at which it is cut into bins."""
        return np.linspace(0, 1, self.bins + 1)[1:-1]

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        x, y = np.asarray(x, dtype=np.float64), np.asarray(y, dtype=np.float64)
        edges = [np.unique(np.quantile(c, self.cuts)) for c in x.T] if len(y) else []
        return self.fit_binned(in_bins(x, edges), edges, y, np.ones(len(y)))

    def fit_binned(self, binned: np.ndarray, edges: list[np.ndarray], y: np.ndarray, weight: np.ndarray) -> BoostedTrees:
        """The fit on rows that stand ``weight`` times each, given by the bins between the ``edges`` of their features."""
        self.trees = []
        share = np.clip(np.average(y, weights=weight) if len(y) else 0.5, 1e-3, 1 - 1e-3)
        self.base = float(np.log(share / (1 - share)))
        if not len(y) or y.min() == y.max():
            return self
        score = np.full(len(y), self.base)
        for _ in range(self.rounds):
            p = 1 / (1 + np.exp(-score))
            tree, at = self._grow(binned, edges, weight * (p - y), weight * p * (1 - p), weight, np.arange(len(y)), self.depth)
            self.trees.append(tree)
            for rows, leaf in at:
                score[rows] += leaf
        return self

    def _grow(self, binned, edges, g, h, weight, rows, depth):  # noqa: ANN001, ANN202
        """(tree, [(rows, leaf)])."""
        total_g, total_h, total = g[rows].sum(), h[rows].sum(), weight[rows].sum()
        leaf = -self.rate * total_g / (total_h + self.l2)
        if depth == 0 or total < 2 * self.min_leaf:
            return leaf, [(rows, leaf)]
        best = (1e-6, None, None)
        for f, e in enumerate(edges):
            if not len(e):
                continue
            b = binned[rows, f]
            n = len(e) + 1
            cg, ch, cn = (np.cumsum(np.bincount(b, x[rows], n)) for x in (g, h, weight))
            ok = (cn >= self.min_leaf) & (total - cn >= self.min_leaf)
            gain = cg**2 / (ch + self.l2) + (total_g - cg) ** 2 / (total_h - ch + self.l2) - total_g**2 / (total_h + self.l2)
            gain = np.where(ok, gain, -1)[:-1]
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (gain[k], f, k)
        if best[1] is None:
            return leaf, [(rows, leaf)]
        _, f, k = best
        left = binned[rows, f] <= k
        low, at_low = self._grow(binned, edges, g, h, weight, rows[left], depth - 1)
        high, at_high = self._grow(binned, edges, g, h, weight, rows[~left], depth - 1)
        return (f, float(edges[f][k]), low, high), at_low + at_high

    def _apply(self, tree, x):  # noqa: ANN001, ANN202
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        f, edge, low, high = tree
        left = x[:, f] <= edge
        out = np.empty(len(x))
        out[left], out[~left] = self._apply(low, x[left]), self._apply(high, x[~left])
        return out

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of class 1."""
        x = np.asarray(x, dtype=np.float64)
        score = np.full(len(x), self.base)
        for tree in self.trees:
            score += self._apply(tree, x)
        return 1 / (1 + np.exp(-score))
