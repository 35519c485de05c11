"""Gradient boosted trees for two classes on a bounded table, with numpy only."""

from __future__ import annotations

import numpy as np


class Boost:
    """Logistic boosting of small regression trees over numeric features; deterministic."""

    def __init__(self, rounds: int = 60, depth: int = 3, rate: float = 0.25, min_weight: float = 2.0, l2: float = 1.0):
        self.rounds, self.depth, self.rate, self.min_weight, self.l2 = rounds, depth, rate, min_weight, l2
        self.base, self.trees = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> Boost:
        x, y = np.asarray(x, float), np.asarray(y, float)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base, self.trees = float(np.log(p / (1 - p))), []
        score = np.full(len(y), self.base)
        cuts = [np.unique(np.quantile(x[:, f], np.linspace(0.02, 0.98, 33))) for f in range(x.shape[1])]
        for _ in range(self.rounds):
            q = 1 / (1 + np.exp(-score))
            tree = self._grow(x, y - q, q * (1 - q), np.arange(len(y)), cuts, 0)
            self.trees.append(tree)
            score += self._apply(tree, x)
        return self

    def _grow(self, x, g, h, rows, cuts, depth):
        gs, hs = g[rows].sum(), h[rows].sum()
        best = (1e-9, None, None)
        if depth < self.depth:
            for f in range(x.shape[1]):
                column = x[rows, f]
                for cut in cuts[f]:
                    left = column <= cut
                    hl = h[rows][left].sum()
                    if hl < self.min_weight or hs - hl < self.min_weight:
                        continue
                    gl = g[rows][left].sum()
                    gain = gl**2 / (hl + self.l2) + (gs - gl) ** 2 / (hs - hl + self.l2) - gs**2 / (hs + self.l2)
                    if gain > best[0]:
                        best = (gain, f, cut)
        if best[1] is None:
            return self.rate * gs / (hs + self.l2)
        left = x[rows, best[1]] <= best[2]
        return best[1], best[2], self._grow(x, g, h, rows[left], cuts, depth + 1), self._grow(x, g, h, rows[~left], cuts, depth + 1)

    def _apply(self, tree, x) -> np.ndarray:
        if not isinstance(tree, tuple):
            return np.full(len(x), tree)
        out, left = np.empty(len(x)), x[:, tree[0]] <= tree[1]
        out[left], out[~left] = self._apply(tree[2], x[left]), self._apply(tree[3], x[~left])
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        x = np.asarray(x, float)
        return 1 / (1 + np.exp(-(self.base + sum(self._apply(t, x) for t in self.trees)))) if len(x) else np.empty(0)


def best_threshold(p: np.ndarray, y: np.ndarray) -> float:
    """The probability above which the F1 score on held-out rows is best; of a plateau its middle."""
    grid = np.linspace(0.05, 0.95, 91)
    f1 = [2 * (tp := ((p >= t) & (y == 1)).sum()) / max(1, (p >= t).sum() + (y == 1).sum()) for t in grid]
    good = grid[np.isclose(f1, max(f1))]
    return float(good[len(good) // 2])
