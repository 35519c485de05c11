"""A small decision tree (CART, Gini) for a bounded, given table of labelled rows."""

from __future__ import annotations

import numpy as np


class Tree:
    """Classifies rows of numbers; `fit` on a small table, then `label` one row at a time."""

    def __init__(self, max_depth: int = 8, min_rows: int = 1):
        self.max_depth, self.min_rows, self.root = max_depth, min_rows, None

    def fit(self, rows, labels) -> Tree:
        x, (self.names, y) = np.asarray(rows, float), np.unique(np.asarray(labels), return_inverse=True)
        self.root = self._grow(x, y, 0)
        return self

    def _gini(self, y) -> float:
        p = np.bincount(y) / len(y)
        return 1 - float(p @ p)

    def _grow(self, x, y, depth):
        top = str(self.names[np.bincount(y).argmax()])
        best = (self._gini(y) - 1e-12, None, None)
        if depth < self.max_depth and best[0] > 0:
            for f in range(x.shape[1]):
                values = np.unique(x[:, f])
                for cut in (values[1:] + values[:-1]) / 2:
                    left = x[:, f] <= cut
                    n = left.sum()
                    if min(n, len(y) - n) < self.min_rows:
                        continue
                    score = (n * self._gini(y[left]) + (len(y) - n) * self._gini(y[~left])) / len(y)
                    if score < best[0] - 1e-12:
                        best = (score, f, cut)
        if best[1] is None:
            return top
        left = x[:, best[1]] <= best[2]
        return best[1], best[2], self._grow(x[left], y[left], depth + 1), self._grow(x[~left], y[~left], depth + 1)

    def label(self, row) -> str:
        node = self.root
        while not isinstance(node, str):
            node = node[2] if row[node[0]] <= node[1] else node[3]
        return node
