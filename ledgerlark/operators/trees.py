"""Tree ensembles as plain arrays, for forecasting many series at once inside a task."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Ensemble:
    """Node tables of all trees, one row per tree. Leaves point to themselves."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    depth: int

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Weighted sum over the trees for every row of x; all rows walk one level per step."""
        rows, trees = np.arange(len(x))[:, None], np.arange(len(self.weight))[None, :]
        node = np.zeros((len(x), len(self.weight)), dtype=np.int64)
        for _ in range(self.depth):
            goes_left = x[rows, self.feature[trees, node]] <= self.threshold[trees, node]
            node = np.where(goes_left, self.left[trees, node], self.right[trees, node])
        return self.value[trees, node] @ self.weight
