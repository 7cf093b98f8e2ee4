"""A generalised additive model with pairwise interactions, fitted by cyclic boosting of shallow trees.

Every feature has a lookup table over its bins, some pairs of features a table over both. Each round visits the features
in turn and adds a small step of a shallow tree over that feature's bins, fitted to what the model so far leaves
unexplained; then the strongest pairs are visited likewise. A row's score is the sum of its table entries.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np


@dataclass(frozen=True)
class Boosting:
    bins: int = 32
    pair_bins: int = 8
    pairs: int = 8
    rounds: int = 150
    pair_rounds: int = 60
    rate: float = 0.1
    least: float = 2.0  # least sum of second derivatives in a leaf
    ridge: float = 1.0


@dataclass
class AdditiveModel:
    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    pair_edges: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def logit(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.intercept)
        for f, table in enumerate(self.tables):
            total += table[np.searchsorted(self.edges[f], x[:, f], "right")]
        coarse = {f: np.searchsorted(self.pair_edges[f], x[:, f], "right") for pair in self.pairs for f in pair}
        for (i, j), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[coarse[i], coarse[j]]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -40, 40)))


def _cuts(values: np.ndarray, bins: int) -> np.ndarray:
    """Ascending cut points between about equally many rows."""
    return np.unique(np.quantile(values, np.arange(1, bins) / bins, method="higher"))


def _best_cut(g: np.ndarray, h: np.ndarray, how: Boosting) -> tuple[float, int]:
    """Gain and place of the best cut of consecutive bins; no gain if a side is too light."""
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    right_g, right_h = g.sum() - left_g, h.sum() - left_h
    gain = left_g**2 / (left_h + how.ridge) + right_g**2 / (right_h + how.ridge) - g.sum() ** 2 / (h.sum() + how.ridge)
    gain = np.where((left_h >= how.least) & (right_h >= how.least), gain, 0.0)
    return (float(gain.max()), int(gain.argmax()) + 1) if len(gain) else (0.0, 0)


def _shallow_tree(g: np.ndarray, h: np.ndarray, how: Boosting) -> np.ndarray:
    """Leaf values over the bins of a tree with at most four leaves."""
    parts = [(0, len(g))]
    for _ in range(2):
        cut_parts = []
        for a, b in parts:
            gain, at = _best_cut(g[a:b], h[a:b], how)
            cut_parts += [(a, a + at), (a + at, b)] if gain > 0 else [(a, b)]
        parts = cut_parts
    step = np.zeros(len(g))
    for a, b in parts:
        step[a:b] = g[a:b].sum() / (h[a:b].sum() + how.ridge)
    return how.rate * step


def _quadrants(g: np.ndarray, h: np.ndarray, how: Boosting) -> tuple[float, np.ndarray]:
    """Gain and leaf values of the best tree that cuts both features once."""
    sums_g, sums_h = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    i, j = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")

    def corners(s: np.ndarray) -> np.ndarray:
        low, row, column, all_ = s[i, j], s[i, -1], s[-1, j], s[-1, -1]
        return np.stack([low, row - low, column - low, all_ - row - column + low])

    parts_g, parts_h = corners(sums_g), corners(sums_h)
    if not parts_g.size:
        return 0.0, np.zeros_like(g)
    gain = (parts_g**2 / (parts_h + how.ridge)).sum(axis=0)
    a, b = np.unravel_index(int(gain.argmax()), gain.shape)
    value = how.rate * parts_g[:, a, b] / (parts_h[:, a, b] + how.ridge)
    step = np.empty_like(g)
    step[: a + 1, : b + 1], step[: a + 1, b + 1 :], step[a + 1 :, : b + 1], step[a + 1 :, b + 1 :] = value
    return float(gain[a, b]), step


def fit(x: np.ndarray, y: np.ndarray, how: Boosting = Boosting()) -> AdditiveModel:
    """Fit to rows x and labels y (0 or 1). Without rows every score is 1/2; with one label only, near that label."""
    share = (y.sum() + 1) / (len(y) + 2)
    model = AdditiveModel(float(np.log(share / (1 - share))))
    if len(np.unique(y)) < 2:
        return model
    width = x.shape[1]
    model.edges = [_cuts(x[:, f], how.bins) for f in range(width)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    binned = [np.searchsorted(model.edges[f], x[:, f], "right") for f in range(width)]
    total = np.full(len(y), model.intercept)

    def derivatives() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return y - p, p * (1 - p)

    for _ in range(how.rounds):
        for f in range(width):
            (g, h), n = derivatives(), len(model.tables[f])
            step = _shallow_tree(np.bincount(binned[f], g, n), np.bincount(binned[f], h, n), how)
            model.tables[f] += step
            total += step[binned[f]]

    model.pair_edges = [_cuts(x[:, f], how.pair_bins) for f in range(width)]
    coarse = [np.searchsorted(model.pair_edges[f], x[:, f], "right") for f in range(width)]

    def pair_sums(i: int, j: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        shape = len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1
        cell, (g, h) = coarse[i] * shape[1] + coarse[j], derivatives()
        return cell, *(np.bincount(cell, v, shape[0] * shape[1]).reshape(shape) for v in (g, h))

    gains = {(i, j): _quadrants(*pair_sums(i, j)[1:], how)[0] for i in range(width) for j in range(i + 1, width)}
    model.pairs = sorted(gains, key=lambda p: (-gains[p], p))[: how.pairs]
    model.pair_tables = [np.zeros((len(model.pair_edges[i]) + 1, len(model.pair_edges[j]) + 1)) for i, j in model.pairs]
    for _ in range(how.pair_rounds):
        for k, (i, j) in enumerate(model.pairs):
            cell, g, h = pair_sums(i, j)
            step = _quadrants(g, h, how)[1]
            model.pair_tables[k] += step
            total += step.ravel()[cell]
    return model
