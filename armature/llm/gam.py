"""Additive model with pairwise interactions, fitted by cyclic boosting of shallow trees on binned features.

Every feature is cut into bins; a tree of at most `leaves` leaves is grown on the gradient histogram of one feature at a time,
feature after feature, round after round, with a small step, and is added to that feature's lookup table. Then the pairs
whose four-quadrant fit of the remaining gradient gains most are boosted the same way on two-dimensional tables. A score is
the logistic of the sum of table entries. Fitting needs the bins only, so it works on histograms of a bounded sample.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Settings:
    bins: int = 32
    rounds: int = 60
    rate: float = 0.15
    leaves: int = 4
    pairs: int = 6
    pair_rounds: int = 30
    ridge: float = 1.0


@dataclass(frozen=True)
class Additive:
    edges: list[np.ndarray]  # per feature: increasing cut points
    base: float
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_tables: list[np.ndarray]

    def bins(self, features: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, x, side="right") for e, x in zip(self.edges, features.T, strict=True)], axis=1)

    def margin(self, features: np.ndarray) -> np.ndarray:
        b = self.bins(features)
        out = np.full(len(features), self.base)
        for i, t in enumerate(self.tables):
            out += t[b[:, i]]
        for (i, j), t in zip(self.pairs, self.pair_tables, strict=True):
            out += t[b[:, i], b[:, j]]
        return out

    def score(self, features: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(features), -40, 40)))


def cut_points(x: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(x, np.linspace(0, 1, bins + 1)[1:-1])) if len(x) else np.zeros(0)


def _line_tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Values of the bins of one feature: the best split is taken until there are `leaves` leaves."""
    cut = [0, len(g)]
    sum_g, sum_h = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    worth = lambda a, b: (sum_g[b] - sum_g[a]) ** 2 / (sum_h[b] - sum_h[a] + ridge)
    while len(cut) <= leaves:
        best, where = 1e-9, None
        for a, b in zip(cut[:-1], cut[1:], strict=True):
            if b - a > 1:
                m = np.arange(a + 1, b)
                gain = worth(a, m) + worth(m, b) - worth(a, b)
                if gain.max() > best:
                    best, where = gain.max(), int(m[gain.argmax()])
        if where is None:
            break
        cut = sorted([*cut, where])
    out = np.zeros(len(g))
    for a, b in zip(cut[:-1], cut[1:], strict=True):
        out[a:b] = (sum_g[b] - sum_g[a]) / (sum_h[b] - sum_h[a] + ridge)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """The best cut of a two-dimensional histogram into four quadrants: gain and values."""
    sg, sh = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    n, m = g.shape
    if n < 2 or m < 2:
        return 0.0, np.zeros_like(g)
    r, c = np.meshgrid(np.arange(1, n), np.arange(1, m), indexing="ij")

    def parts(s):
        a = s[r, c]
        return a, s[r, m] - a, s[n, c] - a, s[n, m] - s[r, m] - s[n, c] + a

    total = sum(x**2 / (y + ridge) for x, y in zip(parts(sg), parts(sh), strict=True))
    at = np.unravel_index(total.argmax(), total.shape)
    i, j = int(r[at]), int(c[at])
    gain = float(total[at] - sg[n, m] ** 2 / (sh[n, m] + ridge))
    values = [x[at] / (y[at] + ridge) for x, y in zip(parts(sg), parts(sh), strict=True)]
    out = np.empty_like(g)
    out[:i, :j], out[:i, j:], out[i:, :j], out[i:, j:] = values
    return gain, out


def fit(features: np.ndarray, label: np.ndarray, settings: Settings = Settings()) -> Additive:
    """Labels are 0 or 1. One class only, or no rows, gives a constant."""
    n, k = features.shape
    edges = [cut_points(features[:, i], settings.bins) for i in range(k)]
    rate = (label.sum() + 0.5) / (n + 1)
    base = float(np.log(rate / (1 - rate)))
    model = Additive(edges, base, [np.zeros(len(e) + 1) for e in edges], [], [])
    if n == 0 or label.min() == label.max():
        return model
    b = model.bins(features)
    margin = np.full(n, base)

    def slopes():
        p = 1 / (1 + np.exp(-margin))
        return label - p, p * (1 - p)

    for _ in range(settings.rounds):
        for i, table in enumerate(model.tables):
            g, h = slopes()
            step = settings.rate * _line_tree(np.bincount(b[:, i], g, len(table)), np.bincount(b[:, i], h, len(table)), settings.leaves, settings.ridge)
            table += step
            margin += step[b[:, i]]

    def grid(i: int, j: int):
        shape = (len(model.tables[i]), len(model.tables[j]))
        cell = b[:, i] * shape[1] + b[:, j]
        g, h = slopes()
        return cell, [np.bincount(cell, x, shape[0] * shape[1]).reshape(shape) for x in (g, h)]

    ranked = sorted(((_quadrants(*grid(i, j)[1], settings.ridge)[0], i, j) for i in range(k) for j in range(i)), key=lambda x: (-x[0], x[1], x[2]))
    for _, i, j in ranked[: settings.pairs]:
        model.pairs.append((i, j))
        model.pair_tables.append(np.zeros((len(model.tables[i]), len(model.tables[j]))))
    for _ in range(settings.pair_rounds):
        for (i, j), table in zip(model.pairs, model.pair_tables, strict=True):
            cell, (g, h) = grid(i, j)
            step = settings.rate * _quadrants(g, h, settings.ridge)[1]
            table += step
            margin += step.reshape(-1)[cell]
    return model
