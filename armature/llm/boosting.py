"""Gradient-boosted trees for two classes, on binned features of a bounded sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Settings:
    rounds: int = 120
    depth: int = 4
    rate: float = 0.2
    bins: int = 24
    ridge: float = 1.0
    least_weight: float = 1.0


@dataclass(frozen=True)
class Trees:
    """`feature` and `cut` hold a row per tree in heap order (-1: no split, go left); `value` one entry per leaf."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, value in zip(self.feature, self.cut, self.value, strict=True):
            node = np.zeros(len(x), np.int64)
            while inner and len(x) and node[0] < inner:
                f = feature[node]
                node = 2 * node + 1 + ((f >= 0) & (x[rows, np.maximum(f, 0)] > cut[node]))
            out += value[node - inner]
        return out


def fit(x: np.ndarray, y: np.ndarray, settings: Settings = Settings()) -> Trees:
    """Labels are 0 or 1. One class only, or no rows, gives a constant."""
    n, k = x.shape
    rate = (y.sum() + 0.5) / (n + 1)
    base, inner = float(np.log(rate / (1 - rate))), 2**settings.depth - 1
    feature, cut, value = [], [], []
    if n and y.min() != y.max():
        edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, settings.bins + 1)[:-1])) for j in range(k)]
        bins = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
        margin = np.full(n, base)
        for _ in range(settings.rounds):
            p = 1 / (1 + np.exp(-margin))
            one = _tree(bins, edges, y - p, p * (1 - p), settings, inner)
            feature.append(one[0])
            cut.append(one[1])
            value.append(settings.rate * one[2])
            margin += value[-1][one[3]]
    shape = (len(feature), inner)
    return Trees(base, np.array(feature, np.int64).reshape(shape), np.array(cut, float).reshape(shape), np.array(value, float).reshape(len(value), inner + 1))


def _tree(bins, edges, g, h, settings: Settings, inner: int):
    """Grown level by level; every node takes the split of the highest gain."""
    n, k = bins.shape
    width = max(len(e) for e in edges) + 1
    feature, cut = np.full(inner, -1), np.full(inner, np.inf)
    node = np.zeros(n, np.int64)
    for level in range(settings.depth):
        first, count = 2**level - 1, 2**level
        local = node - first
        best, choice = np.full(count, 1e-6), np.full((count, 2), -1)
        for j in range(k):
            if len(edges[j]) < 2:
                continue
            cell = local * width + bins[:, j]
            sg, sh = (np.bincount(cell, w, count * width).reshape(count, width).cumsum(axis=1) for w in (g, h))
            all_g, all_h = sg[:, -1:], sh[:, -1:]
            gain = sg**2 / (sh + settings.ridge) + (all_g - sg) ** 2 / (all_h - sh + settings.ridge) - all_g**2 / (all_h + settings.ridge)
            gain[(sh < settings.least_weight) | (all_h - sh < settings.least_weight)] = 0
            gain[:, len(edges[j]) :] = 0
            at = gain.argmax(axis=1)
            top = gain[np.arange(count), at]
            better = top > best
            best[better] = top[better]
            choice[better] = np.stack([np.full(count, j), at], axis=1)[better]
        for c in range(count):
            if choice[c, 0] >= 0:
                feature[first + c], cut[first + c] = choice[c, 0], edges[choice[c, 0]][choice[c, 1]]
        chosen = choice[local]
        right = (chosen[:, 0] >= 0) & (bins[np.arange(n), np.maximum(chosen[:, 0], 0)] > chosen[:, 1])
        node = 2 * node + 1 + right
    leaf = node - inner
    value = np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + settings.ridge)
    return feature, cut, value, leaf
