"""A random forest for two classes: training by Gini gain on bootstrap samples, and vectorised prediction."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass
class Tree:
    """Node n splits on ``feature[n]`` at ``limit[n]`` (up to the limit goes left); a leaf has feature -1."""

    feature: np.ndarray
    limit: np.ndarray
    left: np.ndarray
    right: np.ndarray
    share: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), dtype=np.int64)
        while True:
            inner = np.flatnonzero(self.feature[node] >= 0)
            if not len(inner):
                return self.share[node]
            at = node[inner]
            node[inner] = np.where(x[inner, self.feature[at]] <= self.limit[at], self.left[at], self.right[at])


def _split(x: np.ndarray, y: np.ndarray, features: np.ndarray, least: int):
    """The feature and limit with the lowest impurity after it, or None."""
    best, found = len(y) * y.mean() * (1 - y.mean()) - 1e-9, None
    for f in features:
        order = np.argsort(x[:, f], kind="stable")
        values, ones = x[order, f], np.cumsum(y[order])
        n = np.arange(1, len(y))
        cuts = np.flatnonzero((values[1:] > values[:-1]) & (n >= least) & (len(y) - n >= least))
        if not len(cuts):
            continue
        n, left, right = n[cuts], ones[cuts], ones[-1] - ones[cuts]
        impurity = left * (1 - left / n) + right * (1 - right / (len(y) - n))
        at = impurity.argmin()
        if impurity[at] < best:
            best, found = impurity[at], (f, (values[cuts[at]] + values[cuts[at] + 1]) / 2)
    return found


def _grow(x: np.ndarray, y: np.ndarray, draw: np.random.Generator, depth: int, least: int, tried: int) -> Tree:
    nodes: list[list] = []

    def add(rows: np.ndarray, level: int) -> int:
        number = len(nodes)
        nodes.append([-1, 0.0, 0, 0, y[rows].mean()])
        if level < depth and len(rows) >= 2 * least and 0 < y[rows].sum() < len(rows):
            cut = _split(x[rows], y[rows], draw.permutation(x.shape[1])[:tried], least)
            if cut is not None:
                low = x[rows, cut[0]] <= cut[1]
                nodes[number][:2] = cut
                nodes[number][2:4] = add(rows[low], level + 1), add(rows[~low], level + 1)
        return number

    add(np.arange(len(y)), 0)
    columns = list(zip(*nodes))
    return Tree(*(np.array(c, dtype=np.int64 if n in (0, 2, 3) else np.float64) for n, c in enumerate(columns)))


@dataclass
class Forest:
    trees: list[Tree]

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Mean share of class 1."""
        return np.mean([t.predict(x) for t in self.trees], axis=0) if len(x) else np.zeros(0)


def train(x: np.ndarray, y: np.ndarray, trees: int = 40, depth: int = 12, least: int = 2, seed: int = 5) -> Forest:
    draw = np.random.default_rng(seed)
    tried = max(1, round(np.sqrt(x.shape[1])) + 1)
    out = []
    for _ in range(trees):
        rows = draw.integers(0, len(y), len(y))
        out.append(_grow(x[rows], y[rows].astype(np.float64), draw, depth, least, tried))
    return Forest(out)
