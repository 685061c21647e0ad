"""Histogram gradient-boosted trees in numpy: fitted on binned columns, kept as flat arrays.

Fitting bins every column once, at quantiles, and then only adds up gradients by bin: one
`bincount` a level gives the histograms of all nodes and columns. A fitted forest is four
flat arrays over the nodes of all trees; rows walk down all trees at once, level by level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


@dataclass
class Forest:
    """Trees in flat arrays.

    A row at node i goes to `below[i]` if its column `column[i]` is at most `cut[i]`, else to
    `below[i] + 1`; a leaf is below itself, and adds `value[i]`. `roots` are the trees' first
    nodes, `base` is what all rows begin with, `height` how many steps suffice.
    """

    column: np.ndarray
    cut: np.ndarray
    below: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    base: float
    height: int

    def margins(self, x: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        rows = np.arange(len(x))[:, None]
        for _ in range(self.height):
            right = x[rows, self.column[at]] > self.cut[at]
            at = self.below[at] + (right & (self.below[at] != at))
        return self.base + self.value[at].sum(1)

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row of `x`."""
        return sigmoid(self.margins(x))


def cuts(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """Cut points per column: at most `bins - 1` quantiles, between values that differ."""
    out = []
    for column in x.T:
        values = np.unique(column)
        middles = (values[:-1] + values[1:]) / 2
        if len(middles) >= bins:
            places = np.quantile(column, np.arange(1, bins) / bins)
            middles = np.unique(middles[np.minimum(np.searchsorted(middles, places), len(middles) - 1)])
        out.append(middles)
    return out


def fit(
    x: np.ndarray,
    y: np.ndarray,
    trees: int = 120,
    height: int = 4,
    rate: float = 0.1,
    bins: int = 64,
    least: float = 2.0,
    ridge: float = 1.0,
) -> Forest:
    """Boosted trees for labels 0 and 1 by logistic loss.

    A split must leave each side `least` in second derivatives (four times as many undecided
    rows). Of equally good splits the first column's lowest cut wins, so a fit depends on
    nothing but its rows. With one label only, or no rows, the forest has no trees.
    """
    share = float(y.mean()) if len(y) else 0.5
    base = float(np.log(min(max(share, 1e-3), 1 - 1e-3) / (1 - min(max(share, 1e-3), 1 - 1e-3))))
    empty = np.empty(0, np.int64)
    if not 0 < share < 1:
        return Forest(empty, np.empty(0), empty, np.empty(0), empty, base, 0)
    edges = cuts(x, bins)
    width = max(map(len, edges)) + 1
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], 1)
    flat = binned + np.arange(x.shape[1]) * width
    # Cuts that a column doesn't have can't be chosen.
    exists = np.arange(width)[None, :] < np.array([[len(e)] for e in edges])
    column, cut, below, value, roots = [], [], [], [], []
    margin = np.full(len(y), base)
    for _ in range(trees):
        p = sigmoid(margin)
        g, h = p - y, np.maximum(p * (1 - p), 1e-9)
        first = len(column)
        roots.append(first)
        node = np.zeros(len(y), np.int64)  # number among the open nodes of the level; -1: in a leaf
        open_ids = [first]
        for name in (column, cut, below, value):
            name.append(0)
        below[first] = first
        ends = np.full(len(y), first)
        for _ in range(height):
            inside = np.flatnonzero(node >= 0)
            keys = (node[inside, None] * x.shape[1] * width + flat[inside]).ravel()
            size, shape = len(open_ids) * x.shape[1] * width, (len(open_ids), x.shape[1], width)
            gs, hs = (
                np.bincount(keys, np.repeat(w[inside], x.shape[1]), size).reshape(shape).cumsum(2) for w in (g, h)
            )
            total_g, total_h = gs[:, :1, -1:], hs[:, :1, -1:]
            right_g, right_h = total_g - gs, total_h - hs
            gain = gs**2 / (hs + ridge) + right_g**2 / (right_h + ridge) - total_g**2 / (total_h + ridge)
            gain = np.where(exists[None] & (hs >= least) & (right_h >= least), gain, -1.0).reshape(len(open_ids), -1)
            best = gain.argmax(1)
            moved = np.full(len(open_ids), -1)
            following: list[int] = []
            for k, i in enumerate(open_ids):
                if gain[k, best[k]] > 1e-9:
                    c, b = divmod(int(best[k]), width)
                    column[i], cut[i], below[i] = c, float(edges[c][b]), len(column)
                    moved[k] = len(following)
                    for child in (len(column), len(column) + 1):
                        following.append(child)
                        column.append(0), cut.append(0.0), below.append(child), value.append(0.0)
            if not following:
                break
            ids = np.array(open_ids)
            go = inside[moved[node[inside]] >= 0]
            at = ids[node[go]]
            right = x[go, np.array(column)[at]] > np.array(cut)[at]
            ends[go] = np.array(below)[at] + right
            following_of = moved[node[go]] + right
            node = np.full(len(y), -1)
            node[go] = following_of
            open_ids = following
        sum_g, sum_h = (np.bincount(ends - first, w, len(column) - first) for w in (g, h))
        steps = -rate * sum_g / (sum_h + ridge)
        for i in range(first, len(column)):
            value[i] = float(steps[i - first]) if below[i] == i else 0.0
        margin = margin + steps[ends - first]
    return Forest(
        np.array(column), np.array(cut, float), np.array(below), np.array(value, float), np.array(roots), base, height
    )
