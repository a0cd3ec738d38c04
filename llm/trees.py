"""Gradient-boosted trees on binned features, kept as flat arrays that numpy walks for whole blocks at once."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Boosting:
    rounds: int = 150
    depth: int = 4
    rate: float = 0.1
    bins: int = 64
    skip: int = 3  # each tree leaves out every so manieth feature, a different one each round, so that no few features carry the score; 0 leaves out none
    ridge: float = 1.0
    least_weight: float = 1.0  # of the second derivatives in a leaf
    least_gain: float = 1e-6


@dataclass(frozen=True)
class Trees:
    """Complete binary trees of one depth, a row each; the children of node i are 2i + 1 and 2i + 2.

    A row goes right where its feature is above the threshold; a node that doesn't
    split has an infinite threshold, so its rows go left.
    """

    features: np.ndarray  # int32, trees x inner nodes
    thresholds: np.ndarray  # float64, likewise
    leaves: np.ndarray  # float64, trees x leaves
    base: float

    def margins(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row of features: all trees go down one level at a time."""
        n, trees = len(x), np.arange(len(self.features))
        node = np.zeros((n, len(trees)), dtype=np.int64)
        rows = np.arange(n)[:, None]
        inner = self.features.shape[1] if len(trees) else 0
        for _ in range((inner + 1).bit_length() - 1):
            node = 2 * node + 1 + (x[rows, self.features[trees, node]] > self.thresholds[trees, node])
        return self.base + (self.leaves[trees, node - inner].sum(1) if len(trees) else np.zeros(n))

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(x), -30, 30)))


def bin_edges(x: np.ndarray, bins: int) -> list[np.ndarray]:
    """For each feature, at most bins - 1 thresholds: midpoints between neighbouring values, at even shares of the rows."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > bins:
            values = np.unique(np.quantile(column, np.linspace(0, 1, bins), method="inverted_cdf"))
        out.append((values[1:] + values[:-1]) / 2)
    return out


def fit_trees(x: np.ndarray, y: np.ndarray, how: Boosting = Boosting()) -> Trees:
    """Trees for the log odds of ``y`` (0 or 1), each fitted to the gradient of the log loss by histograms of its features' bins.

    Ties between splits go to the smaller feature, then to the smaller threshold, so
    equal rows give equal trees.  Without rows of both classes there are no trees: the
    base has the share of ones, with one row of each class added.
    """
    n, f = x.shape
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    inner = (1 << how.depth) - 1
    if n == 0 or y.min() == y.max():
        return Trees(np.zeros((0, inner), np.int32), np.zeros((0, inner)), np.zeros((0, inner + 1)), base)
    edges = bin_edges(x, how.bins)
    binned = np.column_stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)])
    flat = binned + np.arange(f) * how.bins  # a cell for each feature and bin
    valid = np.zeros((f, how.bins - 1), dtype=bool)
    for k, e in enumerate(edges):
        valid[k, : len(e)] = True
    margin = np.full(n, base)
    features, thresholds, leaves = [], [], []
    for turn in range(how.rounds):
        open_ = valid & (np.arange(f) % how.skip != turn % how.skip)[:, None] if how.skip and f > 1 else valid
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, np.maximum(p * (1 - p), 1e-12)
        node = np.zeros(n, dtype=np.int64)  # within its level
        feature, threshold = np.zeros(inner, np.int32), np.full(inner, np.inf)
        for d in range(how.depth):
            cells = ((node * (f * how.bins))[:, None] + flat).ravel()
            size = (1 << d) * f * how.bins
            sums = [np.bincount(cells, np.repeat(v, f), size).reshape(1 << d, f, how.bins) for v in (g, h)]
            left_g, left_h = (s.cumsum(2)[:, :, :-1] for s in sums)
            all_g, all_h = (s.sum(2)[:, :, None] for s in sums)
            right_g, right_h = all_g - left_g, all_h - left_h
            gain = left_g**2 / (left_h + how.ridge) + right_g**2 / (right_h + how.ridge) - all_g**2 / (all_h + how.ridge)
            gain[~(open_[None] & (left_h >= how.least_weight) & (right_h >= how.least_weight))] = -np.inf
            gain = gain.reshape(1 << d, -1).round(9)
            best = gain.argmax(1)
            split = gain[np.arange(1 << d), best] > how.least_gain
            at, cut = best // (how.bins - 1), best % (how.bins - 1)
            right = np.zeros(n, dtype=np.int64)
            for k in np.flatnonzero(split).tolist():
                feature[(1 << d) - 1 + k] = at[k]
                threshold[(1 << d) - 1 + k] = edges[at[k]][cut[k]]
                mine = node == k
                right[mine] = binned[mine, at[k]] > cut[k]
            node = 2 * node + right
        leaf = -how.rate * np.bincount(node, g, inner + 1) / (np.bincount(node, h, inner + 1) + how.ridge)
        margin += leaf[node]
        features.append(feature)
        thresholds.append(threshold)
        leaves.append(leaf)
    return Trees(np.array(features), np.array(thresholds), np.array(leaves), base)
