"""Gradient-boosted trees with monotone features, as flat node arrays.

Second-order boosting on the logistic loss over histograms. Every tree is a complete binary tree
in heap order, so a model is three arrays (feature, threshold, value) and scoring is a handful of
gathers for a whole batch. A feature with sign +1 (-1) can only raise (lower) the score: a split
on it that orders its children the wrong way is not allowed, and the middle of its children's
values bounds all that is below them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Trees:
    """``feature``, ``threshold`` and ``value``: one row per tree, nodes in heap order."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray
    base: float
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log odds of each row of ``x``; a missing value goes left."""
        rows = np.arange(len(x))
        total = np.full(len(x), self.base)
        for feature, threshold, value in zip(self.feature, self.threshold, self.value, strict=True):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > threshold[node])
            total += value[node]
        return total

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -500, 500)))


def _best_split(grad, hess, weight, lo, hi, signs, damping, least):
    """Best (gain, feature, bin, left value, right value) of one node, or None.

    ``grad`` and ``hess`` are histograms, one row per feature; rows with a bin up to the chosen
    one go left.
    """
    gl, hl = np.cumsum(grad, axis=1)[:, :-1], np.cumsum(hess, axis=1)[:, :-1]
    gr, hr = grad.sum(axis=1, keepdims=True) - gl, hess.sum(axis=1, keepdims=True) - hl
    nl = np.cumsum(weight, axis=1)[:, :-1]
    nr = weight.sum(axis=1, keepdims=True) - nl
    vl = np.clip(-gl / (hl + damping), lo, hi)
    vr = np.clip(-gr / (hr + damping), lo, hi)

    def loss(g, h, v):
        return g * v + 0.5 * (h + damping) * v * v

    g, h = grad[0].sum(), hess[0].sum()
    alone = loss(g, h, np.clip(-g / (h + damping), lo, hi))
    gain = alone - loss(gl, hl, vl) - loss(gr, hr, vr)
    allowed = (nl >= least) & (nr >= least) & (signs[:, None] * (vr - vl) >= 0)
    gain = np.where(allowed, gain, -np.inf)
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    if not gain[f, b] > 1e-9:
        return None
    return gain[f, b], f, b, vl[f, b], vr[f, b]


def fit(
    x: np.ndarray,
    y: np.ndarray,
    signs: list[int],
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.2,
    bins: int = 64,
    damping: float = 1.0,
    least: int = 5,
) -> Trees:
    """Trees for labels ``y`` (0 or 1). With one class, or no rows, the model is a constant:
    certain of that class, and in favour of 1 without rows."""
    nodes, inner = 2 ** (depth + 1) - 1, 2**depth - 1
    y = np.asarray(y, dtype=float)
    share = float(np.clip(y.mean(), 1e-6, 1 - 1e-6)) if len(y) else 1 - 1e-6
    base = float(np.log(share / (1 - share)))
    if not len(y) or y.min() == y.max():
        trees = 0
    n, width = x.shape
    sign = np.asarray(signs, dtype=float)
    edges = [
        np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) if n else np.zeros(0)
        for f in range(width)
    ]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1) if n else x
    feature = np.zeros((trees, nodes), dtype=np.int64)
    threshold = np.full((trees, nodes), np.inf)
    value = np.zeros((trees, nodes))
    margin = np.full(n, base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-margin))
        grad, hess = p - y, np.maximum(p * (1 - p), 1e-9)
        node = np.zeros(n, dtype=np.int64)
        low, high = np.full(nodes, -np.inf), np.full(nodes, np.inf)
        value[t, 0] = -grad.sum() / (hess.sum() + damping)
        for k in range(inner):
            left, right = 2 * k + 1, 2 * k + 2
            rows = np.flatnonzero(node == k)
            found = None
            if len(rows) >= 2 * least:
                cells = binned[rows] + np.arange(width) * bins
                shape = (width, bins)
                flat = cells.ravel()
                hist = [
                    np.bincount(flat, np.repeat(v, width), width * bins).reshape(shape)
                    for v in (grad[rows], hess[rows], np.ones(len(rows)))
                ]
                found = _best_split(*hist, low[k], high[k], sign, damping, least)
            low[left] = low[right] = low[k]
            high[left] = high[right] = high[k]
            if found is None:  # all rows go left, where the value stays
                value[t, left] = value[t, right] = value[t, k]
                node[rows] = left
                continue
            _, f, b, vl, vr = found
            feature[t, k], threshold[t, k] = f, edges[f][b] if b < len(edges[f]) else np.inf
            value[t, left], value[t, right] = vl, vr
            middle = (vl + vr) / 2
            if sign[f] > 0:
                high[left] = low[right] = middle
            elif sign[f] < 0:
                low[left] = high[right] = middle
            node[rows] = np.where(binned[rows, f] > b, right, left)
        value[t] *= rate
        margin += value[t, node]
    return Trees(feature, threshold, value, base, depth)
