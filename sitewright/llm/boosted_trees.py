"""Gradient-boosted trees on binned features for logistic loss, and calibration of their margins, as plain arrays."""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 64


@dataclass
class Trees:
    """Complete binary trees of one depth: ``feature`` and ``cut`` per inner node (rows with value > cut go right), ``leaf`` per leaf."""

    base: float
    feature: np.ndarray
    cut: np.ndarray
    leaf: np.ndarray

    def margins(self, x: np.ndarray) -> np.ndarray:
        out, rows = np.full(len(x), self.base), np.arange(len(x))
        inner = self.feature.shape[1]
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf):
            node = np.zeros(len(x), np.int64)
            while len(node) and node[0] < inner:
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - inner]
        return out


def boost(x: np.ndarray, y: np.ndarray, w: np.ndarray, *, rounds: int = 60, depth: int = 4, rate: float = 0.2, l2: float = 1.0,
          least: float = 2.0) -> Trees:
    """Fit on rows ``x`` with labels 0/1 and weights; a split needs ``least`` weight on both sides and a positive gain."""
    edges = [np.unique(np.quantile(c, np.linspace(0, 1, BINS)[:-1], method="lower")) for c in x.T]
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], 1)
    p = (w @ y + 1) / (w.sum() + 2)
    base = float(np.log(p / (1 - p)))
    margin, inner, rows = np.full(len(x), base), (1 << depth) - 1, np.arange(len(x))
    features, cuts, leaves = (np.zeros((rounds, n), t) for n, t in ((inner, np.int64), (inner, float), (inner + 1, float)))
    for r in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (y - p), w * p * (1 - p)
        node = np.zeros(len(x), np.int64)
        for level in range(depth):
            first, width = (1 << level) - 1, 1 << level
            best = np.zeros(width)
            features[r, first:first + width], cuts[r, first:first + width] = 0, np.inf
            for f, e in enumerate(edges):
                slot, shape = (node - first) * (BINS + 1) + binned[:, f], (width, BINS + 1)
                left = [np.bincount(slot, v, minlength=width * (BINS + 1)).reshape(shape).cumsum(1) for v in (g, h, w)]
                right = [v[:, -1:] - v for v in left]
                gain = left[0] ** 2 / (left[1] + l2) + right[0] ** 2 / (right[1] + l2) - left[0][:, -1:] ** 2 / (left[1][:, -1:] + l2)
                gain = np.where((left[2] >= least) & (right[2] >= least), gain, 0)[:, :len(e)]
                at = gain.argmax(1)
                better = np.flatnonzero(gain[np.arange(width), at] > best + 1e-9)
                best[better] = gain[better, at[better]]
                features[r, first + better], cuts[r, first + better] = f, e[at[better]]
            node = 2 * node + 1 + (x[rows, features[r, node]] > cuts[r, node])
        at = node - inner
        leaves[r] = rate * np.bincount(at, g, minlength=inner + 1) / (np.bincount(at, h, minlength=inner + 1) + l2)
        margin += leaves[r, at]
    return Trees(base, features, cuts, leaves)


def calibrate(margin: np.ndarray, y: np.ndarray, w: np.ndarray, steps: int = 50) -> tuple[float, float]:
    """Slope and offset of the log odds of label 1 over the margin, fitted to targets that are drawn in a little from 0 and 1.

    Without rows of both labels the slope is 0 and the offset minus infinity: nothing is known to be likely."""
    up, down = float(w @ y), float(w @ (1 - y))
    if not up or not down:
        return 0.0, -np.inf
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    design = np.stack([margin, np.ones(len(margin))], 1)
    b = np.array([1.0, 0.0])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ b, -30, 30)))
        hessian = (design * (w * p * (1 - p))[:, None]).T @ design + 1e-3 * np.eye(2)
        step = np.linalg.solve(hessian, design.T @ (w * (target - p)) - 1e-3 * (b - [1.0, 0.0]))
        b = b + step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
    return max(float(b[0]), 1e-6), float(b[1])
