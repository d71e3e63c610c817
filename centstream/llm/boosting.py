"""Gradient-boosted trees and isotonic calibration on a bounded matrix, with numpy."""

from dataclasses import dataclass, field

import numpy as np

BINS = 64


@dataclass
class Trees:
    """Boosted trees of equal depth; a row goes right where its value is above the cut."""

    base: float
    feature: np.ndarray  # (trees, inner nodes)
    cut: np.ndarray
    leaf: np.ndarray  # (trees, leaves)
    knots: np.ndarray = field(default_factory=lambda: np.zeros(0))
    levels: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def margin(self, x: np.ndarray) -> np.ndarray:
        depth = int(np.log2(self.leaf.shape[1])) if len(self.leaf) else 0
        out = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, cut, leaf in zip(self.feature, self.cut, self.leaf, strict=True):
            node = np.zeros(len(x), np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (x[rows, feature[node]] > cut[node])
            out += leaf[node - (len(leaf) - 1)]
        return out

    def score(self, x: np.ndarray) -> np.ndarray:
        """Calibrated probability; where it is flat, the margin still ranks a little."""
        margin = self.margin(x)
        plain = 1 / (1 + np.exp(-margin))
        if not len(self.knots):
            return plain
        return np.clip(0.999 * np.interp(margin, self.knots, self.levels) + 0.001 * plain, 0, 1)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def fit(
    x: np.ndarray, y: np.ndarray, trees: int = 80, depth: int = 3, rate: float = 0.15,
    least: float = 1.0, shrink: float = 1.0,
) -> Trees:
    """Logistic boosting over histograms of at most ``BINS`` values per column."""
    n, columns = x.shape
    share = np.clip(y.mean() if n else 0.0, 1e-4, 1 - 1e-4)
    base = float(np.log(share / (1 - share)))
    inner, leaves = 2**depth - 1, 2**depth
    made = Trees(base, np.zeros((0, inner), np.int64), np.zeros((0, inner)), np.zeros((0, leaves)))
    if n == 0 or y.min() == y.max():
        return made
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(columns)]
    binned = np.stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)], 1)
    margin = np.full(n, base)
    features, cuts, values = [], [], []
    offset = np.arange(columns) * BINS
    for _ in range(trees):
        p = _sigmoid(margin)
        gradient, weight = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            first, count = 2**level - 1, 2**level
            place = ((node - first)[:, None] * columns * BINS + offset + binned).ravel()
            size = count * columns * BINS
            g = np.bincount(place, np.repeat(gradient, columns), size)
            h = np.bincount(place, np.repeat(weight, columns), size)
            g, h = (a.reshape(count, columns, BINS).cumsum(2) for a in (g, h))
            all_g, all_h = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + shrink) + (all_g - g) ** 2 / (all_h - h + shrink)
            gain -= all_g**2 / (all_h + shrink)
            gain[(h < least) | (all_h - h < least)] = 0
            best = gain.reshape(count, -1).argmax(1)
            for k in range(count):
                j, b = divmod(int(best[k]), BINS)
                if gain[k, j, b] > 1e-9 and b < len(edges[j]):
                    feature[first + k], cut[first + k] = j, edges[j][b]
            node = 2 * node + 1 + (x[np.arange(n), feature[node]] > cut[node])
        at = node - inner
        leaf = -rate * np.bincount(at, gradient, leaves) / (np.bincount(at, weight, leaves) + shrink)
        margin += leaf[at]
        features.append(feature)
        cuts.append(cut)
        values.append(leaf)
    made.feature, made.cut, made.leaf = np.array(features), np.array(cuts), np.array(values)
    return made


def isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots and levels of the non-decreasing fit of ``y`` by pooled neighbours.

    Every pool counts a positive and a negative half beside its own rows, so that no level
    is 0 or 1.
    """
    order = np.argsort(margin, kind="stable")
    pools: list[list[float]] = []  # sum of y, rows, sum of margins
    for m, v in zip(margin[order].tolist(), y[order].tolist(), strict=True):
        pools.append([v, 1.0, m])
        while len(pools) > 1 and pools[-2][0] / pools[-2][1] >= pools[-1][0] / pools[-1][1]:
            top = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], top, strict=True)]
    knots = np.array([p[2] / p[1] for p in pools])
    levels = np.maximum.accumulate(np.array([(p[0] + 0.5) / (p[1] + 1) for p in pools]))
    return knots, levels


def fit_calibrated(x: np.ndarray, y: np.ndarray, fold: np.ndarray, **options) -> Trees:
    """Trees on all rows, calibrated on margins of trees that did not see the row's fold."""
    made = fit(x, y, **options)
    if not len(made.leaf):
        return made
    margin = np.zeros(len(y))
    for k in np.unique(fold):
        margin[fold == k] = fit(x[fold != k], y[fold != k], **options).margin(x[fold == k])
    made.knots, made.levels = isotonic(margin, y)
    return made
