"""Gradient-boosted trees for two classes over small feature matrices (numpy)."""

from __future__ import annotations

import numpy as np


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60)))


class Trees:
    """Complete trees of fixed depth, fitted to the logistic loss with second-order leaf values."""

    def __init__(self, x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 32, penalty: float = 1.0):
        self.depth, self.nodes = depth, 2**depth - 1
        cuts = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T, strict=True)], 1)
        mean = np.clip(y.mean(), 1e-6, 1 - 1e-6)
        self.start = float(np.log(mean / (1 - mean)))
        score = np.full(len(y), self.start)
        self.features, self.limits, self.leaves = [], [], []
        for _ in range(rounds):
            p = _sigmoid(score)
            slope, curve = p - y, np.maximum(p * (1 - p), 1e-6)
            place = np.zeros(len(y), np.int64)
            feature, limit = np.zeros(self.nodes, np.int32), np.full(self.nodes, np.inf)
            for level in range(depth):
                base = 2**level - 1
                best = np.zeros(2**level)
                cut_at = np.full(2**level, bins + 1)
                for f in range(x.shape[1]):
                    if not len(cuts[f]):
                        continue
                    key = place * (bins + 1) + binned[:, f]
                    shape = (2**level, bins + 1)
                    g = np.bincount(key, slope, minlength=shape[0] * shape[1]).reshape(shape).cumsum(1)
                    h = np.bincount(key, curve, minlength=shape[0] * shape[1]).reshape(shape).cumsum(1)
                    total_g, total_h = g[:, -1:], h[:, -1:]
                    gain = g**2 / (h + penalty) + (total_g - g) ** 2 / (total_h - h + penalty) - total_g**2 / (total_h + penalty)
                    gain[:, len(cuts[f]) :] = 0
                    k = gain.argmax(1)
                    top = gain[np.arange(len(k)), k]
                    for n in np.flatnonzero(top > best + 1e-9):
                        best[n], cut_at[n] = top[n], k[n]
                        feature[base + n], limit[base + n] = f, cuts[f][k[n]]
                place = place * 2 + (x[np.arange(len(y)), feature[base + place]] > limit[base + place])
            g, h = np.bincount(place, slope, minlength=2**depth), np.bincount(place, curve, minlength=2**depth)
            leaf = -rate * g / (h + penalty)
            score += leaf[place]
            self.features.append(feature)
            self.limits.append(limit)
            self.leaves.append(leaf)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        rows = np.arange(len(x))
        for feature, limit, leaf in zip(self.features, self.limits, self.leaves, strict=True):
            place = np.zeros(len(x), np.int64)
            for level in range(self.depth):
                node = 2**level - 1 + place
                place = place * 2 + (x[rows, feature[node]] > limit[node])
            out += leaf[place]
        return out
