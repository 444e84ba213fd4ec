"""Gradient-boosted trees for two classes on binned features, for a bounded training sample."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 32


@dataclass
class Trees:
    edges: list[np.ndarray]  # per feature, ascending; a value's bin is how many it exceeds
    feature: np.ndarray  # tree x inner node
    bin: np.ndarray  # values of this bin or below go left
    leaf: np.ndarray  # tree x leaf
    base: float

    def predict(self, x: np.ndarray) -> np.ndarray:
        """Log odds per row."""
        used = np.unique(self.feature)
        place = np.zeros(x.shape[1], dtype=np.int64)
        place[used] = np.arange(len(used))
        binned = np.stack([np.searchsorted(self.edges[f], x[:, f], side="left") for f in used], axis=1).astype(np.int16)
        out = np.full(len(x), self.base)
        rows, depth = np.arange(len(x)), int(np.log2(self.leaf.shape[1]))
        for f, b, leaf in zip(place[self.feature], self.bin, self.leaf):
            node = np.zeros(len(x), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (binned[rows, f[node]] > b[node])
            out += leaf[node - (len(leaf) - 1)]
        return out


def fit(x: np.ndarray, y: np.ndarray, weight: np.ndarray, trees: int = 40, depth: int = 4, rate: float = 0.3, l2: float = 1.0) -> Trees:
    """Second-order boosting of the logistic loss with full trees of the given depth."""
    edges = []
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        edges.append(values[:-1] if len(values) <= BINS else np.unique(np.quantile(x[:, f], np.arange(1, BINS) / BINS)))
    live = [f for f in range(x.shape[1]) if len(edges[f])] or [0]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], side="left") for f in live], axis=1)
    flat = (binned + np.arange(len(live)) * BINS).astype(np.int64)
    share = float(np.clip((y * weight).sum() / max(weight.sum(), 1e-9), 1e-3, 1 - 1e-3))
    base = float(np.log(share / (1 - share)))
    score, inner, leaves = np.full(len(y), base), (1 << depth) - 1, 1 << depth
    feature, cut, leaf = np.zeros((trees, inner), np.int64), np.full((trees, inner), BINS, np.int64), np.zeros((trees, leaves))
    for t in range(trees):
        p = 1 / (1 + np.exp(-score))
        g, h = (p - y) * weight, p * (1 - p) * weight
        node = np.zeros(len(y), dtype=np.int64)
        for level in range(depth):
            for k in range((1 << level) - 1, (1 << level + 1) - 1):
                rows = np.flatnonzero(node == k)
                if len(rows) > 1:
                    own = flat[rows].ravel()
                    gs = np.bincount(own, np.repeat(g[rows], len(live)), minlength=len(live) * BINS).reshape(-1, BINS).cumsum(1)
                    hs = np.bincount(own, np.repeat(h[rows], len(live)), minlength=len(live) * BINS).reshape(-1, BINS).cumsum(1)
                    gain = gs**2 / (hs + l2) + (gs[:, -1:] - gs) ** 2 / (hs[:, -1:] - hs + l2) - gs[:, -1:] ** 2 / (hs[:, -1:] + l2)
                    f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
                    if gain[f, b] > 1e-6:
                        feature[t, k], cut[t, k] = live[f], b
                        node[rows] = 2 * k + 1 + (binned[rows, f] > b)
                        continue
                feature[t, k] = live[0]
                node[rows] = 2 * k + 1
        at = node - inner
        leaf[t] = -rate * np.bincount(at, g, minlength=leaves) / (np.bincount(at, h, minlength=leaves) + l2)
        score += leaf[t][at]
    return Trees(edges, feature, cut, leaf, base)
