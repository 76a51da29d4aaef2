"""Gradient-boosted trees for a few classes, on bounded samples: histograms in numpy, trees of fixed depth."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

BINS = 48


@dataclass
class Trees:
    """Complete binary trees, one per round and class: inner nodes by level, then leaves."""

    feature: np.ndarray  # (rounds, classes, 2 ** depth - 1)
    border: np.ndarray  # go right where the value exceeds it
    leaf: np.ndarray  # (rounds, classes, 2 ** depth)
    start: np.ndarray

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        rounds, classes, inner = self.feature.shape
        score = np.tile(self.start, (len(x), 1))
        row = np.arange(len(x))
        for r in range(rounds):
            for c in range(classes):
                at = np.zeros(len(x), np.int64)
                feature, border = self.feature[r, c], self.border[r, c]
                while len(at) and at[0] < inner:
                    at = 2 * at + 1 + (x[row, feature[at]] > border[at])
                score[:, c] += self.leaf[r, c][at - inner]
        return score

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        score = self.log_odds(x)
        score -= score.max(axis=1, keepdims=True)
        return score - np.log(np.exp(score).sum(axis=1, keepdims=True))


def boost(x: np.ndarray, y: np.ndarray, classes: int, *, rounds: int = 40, depth: int = 4, rate: float = 0.25, ridge: float = 2.0) -> Trees:
    """Fit by second-order steps on the softmax loss; ``y`` holds class numbers."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(edges[f], x[:, f], "left") for f in range(width)], axis=1)
    cells = binned + np.arange(width) * BINS
    inner = (1 << depth) - 1
    shape = (rounds, classes)
    out = Trees(np.zeros((*shape, inner), np.int64), np.full((*shape, inner), np.inf), np.zeros((*shape, inner + 1)), np.zeros(classes))
    out.start = np.log((np.bincount(y, minlength=classes) + 1) / (n + classes))
    score = np.tile(out.start, (n, 1))
    for r in range(rounds):
        p = np.exp(score - score.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        for c in range(classes):
            g, h = p[:, c] - (y == c), p[:, c] * (1 - p[:, c]) + 1e-9
            at = np.zeros(n, np.int64)
            for level in range(depth):
                first, many = (1 << level) - 1, 1 << level
                keys = ((at - first)[:, None] * (width * BINS) + cells).ravel()
                size = many * width * BINS
                sums = [np.bincount(keys, np.repeat(v, width), size).reshape(many, width, BINS).cumsum(axis=2) for v in (g, h)]
                (gl, hl), (ga, ha) = sums, [s[:, :, -1:] for s in sums]
                gain = gl**2 / (hl + ridge) + (ga - gl) ** 2 / (ha - hl + ridge) - ga**2 / (ha + ridge)
                gain[(hl < 0.5) | (ha - hl < 0.5)] = 0
                for f in range(width):
                    gain[:, f, len(edges[f]) :] = 0
                best = gain.reshape(many, -1).argmax(axis=1)
                for node in range(many):
                    f, b = divmod(int(best[node]), BINS)
                    if gain[node, f, b] > 1e-6:
                        out.feature[r, c, first + node], out.border[r, c, first + node] = f, edges[f][b]
                at = 2 * at + 1 + (x[np.arange(n), out.feature[r, c][at]] > out.border[r, c][at])
            leaf = at - inner
            steps = -rate * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + ridge)
            out.leaf[r, c] = steps
            score[:, c] += steps[leaf]
    return out
