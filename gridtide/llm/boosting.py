"""Histogram gradient-boosted trees, fitted on a bounded sample and applied as flat arrays."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """All trees as arrays: tree t has nodes ``t * nodes`` on, children of node i at 2 i + 1 and 2 i + 2."""

    start: float
    feature: np.ndarray  # -1: a leaf
    limit: np.ndarray
    value: np.ndarray
    trees: int
    depth: int

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Sum of leaf values: all rows walk down one tree together, one level at a time."""
        nodes = (1 << (self.depth + 1)) - 1
        total = np.full(len(rows), self.start)
        every = np.arange(len(rows))
        for tree in range(self.trees):
            base = tree * nodes
            at = np.zeros(len(rows), np.int64)
            for _ in range(self.depth):
                feature = self.feature[base + at]
                right = rows[every, np.maximum(feature, 0)] > self.limit[base + at]
                at = np.where(feature >= 0, 2 * at + 1 + right, at)
            total += self.value[base + at]
        return total

    def score(self, rows: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.raw(rows), -30, 30)))


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    trees: int = 60,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    least_rows: int = 20,
    ridge: float = 1.0,
) -> Forest:
    """Boosted logistic loss; each split is the best over histograms of at most ``bins`` bins per feature.

    One class or no rows give no trees, and the smoothed share of ones as the score of everything.
    """
    count = len(labels)
    share = (labels.sum() + 0.5) / (count + 1)
    start = float(np.log(share / (1 - share)))
    nodes = (1 << (depth + 1)) - 1
    if count == 0 or labels.min() == labels.max():
        return Forest(start, np.full(0, -1), np.zeros(0), np.zeros(0), 0, depth)
    width = rows.shape[1]
    cuts = [np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(width)]
    binned = np.stack([np.searchsorted(cuts[f], rows[:, f], side="left") for f in range(width)], axis=1)
    # One number for (feature, bin), so a single bincount gives the histograms of all features.
    cells = binned + np.arange(width) * bins
    feature, limit, value = (np.full(trees * nodes, fill) for fill in (-1, 0.0, 0.0))
    raw = np.full(count, start)
    for tree in range(trees):
        chance = 1.0 / (1.0 + np.exp(-raw))
        slope, bend = labels - chance, chance * (1 - chance)
        members = {0: np.arange(count)}
        for node in range(nodes):
            held = members.pop(node, None)
            if held is None:
                continue
            total, weight = slope[held].sum(), bend[held].sum()
            place = tree * nodes + node
            best, choice = 1e-6, None
            if node < nodes // 2 and len(held) >= 2 * least_rows:
                flat = cells[held].ravel()
                size = width * bins
                sums = [
                    np.bincount(flat, None if of is None else np.repeat(of[held], width), size).reshape(width, bins)
                    for of in (slope, bend, None)
                ]
                left, left_weight, left_rows = (np.cumsum(part, axis=1)[:, :-1] for part in sums)
                gain = (
                    left**2 / (left_weight + ridge)
                    + (total - left) ** 2 / (weight - left_weight + ridge)
                    - total**2 / (weight + ridge)
                )
                enough = (left_rows >= least_rows) & (len(held) - left_rows >= least_rows)
                gain = np.where(enough, gain, -np.inf)
                f, b = np.unravel_index(int(np.argmax(gain)), gain.shape)
                if gain[f, b] > best and b < len(cuts[f]):
                    choice = (int(f), int(b))
            if choice is None:
                value[place] = rate * total / (weight + ridge)
                raw[held] += value[place]
            else:
                f, b = choice
                feature[place], limit[place] = f, cuts[f][b]
                low = binned[held, f] <= b
                members[2 * node + 1], members[2 * node + 2] = held[low], held[~low]
    return Forest(start, feature, limit, value, trees, depth)
