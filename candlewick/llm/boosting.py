"""Small gradient-boosted trees for binary labels, with calibrated chances."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Tree:
    """Complete binary tree in arrays; an inner node sends rows with feature <= cut to the left."""

    feature: np.ndarray
    cut: np.ndarray
    value: np.ndarray  # of the leaves

    def predict(self, x: np.ndarray) -> np.ndarray:
        node = np.zeros(len(x), np.int64)
        while len(node) and node[0] < len(self.feature):
            right = x[np.arange(len(x)), self.feature[node]] > self.cut[node]
            node = 2 * node + 1 + right
        return self.value[node - len(self.feature)]


def _best_split(sums: np.ndarray, cuts: list[np.ndarray], l2: float) -> tuple[int, float, np.ndarray]:
    """(feature, cut, sums of the left side) of a node with the given sums of gradients by feature and bin."""
    whole = sums[0].sum(axis=0)
    best, where = 1e-9, (0, np.inf, whole)
    for k, values in enumerate(cuts):
        left = np.cumsum(sums[k, : len(values)], axis=0)
        gl, hl = left.T
        gain = gl**2 / (hl + l2) + (whole[0] - gl) ** 2 / (whole[1] - hl + l2) - whole[0] ** 2 / (whole[1] + l2)
        if len(gain) and gain.max() > best:
            at = int(np.argmax(gain))
            best, where = gain[at], (k, float(values[at]), left[at])
    return where


@dataclass
class Boosted:
    trees: list[Tree]
    base: float
    slope: float = 1.0
    offset: float = 0.0

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.trees:
            out += tree.predict(x)
        return out

    def chance_of(self, margin: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * margin + self.offset)

    def chance(self, x: np.ndarray) -> np.ndarray:
        return self.chance_of(self.margin(x))


#: What is summed is rounded to multiples of this, so that sums below 2**21 are exact and do not depend on the order of rows.
GRID = 2.0**-32
BINS = 33
DEPTH = 3


def exact(values: np.ndarray, weight: np.ndarray, times: np.ndarray) -> np.ndarray:
    """The weighted values, on the grid, of rows that stand for so many each."""
    return np.rint(values * weight / GRID) * times * GRID


@dataclass
class Rows:
    """Distinct examples: features, label, weight of one, how many there are."""

    x: np.ndarray
    y: np.ndarray
    weight: np.ndarray
    times: np.ndarray
    margin: np.ndarray | None = None
    trees: int = 0

    def margin_of(self, model: Boosted) -> np.ndarray:
        """The margins; only trees that are new since the last call are asked."""
        if self.margin is None:
            self.margin = np.full(len(self.x), model.base)
        for tree in model.trees[self.trees :]:
            self.margin = self.margin + tree.predict(self.x)
        self.trees = len(model.trees)
        return self.margin


def level_sums(rows: Rows, model: Boosted, feature: np.ndarray, cut: np.ndarray, level: int, cuts: list[np.ndarray]) -> np.ndarray:
    """Sums of the two gradients by node of a level, feature and bin, for a tree that is grown down to that level."""
    p = _sigmoid(rows.margin_of(model))
    g, h = exact(p - rows.y, rows.weight, rows.times), exact(p * (1 - p), rows.weight, rows.times)
    node = np.zeros(len(p), np.int64)
    for _ in range(level):
        node = 2 * node + 1 + (rows.x[np.arange(len(p)), feature[node]] > cut[node])
    node -= 2**level - 1
    out = np.zeros((2**level, len(cuts), BINS, 2))
    for k, values in enumerate(cuts):
        place = node * BINS + np.searchsorted(values, rows.x[:, k], side="left")
        for i, part in enumerate((g, h)):
            out[:, k, :, i] = np.bincount(place, part, 2**level * BINS).reshape(-1, BINS)
    return out


def grow(sums: Callable, cuts: list[np.ndarray], base: float, rounds: int = 40, depth: int = DEPTH, rate: float = 0.3, l2: float = 1.0) -> Boosted:
    """Trees from sums(model, feature, cut, level) alone, which are those of level_sums over all rows, wherever these are."""
    model = Boosted([], base)
    inner = 2**depth - 1
    for _ in range(rounds):
        feature, cut = np.zeros(inner, np.int64), np.full(inner, np.inf)
        for level in range(depth):
            sides = []
            for at, of_node in enumerate(sums(model, feature, cut, level), 2**level - 1):
                feature[at], cut[at], left = _best_split(of_node, cuts, l2)
                sides += [left, of_node[0].sum(axis=0) - left]
        g, h = np.array(sides).T
        model.trees.append(Tree(feature, cut, -rate * g / (h + l2)))
    return model


def base_of(share: float) -> float:
    share = float(np.clip(share, 1e-3, 1 - 1e-3))
    return float(np.log(share / (1 - share)))


def cuts_of(values: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The lower quantiles at 32 steps of ascending values with weights."""
    ends = np.cumsum(weight)
    if not len(ends) or ends[-1] <= 0:
        return np.zeros(0)
    at = np.floor(np.linspace(0, 1, BINS)[:-1] * max(ends[-1] - 1, 0))
    return np.unique(values[np.minimum(np.searchsorted(ends, at, side="right"), len(ends) - 1)])


def fit(x: np.ndarray, y: np.ndarray, rounds: int = 40, depth: int = DEPTH, rate: float = 0.3, l2: float = 1.0) -> Boosted:
    """Logistic loss, second-order leaves, cuts at up to 32 quantiles of each feature."""
    base = base_of(y.mean() if len(y) else 0.5)
    if not len(y) or y.min() == y.max():
        return Boosted([], base)
    rows = Rows(x, y, np.ones(len(y)), np.ones(len(y)))
    cuts = [cuts_of(*np.unique(x[:, k], return_counts=True)) for k in range(x.shape[1])]
    return grow(lambda *at: level_sums(rows, *at, cuts), cuts, base, rounds, depth, rate, l2)


def calibrate(model: Boosted, x: np.ndarray, y: np.ndarray, steps: int = 50) -> Boosted:
    """Fit slope and offset of the chances on rows that the trees have not seen."""
    return calibrate_margins(model, model.margin(x), y, np.ones(len(y)), steps)


def calibrate_margins(model: Boosted, m: np.ndarray, y: np.ndarray, weight: np.ndarray, steps: int = 50) -> Boosted:
    """Fit slope and offset to margins with labels and weights, by Newton steps with priors."""
    if not weight.sum():
        return model
    right, wrong = (weight * y).sum(), (weight * (1 - y)).sum()
    target = np.where(y > 0, (right + 1) / (right + 2), 1 / (wrong + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = _sigmoid(a * m + b)
        w = weight * (p * (1 - p) + 1e-9)
        off = weight * (p - target)
        g = np.array([(off * m).sum() + 1e-3 * (a - 1), off.sum() + 1e-3 * b])
        hess = np.array([[(w * m * m).sum() + 1e-3, (w * m).sum()], [(w * m).sum(), w.sum() + 1e-3]])
        step = np.linalg.solve(hess, g)
        a, b = float(np.clip(a - step[0], 0.05, 5)), float(np.clip(b - step[1], -10, 10))
        if np.abs(step).max() < 1e-6:
            break
    model.slope, model.offset = a, b
    return model


def threshold_for(
    chances: np.ndarray, y: np.ndarray, precision: float, least: float = 0.5, weight: np.ndarray | None = None, halfway: bool = False
) -> float:
    """The lowest threshold, not below `least`, at which the given share of what it selects is right. Any threshold down to
    the next chance selects the same; `halfway` takes the middle between the two."""
    weight = np.ones(len(y)) if weight is None else weight
    order = np.argsort(-chances, kind="stable")
    chances, selected = chances[order], np.cumsum(weight[order])
    right = np.cumsum((weight * y)[order])
    last = np.append(chances[1:] != chances[:-1], True)[: len(y)]  # what has the same chance is selected together
    good = np.flatnonzero(last & (selected > 0) & (right >= precision * selected))
    if not len(good):
        return max(least, 1.1)
    found = float(chances[good[-1]])
    if halfway:
        lower = float(chances[good[-1] + 1]) if good[-1] + 1 < len(chances) else 0.0
        found = (found + lower) / 2
    return max(least, found)
