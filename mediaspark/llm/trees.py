"""Gradient-boosted trees for two classes: fitted on a bounded sample, flattened into numpy node arrays.

Scoring walks all trees of all rows at once over the flat arrays. A feature may be held to a
direction: its splits never let the score move the other way, also further down the tree, because
children inherit bounds on their values. Missing values are not expected; features are finite.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class Forest:
    """Node arrays of all trees; a leaf points to itself, so walking a fixed number of steps is enough."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    depth: int
    base: float

    def raw(self, rows: np.ndarray) -> np.ndarray:
        """Log-odds of class 1 for each row."""
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots)))
        each = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            at = np.where(rows[each, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
        return self.base + self.value[at].sum(axis=1)

    def probability(self, rows: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.raw(rows)))


def constant(probability: float) -> Forest:
    """A forest without trees, for samples that have one class only."""
    odds = float(np.clip(probability, 1e-6, 1 - 1e-6))
    none = np.zeros(0, np.int64)
    return Forest(none, none.astype(float), none, none, none.astype(float), none, 0, float(np.log(odds / (1 - odds))))


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    *,
    rounds: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    bins: int = 64,
    least: int = 20,
    ridge: float = 1.0,
    directions: tuple[int, ...] | None = None,
) -> Forest:
    """Boost ``rounds`` trees on histograms of ``bins`` quantiles; ``directions`` has 1, -1 or 0 for each feature."""
    if not len(labels) or labels.min() == labels.max():
        return constant(float(labels.mean()) if len(labels) else 0.5)
    features = rows.shape[1]
    held = np.zeros(features) if directions is None else np.asarray(directions, float)
    edges = [np.unique(np.quantile(rows[:, j], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for j in range(features)]
    binned = np.stack([np.searchsorted(edges[j], rows[:, j], side="left") for j in range(features)], axis=1)
    base = float(np.log(labels.mean() / (1 - labels.mean())))
    score = np.full(len(labels), base)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-score))
        slope, curve = p - labels, p * (1 - p)
        roots.append(len(nodes))
        nodes.append([0, np.inf, len(nodes), len(nodes), 0.0])
        at = np.full(len(labels), roots[-1])
        bounds = {roots[-1]: (-np.inf, np.inf)}
        open_nodes = [roots[-1]]
        for _ in range(depth):
            open_nodes = _split(open_nodes, at, binned, slope, curve, edges, bounds, nodes, bins, least, ridge, held)
        for node, (low, high) in bounds.items():
            mine = at == node
            if nodes[node][2] == node and mine.any():
                nodes[node][4] = rate * float(np.clip(-slope[mine].sum() / (curve[mine].sum() + ridge), low, high))
        score += np.array([n[4] for n in nodes])[at]
    table = np.array(nodes, dtype=float)
    whole = table[:, [0, 2, 3]].astype(np.int64)
    return Forest(whole[:, 0], table[:, 1], whole[:, 1], whole[:, 2], table[:, 4], np.array(roots), depth, base)


def _split(open_nodes, at, binned, slope, curve, edges, bounds, nodes, bins, least, ridge, held) -> list[int]:
    """Split each open node at its best place, move its rows, and give the new nodes."""
    made: list[int] = []
    for node in open_nodes:
        mine = np.flatnonzero(at == node)
        if len(mine) < 2 * least:
            continue
        low, high = bounds[node]
        g, h, own = slope[mine], curve[mine], binned[mine]
        best = (1e-9, -1, -1, 0.0, 0.0)
        for j, cuts in enumerate(edges):
            if not len(cuts):
                continue
            size = len(cuts) + 1
            count, gs, hs = (np.bincount(own[:, j], weights=w, minlength=size).cumsum() for w in (None, g, h))
            n_left, g_left, h_left = count[:-1], gs[:-1], hs[:-1]
            g_right, h_right = gs[-1] - g_left, hs[-1] - h_left
            v_left = np.clip(-g_left / (h_left + ridge), low, high)
            v_right = np.clip(-g_right / (h_right + ridge), low, high)
            gain = g_left**2 / (h_left + ridge) + g_right**2 / (h_right + ridge) - gs[-1] ** 2 / (hs[-1] + ridge)
            barred = (n_left < least) | (count[-1] - n_left < least) | (held[j] * (v_right - v_left) < 0)
            gain[barred] = -np.inf
            cut = int(gain.argmax())
            if gain[cut] > best[0]:
                best = (float(gain[cut]), j, cut, float(v_left[cut]), float(v_right[cut]))
        _, j, cut, v_left, v_right = best
        if j < 0:
            continue
        left, right = len(nodes), len(nodes) + 1
        nodes += [[0, np.inf, left, left, 0.0], [0, np.inf, right, right, 0.0]]
        nodes[node][:4] = [j, float(edges[j][cut]), left, right]
        middle = (v_left + v_right) / 2
        bounds[left] = (low, min(high, middle)) if held[j] > 0 else (max(low, middle), high) if held[j] < 0 else (low, high)
        bounds[right] = (max(low, middle), high) if held[j] > 0 else (low, min(high, middle)) if held[j] < 0 else (low, high)
        at[mine] = np.where(own[:, j] <= cut, left, right)
        made += [left, right]
    return made


def isotonic(scores: np.ndarray, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: a rising step function from score to share of label 1, as points for np.interp."""
    order = np.argsort(scores, kind="stable")
    blocks: list[list[float]] = []  # lowest and highest score, sum of labels, rows
    for x, y in zip(scores[order], labels[order], strict=True):
        blocks.append([x, x, y, 1.0])
        while len(blocks) > 1 and (blocks[-2][2] * blocks[-1][3] >= blocks[-1][2] * blocks[-2][3] or blocks[-2][1] == blocks[-1][0]):
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0], last[1], blocks[-1][2] + last[2], blocks[-1][3] + last[3]]
    # a pseudo-row of each class keeps pure blocks off 0 and 1
    points = [(x, (b[2] + 0.5) / (b[3] + 1)) for b in blocks for x in b[:2]]
    at, level = (np.array(v) for v in zip(*points, strict=True))
    return at, np.maximum.accumulate(level)
