"""Multiway trees of split points over vectors, searched for the best inner products within windows.

An inner product becomes a distance by one more component: a row ``x`` counts as ``(x, sqrt(m - |x|^2))`` for the largest
squared length ``m``, a query ``q`` as ``(q, 0)``. Then ``distance^2 = |q|^2 + m - 2 q.x``, so that a window of scores
is an annulus around the query, and the triangle inequality holds.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

#: Split points of a node, and rows of a leaf, which are compared one by one.
FAN, LEAF = 8, 256
#: Bounds of a window that has none.
LOWEST, HIGHEST = np.iinfo(np.int64).min, np.iinfo(np.int64).max
#: Relative room for rounding where a subtree is left out.
SLACK = 1e-6


def lifted(rows: np.ndarray, longest: float) -> np.ndarray:
    """Rows with the component that gives all of them the same length."""
    flat = rows.astype(np.float64)
    rest = np.sqrt(np.maximum(longest - (flat * flat).sum(1), 0.0))
    return np.concatenate([flat, rest[:, None]], 1)


def between(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of the rows of ``a`` to those of ``b``."""
    squares = (a * a).sum(1)[:, None] + (b * b).sum(1)[None, :] - 2 * a @ b.T
    return np.sqrt(np.maximum(squares, 0.0))


def far_apart(rows: np.ndarray, number: int) -> np.ndarray:
    """Up to ``number`` rows, each as far from those before it as there is any; equal rows count once."""
    chosen = [int(np.argmax((rows * rows).sum(1) + rows[:, 0]))]
    away = between(rows, rows[chosen])[:, 0]
    while len(chosen) < number and away.max() > 0:
        chosen.append(int(away.argmax()))
        away = np.minimum(away, between(rows, rows[chosen[-1:]])[:, 0])
    return rows[chosen]


def ranges(distances: np.ndarray, child: np.ndarray, children: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance of each split point (row) to the rows of each child (column); empty ones have none."""
    low = np.full((distances.shape[1], children), np.inf)
    high = np.full((distances.shape[1], children), -np.inf)
    for j in np.unique(child):
        own = distances[child == j]
        low[:, j], high[:, j] = own.min(0), own.max(0)
    return low, high


def alive(away: np.ndarray, low: np.ndarray, high: np.ndarray, inner: np.ndarray, outer: np.ndarray, room: float) -> np.ndarray:
    """Which children (columns) may hold rows between ``inner`` and ``outer`` of each query (rows).

    ``away`` are distances of the queries to the split points. No row of a child is nearer than the largest gap
    between ``away`` and the range of a split point, nor farther than the smallest sum.
    """
    nearest = np.full((len(away), low.shape[1]), -np.inf)
    farthest = np.full((len(away), low.shape[1]), np.inf)
    for i in range(len(low)):
        nearest = np.maximum(nearest, np.maximum(away[:, i : i + 1] - high[i], low[i] - away[:, i : i + 1]))
        farthest = np.minimum(farthest, away[:, i : i + 1] + high[i])
    return (nearest <= outer[:, None] + room) & (farthest >= inner[:, None] - room) & np.isfinite(low[0])


@dataclass
class _Node:
    rows: np.ndarray
    points: np.ndarray | None = None
    low: np.ndarray | None = None
    high: np.ndarray | None = None
    children: list[_Node | None] = field(default_factory=list)


class Tree:
    """Rows with ids and labels, split by nearest points down to leaves."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, longest: float, exact: bool):
        """``exact``: scores fit the 53 bits of a double; else they are summed as integers, which is slow."""
        self.ids, self.labels, self.longest, self.exact = ids, labels, longest, exact
        self.rows = rows.astype(np.float64) if exact else rows
        self.lifted = lifted(rows, longest)
        self.room = SLACK * (np.sqrt(longest) + 1)
        self.root = self._split(np.arange(len(ids)))

    def _split(self, rows: np.ndarray) -> _Node:
        if len(rows) <= LEAF:
            return _Node(rows)
        # Split points come from a few rows evenly taken; where they stand concerns speed alone.
        points = far_apart(self.lifted[rows[:: max(1, len(rows) // (8 * FAN))]], FAN)
        distances = between(self.lifted[rows], points)
        child = distances.argmin(1)
        if len(points) < 2 or (child == child[0]).all():
            return _Node(rows)
        low, high = ranges(distances, child, len(points))
        children = [self._split(rows[child == j]) if (child == j).any() else None for j in range(len(points))]
        return _Node(rows, points, low, high, children)

    def best(self, queries: Queries) -> None:
        self._visit(self.root, queries, np.arange(len(queries.of)))

    def _visit(self, node: _Node, queries: Queries, asked: np.ndarray) -> None:
        if not len(asked):
            return
        if node.points is None:
            self._compare(node.rows, queries, asked)
            return
        vectors, place = np.unique(queries.of[asked], return_inverse=True)
        flat = queries.vectors[vectors].astype(np.float64)
        away = between(np.concatenate([flat, np.zeros((len(flat), 1))], 1), node.points)[place]
        for j in np.argsort(away.mean(0)):
            if node.children[j] is None:
                continue
            # The annulus shrinks as better rows are found, so it is taken anew for each child.
            inner, outer = queries.annulus(asked, self.longest)
            stays = alive(away, node.low[:, j : j + 1], node.high[:, j : j + 1], inner, outer, self.room)[:, 0]
            self._visit(node.children[j], queries, asked[stays])

    def _compare(self, rows: np.ndarray, queries: Queries, asked: np.ndarray) -> None:
        vectors, place = np.unique(queries.of[asked], return_inverse=True)
        if self.exact:
            scores = queries.vectors[vectors].astype(np.float64) @ self.rows[rows].T
        else:
            scores = np.stack([(self.rows[rows] * v).sum(1) for v in queries.vectors[vectors]])
        fits = (self.labels[rows] == queries.labels[vectors][:, None]) == queries.same_label
        fits &= self.ids[rows] != queries.ids[vectors][:, None]
        scores, fits = scores[place], fits[place]
        fits &= (scores >= np.maximum(queries.least[asked], queries.kth(asked))[:, None]) & (scores <= queries.most[asked][:, None])
        which, at = np.nonzero(fits)
        if len(which):
            queries.add(asked[which], scores[which, at].astype(np.int64), self.ids[rows][at])


class Queries:
    """Questions for the best ``k`` rows of the same label, or of another, with a score from ``least`` to ``most``.

    ``of`` names the vector that each question is about. Higher scores are better, of equal ones smaller ids.
    """

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray, of: np.ndarray, least: np.ndarray, most: np.ndarray, k: int, same_label: bool):
        self.ids, self.labels, self.vectors, self.of, self.least, self.most, self.k, self.same_label = ids, labels, vectors, of, least, most, k, same_label
        self.squares = (vectors.astype(np.float64) ** 2).sum(1)
        self.found = np.zeros(len(of), np.int64)
        self.scores = np.zeros((len(of), k), np.int64)
        self.rows = np.zeros((len(of), k), np.int64)

    def kth(self, asked: np.ndarray) -> np.ndarray:
        """The score below which a row is of no use any more."""
        return np.where(self.found[asked] == self.k, self.scores[asked, self.k - 1], LOWEST)

    def annulus(self, asked: np.ndarray, longest: float) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest distance of rows that can still count."""
        base = self.squares[self.of[asked]] + longest
        least = np.maximum(self.least[asked], self.kth(asked))
        return tuple(np.sqrt(np.maximum(base - 2 * score.astype(np.float64), 0.0)) for score in (self.most[asked], least))

    def add(self, asked: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        touched = np.unique(asked)
        held = np.arange(self.k) < self.found[touched][:, None]
        asked = np.r_[asked, np.repeat(touched, held.sum(1))]
        scores = np.r_[scores, self.scores[touched][held]]
        ids = np.r_[ids, self.rows[touched][held]]
        order = np.lexsort((ids, -scores, asked))
        asked, scores, ids = asked[order], scores[order], ids[order]
        rank = np.arange(len(asked)) - np.searchsorted(asked, asked)
        kept = rank < self.k
        self.scores[asked[kept], rank[kept]] = scores[kept]
        self.rows[asked[kept], rank[kept]] = ids[kept]
        self.found[touched] = np.minimum(np.searchsorted(asked, touched, "right") - np.searchsorted(asked, touched), self.k)

    def answers(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Question, score and id of everything found."""
        held = np.arange(self.k) < self.found[:, None]
        return np.nonzero(held)[0], self.scores[held], self.rows[held]
