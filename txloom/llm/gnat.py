"""A multiway hyperplane tree over integer vectors that answers windows of inner products exactly.

Inner products are turned into distances by one more dimension: a row x gets sqrt(M^2 - |x|^2), with M the largest norm
of the tree's rows, a query gets 0. Then |q - x|^2 = |q|^2 + M^2 - 2 q.x, and a window of products is an annulus around
the query.

A node has split points, chosen far from each other; each row goes to the nearest one, so siblings are parted by the
hyperplanes between split points. Every split point stores the range of its distances to the rows of each sibling. A
sibling is eliminated if, for some split point, no row at such a distance can lie in the query's annulus. What is left is
scored exactly in the leaves.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np

FAN_OUT = 12
LEAF_ROWS = 96
#: Rows that the split points of a node are chosen from.
CHOSEN_FROM = 256
#: Share of M by which rounding may put a distance off; it is far below any difference that matters.
_SLACK = 1e-6


@dataclass
class Node:
    """Rows first .. after of the tree; an inner node has children, split points, which of
    them own the children, and the ranges [split, child]."""

    first: int
    after: int
    children: list["Node"] = field(default_factory=list)
    splits: np.ndarray | None = None
    used: np.ndarray | None = None
    nearest: np.ndarray | None = None
    farthest: np.ndarray | None = None


class Tree:
    """`x`: whole numbers as doubles, a row each; `order` tells which given row stands at each place of the tree."""

    def __init__(self, x: np.ndarray, fan_out: int = FAN_OUT, leaf_rows: int = LEAF_ROWS):
        self.fan_out, self.leaf_rows = fan_out, leaf_rows
        self.order = np.arange(len(x))
        self.x = x
        norms = np.einsum("ij,ij->i", x, x)
        self.square = float(norms.max(initial=0))
        self.rest = np.sqrt(np.maximum(self.square - norms, 0))
        self.slack = _SLACK * max(1.0, float(np.sqrt(self.square)))
        self.root = self._grow(0, len(x))
        self.leaves_seen = 0

    def _between(self, rows: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Distances of rows to points, both places in the tree."""
        product = self.x[rows] @ self.x[points].T + np.outer(self.rest[rows], self.rest[points])
        return np.sqrt(np.maximum(2 * (self.square - product), 0))

    def _far_apart(self, rows: np.ndarray) -> np.ndarray:
        """Up to fan_out of the rows, each the farthest from those before."""
        few = rows[np.linspace(0, len(rows) - 1, min(len(rows), CHOSEN_FROM)).astype(np.int64)]
        chosen = [int(few[0])]
        far = self._between(few, few[:1])[:, 0]
        while len(chosen) < self.fan_out and far.max() > self.slack:
            chosen.append(int(few[far.argmax()]))
            far = np.minimum(far, self._between(few, np.array(chosen[-1:]))[:, 0])
        return np.array(chosen)

    def _grow(self, first: int, after: int) -> Node:
        node = Node(first, after)
        rows = np.arange(first, after)
        if len(rows) <= self.leaf_rows:
            return node
        splits = self._far_apart(rows)
        distances = self._between(rows, splits)
        child = distances.argmin(1)
        sizes = np.bincount(child, minlength=len(splits))
        if sizes.max() == len(rows):
            return node  # rows that no split point tells apart
        node.splits = self.x[splits].copy()
        node.used = used = np.flatnonzero(sizes)
        node.nearest = np.stack([distances[child == c].min(0) for c in used], 1)
        node.farthest = np.stack([distances[child == c].max(0) for c in used], 1)
        moved = rows[np.argsort(child, kind="stable")]
        for column in (self.x, self.rest, self.order):
            column[first:after] = column[moved]
        ends = first + np.cumsum(sizes[used])
        node.children = [self._grow(int(e - n), int(e)) for e, n in zip(ends, sizes[used], strict=True)]
        return node

    def search(self, queries: np.ndarray, best: "Best") -> None:
        """Offer `best` every row that may still enter it, a leaf at a time. One leaf of each query, where the first rows
        of its window are likely, is read before that: its k-th score is a floor that narrows the window."""
        norms = np.einsum("ij,ij->i", queries, queries)
        likely = best.empty()
        self._descend(self.root, np.arange(len(queries)), queries, norms, likely)
        best.narrow(likely)
        self._visit(self.root, np.arange(len(queries)), queries, norms, best)

    def _to_splits(self, node: Node, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return np.sqrt(np.maximum(norms[:, None] + self.square - 2 * (queries @ node.splits.T), 0))

    def _descend(self, node: Node, here: np.ndarray, queries: np.ndarray, norms: np.ndarray, best: "Best") -> None:
        if not node.children:
            rows = slice(node.first, node.after)
            best.offer(here, queries[here] @ self.x[rows].T, self.order[rows])
            return
        _, high = best.window(here)
        inner = np.sqrt(np.maximum(norms[here] + self.square - 2 * high, 0))
        child = np.abs(self._to_splits(node, queries[here], norms[here])[:, node.used] - inner[:, None]).argmin(1)
        for c in np.unique(child):
            self._descend(node.children[c], here[child == c], queries, norms, best)

    def _visit(self, node: Node, alive: np.ndarray, queries: np.ndarray, norms: np.ndarray, best: "Best") -> None:
        if not node.children:
            self.leaves_seen += len(alive)
            rows = slice(node.first, node.after)
            best.offer(alive, queries[alive] @ self.x[rows].T, self.order[rows])
            return
        to_split = self._to_splits(node, queries[alive], norms[alive])
        # lower bound of the distance to any row of a child, over all split points
        at_least = np.maximum(to_split[:, :, None] - node.farthest, node.nearest - to_split[:, :, None]).max(1)
        at_most = (to_split[:, :, None] + node.farthest).min(1)
        for c in np.argsort(at_least.mean(0), kind="stable"):
            low, high = best.window(alive)  # narrows as rows are found
            outer = np.sqrt(np.maximum(norms[alive] + self.square - 2 * low, 0)) + self.slack
            inner = np.sqrt(np.maximum(norms[alive] + self.square - 2 * high, 0)) - self.slack
            kept = (at_least[:, c] <= outer) & (at_most[:, c] >= inner)
            if kept.any():
                self._visit(node.children[c], alive[kept], queries, norms, best)


class Best:
    """The k first rows of each query: highest product first, ties by smaller id, within a window of products.

    `same` says whether a row must have the query's label or another one.
    """

    def __init__(self, k: int, low: np.ndarray, high: np.ndarray, labels: np.ndarray, same: bool):
        n = len(low)
        self.k, self.low, self.high, self.labels, self.same = k, low.copy(), high, labels, same
        self.scores = np.full((n, k), -np.inf)
        self.ids = np.full((n, k), np.iinfo(np.int64).max)

    def empty(self) -> "Best":
        out = Best(self.k, self.low, self.high, self.labels, self.same)
        out.rows(self.row_ids, self.row_labels)
        return out

    def narrow(self, found: "Best") -> None:
        """Rows below the k-th of those found elsewhere do not matter."""
        self.low = np.maximum(self.low, found.scores[:, -1])

    def rows(self, ids: np.ndarray, labels: np.ndarray) -> None:
        """The rows that are offered next, by their numbers."""
        self.row_ids, self.row_labels = ids, labels

    def window(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.maximum(self.low[queries], self.scores[queries, -1]), self.high[queries]

    def offer(self, queries: np.ndarray, scores: np.ndarray, rows: np.ndarray) -> None:
        equal = self.labels[queries, None] == self.row_labels[rows]
        low, high = self.window(queries)
        fit = (equal if self.same else ~equal) & (scores >= low[:, None]) & (scores <= high[:, None])
        better = np.flatnonzero(fit.any(1))
        if not len(better):
            return
        at = queries[better]
        found = np.where(fit[better], scores[better], -np.inf)
        ids = np.where(fit[better], self.row_ids[rows], np.iinfo(np.int64).max)
        all_scores, all_ids = np.concatenate([self.scores[at], found], 1), np.concatenate([self.ids[at], ids], 1)
        first = np.lexsort((all_ids, -all_scores), axis=1)[:, : self.k]
        self.scores[at] = np.take_along_axis(all_scores, first, 1)
        self.ids[at] = np.take_along_axis(all_ids, first, 1)
