"""Space partition for nearest-neighbour work on rows with missing coordinates.

A tree is built from a bounded sample. It cuts along the coordinate that varies most; where that one is missing in some rows,
it first parts the rows that have it from those that do not, so no coordinate has to be complete. Leaves become
blocks, and the box of a block (of all its rows, not of the sample) gives the least distance that any row in it can have.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

PLACES = 9


@dataclass
class KdTree:
    axis: np.ndarray  # -1 at leaves
    cut: np.ndarray  # NaN: rows without the coordinate go right
    left: np.ndarray
    right: np.ndarray
    leaf: np.ndarray

    @property
    def leaves(self) -> int:
        return int(self.leaf.max()) + 1

    def route(self, x: np.ndarray) -> np.ndarray:
        """Leaf of every row."""
        at, rows = np.zeros(len(x), np.int64), np.arange(len(x))
        while len(rows):
            rows = rows[self.axis[at[rows]] >= 0]
            node = at[rows]
            value, cut = x[rows, self.axis[node]], self.cut[node]
            goes_left = np.where(np.isnan(cut), ~np.isnan(value), value <= cut)
            at[rows] = np.where(goes_left, self.left[node], self.right[node])
        return self.leaf[at]


def build(sample: np.ndarray, leaf_rows: int) -> KdTree:
    """Leaves of at most ``leaf_rows`` sample rows, but where rows cannot be told apart."""
    axis, cut, left, right, leaf = [], [], [], [], []
    todo, leaves = [(np.arange(len(sample)), -1, 0)], 0
    while todo:
        rows, parent, side = todo.pop()
        here = len(axis)
        for values, v in ((axis, -1), (cut, 0.0), (left, -1), (right, -1), (leaf, -1)):
            values.append(v)
        if parent >= 0:
            (left, right)[side][parent] = here
        found = _best_cut(sample[rows]) if len(rows) > leaf_rows else None
        if found is None:
            leaf[here], leaves = leaves, leaves + 1
            continue
        a, c = found
        value = sample[rows, a]
        goes = ~np.isnan(value) if np.isnan(c) else value <= c
        axis[here], cut[here] = a, c
        todo += [(rows[~goes], here, 1), (rows[goes], here, 0)]
    return KdTree(np.array(axis), np.array(cut), np.array(left), np.array(right), np.array(leaf))


@dataclass
class Forest:
    """A tree per kind of rows; their leaves are numbered on."""

    trees: dict[int, KdTree]

    def __post_init__(self):
        ends = np.cumsum([0, *(t.leaves for t in self.trees.values())])
        self.first = dict(zip(self.trees, ends[:-1].tolist()))
        self.kind = np.repeat(list(self.trees), np.diff(ends))  # of every leaf

    def route(self, x: np.ndarray, kind: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), np.int64)
        for k in np.unique(kind).tolist():
            out[kind == k] = self.trees[k].route(x[kind == k]) + self.first[k]
        return out


def alike(x: np.ndarray, leaf: np.ndarray) -> list[np.ndarray]:
    """Rows in groups that miss the same coordinates and lie in the same leaf."""
    if not len(x):
        return []
    missing = np.packbits(np.isnan(x), axis=1)
    keys = [leaf, *missing.T]
    order = np.lexsort(keys)
    new = np.zeros(len(x), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return np.split(order, np.flatnonzero(new))


def _best_cut(x: np.ndarray) -> tuple[int, float] | None:
    share = (~np.isnan(x)).mean(axis=0)
    known = np.where(np.isnan(x), 0.0, x)
    mean = known.sum(axis=0) / np.maximum(share * len(x), 1)
    spread = np.where(np.isnan(x), 0.0, (x - mean) ** 2).mean(axis=0)
    for a in np.argsort(-spread, kind="stable").tolist():
        if spread[a] <= 0:
            return None
        if share[a] < 1:
            return a, float("nan")
        v = np.sort(x[:, a])
        if v[0] == v[-1]:
            continue
        c = v[(len(v) - 1) // 2]
        if c == v[-1]:  # more than half share the largest value
            c = v[np.searchsorted(v, c) - 1]
        return a, float(c)
    return None


@dataclass
class Boxes:
    """Per block the bounds of each coordinate, whether all rows have it, and whether any row has it."""

    low: np.ndarray
    high: np.ndarray
    sure: np.ndarray
    some: np.ndarray

    @classmethod
    def of(cls, x: np.ndarray, block: np.ndarray, blocks: int) -> Boxes:
        p = x.shape[1]
        low, high = np.full((blocks, p), np.inf), np.full((blocks, p), -np.inf)
        order = np.argsort(block, kind="stable")
        seen, starts = np.unique(block[order], return_index=True)
        own, gone = x[order], np.isnan(x[order])
        low[seen] = np.minimum.reduceat(np.where(gone, np.inf, own), starts)
        high[seen] = np.maximum.reduceat(np.where(gone, -np.inf, own), starts)
        sure, some = np.zeros((blocks, p), bool), np.zeros((blocks, p), bool)
        sure[seen] = ~np.logical_or.reduceat(gone, starts)
        some[seen] = np.logical_or.reduceat(~gone, starts)
        return cls(low, high, sure, some)

    def least(self, x: np.ndarray, total: int) -> np.ndarray:
        """Least distance of every row of ``x`` to every block; infinite where no coordinate can be shared.

        A coordinate counts if the row and every row of the block have it; the share of missing ones that scales the
        distance is at least that of the coordinates that some row of the block has.
        """
        return self._least(x, x, total)

    def least_of_all(self, x: np.ndarray, total: int) -> np.ndarray:
        """Least distance of any row of ``x`` to every block; all rows miss the same coordinates."""
        return self._least(x.min(axis=0, keepdims=True), x.max(axis=0, keepdims=True), total)[0]

    def take(self, blocks: np.ndarray) -> Boxes:
        return Boxes(self.low[blocks], self.high[blocks], self.sure[blocks], self.some[blocks])

    def _least(self, low: np.ndarray, high: np.ndarray, total: int) -> np.ndarray:
        have = ~np.isnan(low)
        out = np.zeros((len(low), len(self.low)))
        for a in range(low.shape[1]):
            with np.errstate(invalid="ignore"):
                gap = np.maximum(np.maximum(self.low[:, a] - high[:, a:a + 1], low[:, a:a + 1] - self.high[:, a]), 0.0)
            out += np.where(have[:, a:a + 1] & self.sure[:, a], gap, 0.0) ** 2
        shared = have.astype(float) @ self.some.T.astype(float)
        with np.errstate(divide="ignore", invalid="ignore"):
            bound = np.sqrt(total / shared * out)
        return np.where(shared > 0, bound * (1 - 1e-9) - 10.0**-PLACES, np.inf)
