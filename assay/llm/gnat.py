"""Geometric near-neighbour access tree over the entries of a codebook, exact in integers.

A node picks split points far apart from each other and gives every other entry to its
nearest split.  For each pair (split i, child j) it stores the range of the distances from
split i to the entries of child j, split j included.  A query measures its distances to the
splits; child j is left out when for some split i even the best case of the triangle
inequality lies strictly beyond the nearest entry met so far.  The compared distances are
square roots and rounded outwards, so no entry that is nearest or tied is ever left out;
which entry wins is told by exact squared distances, ties by the lower index.

Vectors are integers.  Rows whose squared distances stay below 2^53 are held as doubles
(every sum is then exact); others as Python integers, with integer square roots.  Queries
go through the tree in batches: one matrix of distances per visited node.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

ARITY, LEAF = 8, 12
_OUT = 2.0 ** -48       # outward rounding of a double's square root; its own error is 2^-53


def exact_limit(dim: int) -> int:
    """Largest component for which squared distances of ``dim`` components are exact in
    doubles."""
    return math.isqrt((1 << 53) // (4 * max(1, dim))) - 1


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` to the rows of ``b``."""
    if a.dtype != object:
        return (a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)[None]
    out = np.zeros((len(a), len(b)), dtype=object)
    for i in range(a.shape[1]):
        gap = a[:, i, None] - b[None, :, i]
        out += gap * gap
    return out


def roots(d2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Numbers not above and not below the distances whose squares are given."""
    if d2.dtype != object:
        r = np.sqrt(d2)
        return r * (1 - _OUT), r * (1 + _OUT)
    low = np.array([math.isqrt(int(x)) for x in d2.ravel()], dtype=object).reshape(d2.shape)
    return low, low + 1


@dataclass
class Node:
    ids: np.ndarray                     # entries compared here: splits, or all of a leaf
    children: list[Node | None] | None = None
    low: np.ndarray | None = None       # [split, child]: least distance from split to child's entries
    high: np.ndarray | None = None      # and the largest


class Gnat:
    """Nearest entry of a codebook (rows of ``entries``, integers) for batches of queries."""

    def __init__(self, entries: np.ndarray, arity: int = ARITY, leaf: int = LEAF):
        self.entries, self.arity, self.leaf = entries, arity, leaf
        self._between = squared(entries, entries)
        self.root = self._build(np.arange(len(entries)))
        del self._between
        self.measured = 0               # distances computed by searches

    def _build(self, ids: np.ndarray) -> Node:
        if len(ids) <= self.leaf:
            return Node(ids)
        splits, gap = [int(ids[0])], self._between[ids[0], ids]
        while len(splits) < self.arity:
            far = int(gap.argmax())
            if gap[far] == 0:           # all others equal a split
                break
            splits.append(int(ids[far]))
            gap = np.minimum(gap, self._between[ids[far], ids])
        if len(splits) < 2:
            return Node(ids)
        splits = np.array(sorted(splits))
        rest = np.setdiff1d(ids, splits)
        near = self._between[np.ix_(rest, splits)].argmin(1)
        children, low, high = [], [], []
        for j, split in enumerate(splits):
            own = rest[near == j]
            a, b = roots(self._between[np.ix_(splits, np.append(own, split))])
            low.append(a.min(1))
            high.append(b.max(1))
            children.append(self._build(own) if len(own) else None)
        return Node(splits, children, np.stack(low, 1), np.stack(high, 1))

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each query's nearest entry (ties: the lowest) and the squared distance."""
        n, kind = len(queries), self.entries.dtype
        index = np.zeros(n, dtype=np.int64)
        best = np.full(n, -1, dtype=kind)       # -1: none met yet

        def visit(node: Node, rows: np.ndarray) -> None:
            d2 = squared(queries[rows], self.entries[node.ids])
            self.measured += d2.size
            first = d2.argmin(1)
            found, ids = d2[np.arange(len(rows)), first], node.ids[first]
            old = best[rows]
            better = ((old < 0) | (found < old) | ((found == old) & (ids < index[rows]))).astype(bool)
            best[rows[better]], index[rows[better]] = found[better], ids[better]
            if node.children is None:
                return
            low, high = roots(d2)
            for home in (True, False):          # the nearest split's child first: it shrinks the radius
                for j, child in enumerate(node.children):
                    if child is None:
                        continue
                    at = np.flatnonzero((first == j) == home)
                    if len(at) and not home:
                        radius = roots(best[rows[at]])[1][:, None]
                        out = (low[at] - node.high[None, :, j] > radius) | (node.low[None, :, j] - high[at] > radius)
                        at = at[~out.astype(bool).any(1)]
                    if len(at):
                        visit(child, rows[at])

        if n and len(self.entries):
            visit(self.root, np.arange(n))
        return index, best
