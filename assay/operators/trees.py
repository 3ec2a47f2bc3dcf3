"""CART trees of the rows of one task, grown one level at a time for all nodes together.

Every feature's rows stay sorted inside their node from level to level, so a level is a
few cumulative sums per feature whatever the number of nodes.  Splits are exact (every
boundary between two values); ties go to the lower feature, then the lower threshold.
Trees grow until nodes are pure, too small, or constant in every feature.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np


@dataclass(frozen=True)
class TreeRule:
    """How a tree grows.  ``classes`` 0 means regression; ``max_features`` features that can
    split are drawn for each node (None: all)."""
    classes: int = 0
    max_depth: int | None = None
    min_split: int = 2
    min_leaf: int = 1
    max_features: int | None = None


@dataclass
class Tree:
    """Nodes in breadth-first order; ``feature`` is -1 in a leaf.  ``value`` is the mean, or
    the class shares; ``gain`` what the split takes from the node's weighted impurity."""
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    weight: np.ndarray
    gain: np.ndarray

    def leaf_of(self, x: np.ndarray, most: int | None = None) -> np.ndarray:
        """The leaf each row reaches, or the node after ``most`` decisions: where it would end
        in the same tree of that depth, because a level does not depend on the next ones."""
        out = np.zeros(len(x), dtype=np.int64)
        rows = np.arange(len(x)) if len(self.feature) else np.zeros(0, dtype=np.int64)
        here, flat, d = np.zeros(len(rows), dtype=np.int64), np.ascontiguousarray(x).ravel(), x.shape[1]
        child = np.stack([self.left, self.right], 1).ravel().astype(np.int64)
        while True:
            f = self.feature.take(here)
            inner = f >= 0
            if not inner.all():
                out[rows[~inner]] = here[~inner]
                rows, here, f = rows[inner], here[inner], f[inner]
            if not len(rows):
                return out
            if most is not None:
                if not most:
                    out[rows] = here
                    return out
                most -= 1
            here = child.take(2 * here + ~(flat.take(rows * d + f) <= self.threshold.take(here)))

    def predict(self, x: np.ndarray, most: int | None = None) -> np.ndarray:
        return self.value[self.leaf_of(x, most)]

    def importances(self, n_features: int) -> np.ndarray:
        inner = self.feature >= 0
        return np.bincount(self.feature[inner], self.gain[inner], n_features)


def statistics(y: np.ndarray, w: np.ndarray, classes: int) -> list[np.ndarray]:
    """Columns whose sums tell a node's value and impurity: the weight per class, or the
    weighted label (kept whole when labels are, so that sums stay exact)."""
    if classes:
        return [np.where(y == k, w, 0.0) for k in range(classes)]
    return [w * y]


def midpoint(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A threshold t with a <= t < b."""
    m = a + (b - a) / 2
    return np.where((m >= b) | ~np.isfinite(m), a, m)


def grow(x: np.ndarray, y: np.ndarray, w: np.ndarray, rule: TreeRule, rng: np.random.Generator, depth: int = 0) -> Tree:
    """The tree of rows ``x`` (no NaN) with labels ``y`` and positive weights ``w``, whose
    root stands at ``depth``."""
    n, n_features = x.shape
    columns = [np.ascontiguousarray(x[:, f]) for f in range(n_features)]
    shift = 0.0 if rule.classes else float(np.rint(np.average(y, weights=w)))
    stats = statistics(y - shift, w, rule.classes)
    order = [np.argsort(c, kind="stable") for c in columns]
    if not order:
        order = [np.arange(n)]
    sizes, done, made = np.array([n]), [], 1
    goes = np.zeros(n, dtype=bool)
    while True:
        start = np.cumsum(sizes) - sizes
        o = order[0]
        total_w = np.add.reduceat(w[o], start)
        totals = [np.add.reduceat(s[o], start) for s in stats]
        yo = y[o]
        pure = np.maximum.reduceat(yo, start) == np.minimum.reduceat(yo, start)
        k = len(sizes)
        feature, threshold, gain = np.full(k, -1), np.zeros(k), np.zeros(k)
        open_ = ~pure & (sizes >= max(rule.min_split, 2 * rule.min_leaf)) & (rule.max_depth is None or depth < rule.max_depth)
        if open_.any() and n_features:
            order, sizes = _only(order, sizes, open_)
            feature[open_], threshold[open_], gain[open_] = _splits(columns, w, stats, order, sizes, rule, rng)
        split = feature >= 0
        left = np.full(k, -1)
        left[split] = made + 2 * np.arange(split.sum())
        right = np.where(split, left + 1, -1)
        value = np.stack(totals, 1) / total_w[:, None] if rule.classes else totals[0][:, None] / total_w[:, None] + shift
        done.append((feature, threshold, left, right, value, total_w, gain))
        if not split.any():
            break
        made += 2 * int(split.sum())
        order, sizes = _only(order, sizes, split[open_])
        cut_by, at = np.repeat(feature[split], sizes), np.repeat(threshold[split], sizes)
        rows = order[0]
        side = np.empty(len(rows), dtype=bool)
        for f in range(n_features):
            here = np.flatnonzero(cut_by == f)
            side[here] = columns[f].take(rows[here]) <= at[here]
        goes[rows] = side
        n_left = np.add.reduceat(side.astype(np.int64), np.cumsum(sizes) - sizes)
        sizes = np.stack([n_left, sizes - n_left], 1).ravel()
        # within a node the rows that go left stand first, otherwise in the same order
        first = np.repeat(np.arange(len(sizes)) % 2 == 0, sizes)
        order = [_parted(a, goes, first) for a in order]
        depth += 1
    return Tree(*[np.concatenate([d[i] for d in done]) for i in range(7)])


def _only(order: list[np.ndarray], sizes: np.ndarray, nodes: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The rows of some nodes."""
    if nodes.all():
        return order, sizes
    keep = np.flatnonzero(np.repeat(nodes, sizes))
    return [a.take(keep) for a in order], sizes[nodes]


def _parted(order: np.ndarray, goes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Rows that go left at the places ``first``, the others at the other ones."""
    left, out = goes.take(order), np.empty_like(order)
    out[first], out[~first] = order[left], order[~left]
    return out


def _splits(columns, w, stats, order, sizes, rule: TreeRule, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Best (feature, threshold, gain) of each node; feature -1 where none is valid.  Sums run
    over the nodes that drew a feature, scores over the places between two of its values."""
    k, n_features = len(sizes), len(columns)
    drawn = None
    if rule.max_features is not None and rule.max_features < n_features:
        start = np.cumsum(sizes) - sizes
        varies = np.stack([c[a[start]] < c[a[start + sizes - 1]] for c, a in zip(columns, order)], 1)
        keys = np.where(varies, rng.random((k, n_features)), 2.0)
        rank = np.argsort(np.argsort(keys, axis=1, kind="stable"), axis=1)
        drawn = varies & (rank < rule.max_features)
    best = np.full(k, -np.inf)
    feature, threshold = np.full(k, -1), np.zeros(k)
    base = np.zeros(k)
    for f, (column, a) in enumerate(zip(columns, order)):
        ids, own = np.arange(k), sizes
        if drawn is not None:
            (a,), own = _only([a], sizes, drawn[:, f])
            ids = ids[drawn[:, f]]
        if not len(ids):
            continue
        start = np.cumsum(own) - own
        end = start + own - 1
        xs = column.take(a)
        ok = np.empty(len(a), dtype=bool)
        np.less(xs[:-1], xs[1:], out=ok[:-1])
        ok[end] = False
        at = np.flatnonzero(ok)
        node = np.repeat(np.arange(len(ids)), own).take(at)
        if rule.min_leaf > 1:
            before = at - start[node] + 1
            fits = (before >= rule.min_leaf) & (own[node] - before >= rule.min_leaf)
            at, node = at[fits], node[fits]
        if not len(at):
            continue
        ws = w.take(a)
        cw = np.cumsum(ws)
        before = cw[start] - ws[start]
        tw = cw[end] - before
        lw = cw.take(at) - before.take(node)
        rw = tw.take(node) - lw
        score, whole = np.zeros(len(at)), np.zeros(len(ids))
        with np.errstate(divide="ignore", invalid="ignore"):
            for s in stats:
                sa = s.take(a)
                cs = np.cumsum(sa)
                sb = cs[start] - sa[start]
                ls, ts = cs.take(at) - sb.take(node), cs[end] - sb
                score += ls * ls / lw + (ts.take(node) - ls) ** 2 / rw
                whole += ts * ts / tw
        head = np.flatnonzero(np.diff(node, prepend=-1))        # the first place of each node that has any
        found = node[head]
        top = np.maximum.reduceat(score, head)
        equal = np.flatnonzero(score == np.repeat(top, np.diff(head, append=len(at))))
        better = top > best[ids[found]]
        to, i = ids[found[better]], at[equal[np.searchsorted(equal, head[better])]]     # the lowest of the best places
        best[to], feature[to], base[to] = top[better], f, whole[found[better]]
        threshold[to] = midpoint(xs[i], xs[i + 1])
    return feature, threshold, np.where(feature >= 0, np.maximum(best - base, 0.0), 0.0)
