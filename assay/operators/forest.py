"""Decision trees and random forests without a depth cap, grown by Spark.

Several forests (other rules, other left-out folds) grow from one table together.  A node
with more rows than ``bound`` is split by histograms: one scan counts the rows of all such
nodes of all trees by feature bin, Spark adds the counts up, and the best cut of a node
(a line per node and feature) is chosen on the driver, which holds only these top trees.
Then every row goes once, with its bootstrap weight, to the node of each tree it belongs
to, and each node is finished as a whole subtree in one task (``trees.grow``, exact splits).
Up to ``bound`` rows a whole tree is one such task.  The finished subtrees stay a table in
the shared folder; they never reach the driver.

Scoring joins blocks of rows with blocks of subtrees: a task holds at most ``BLOCK_NODES``
nodes and about ``BLOCK_ROWS`` rows, whatever the forest's size, and partial sums are added
up per row.

Grid searches keep no trees: below ``WHOLE_NUMBERS`` a task grows some trees of all rules,
scores the rows they did not see and passes on the sums (``left_out_sums``).

Bootstrap weights are Poisson(1) numbers of a hash of row and tree, as in other distributed
forests.  A large node that no bin boundary divides becomes a leaf.
"""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators._small import settled
from assay.operators.trees import Tree, TreeRule, grow
from assay.session import scratch_path, ship_package

BOUND = 65_536              # rows of a node that one task finishes
BINS = 256                  # bins of a feature in the histograms of larger nodes
PASS_NUMBERS = 8_000_000    # histogram numbers a task holds in one scan
BLOCK_NODES, BLOCK_ROWS = 1_500_000, 1_000_000
UNITS_PER_TASK, MOST_TASKS = 8, 1_000
WHOLE_NUMBERS = 1 << 20     # rows x features of a table whose trees one task grows and scores
TREES_PER_TASK = 10         # of these, for every rule and one left-out fold
SQRT = -1                   # as ``max_features``: the square root of the features

NODES = ("spec int, tree int, slot int, feature array<int>, threshold array<double>, left array<int>, right array<int>, "
         "value array<double>, weight array<double>, gains array<double>")
_NODE_TYPES = [("spec", pa.int32()), ("tree", pa.int32()), ("slot", pa.int32()), ("feature", pa.list_(pa.int32())),
               ("threshold", pa.list_(pa.float64())), ("left", pa.list_(pa.int32())), ("right", pa.list_(pa.int32())),
               ("value", pa.list_(pa.float64())), ("weight", pa.list_(pa.float64())), ("gains", pa.list_(pa.float64()))]


@dataclass(frozen=True)
class ForestSpec:
    """One forest: trees, rule, whether rows are drawn anew for each tree, the seed, and the
    fold it must not see (None: it sees all rows)."""
    trees: int = 100
    rule: TreeRule = TreeRule()
    bootstrap: bool = True
    seed: int = 42
    skip_fold: int | None = None


class Top:
    """The upper part of one tree: inner nodes, and the slot (finished subtree) at each end."""

    def __init__(self):
        self.feature, self.threshold, self.left, self.right, self.slot = [-1], [0.0], [-1], [-1], [0]
        self.depth = [0]

    def split(self, at: int, feature: int, threshold: float) -> tuple[int, int]:
        n = len(self.feature)
        self.feature[at], self.threshold[at], self.left[at], self.right[at], self.slot[at] = feature, threshold, n, n + 1, -1
        for _ in range(2):
            self.feature.append(-1)
            self.threshold.append(0.0)
            self.left.append(-1)
            self.right.append(-1)
            self.slot.append(-1)
            self.depth.append(self.depth[at] + 1)
        return n, n + 1

    def ends(self) -> list[int]:
        return [i for i, f in enumerate(self.feature) if f < 0]

    def number(self) -> None:
        for slot, at in enumerate(self.ends()):
            self.slot[at] = slot

    def paths(self) -> dict[int, tuple]:
        """The decisions (feature, threshold, side) that lead to each end."""
        path: dict[int, tuple] = {0: ()}
        for at, f in enumerate(self.feature):
            if f >= 0:
                path[self.left[at]] = (*path[at], (f, self.threshold[at], 0))
                path[self.right[at]] = (*path[at], (f, self.threshold[at], 1))
        return {at: path[at] for at in self.ends()}

    def place(self, x: np.ndarray) -> np.ndarray:
        """The end each row reaches."""
        if len(self.feature) == 1:
            return np.zeros(len(x), dtype=np.int64)
        none = np.zeros((len(self.feature), 0))
        return Tree(np.array(self.feature), np.array(self.threshold), np.array(self.left), np.array(self.right), none,
                    none, none).leaf_of(x)

    def slots(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.slot)[self.place(x)]


# --------------------------------------------------------------------------- weights of the rows

_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(20)])


def bootstrap_weights(rid: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is drawn for a tree: Poisson(1) of a hash of (row, tree, seed)."""
    with np.errstate(over="ignore"):
        h = rid.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((tree + 1) * 0xBF58476D1CE4E5B9 % (1 << 64)) \
            + np.uint64((seed + 1) * 0x94D049BB133111EB % (1 << 64))
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            h = (h ^ (h >> np.uint64(shift))) * np.uint64(factor)
        h ^= h >> np.uint64(31)
    return np.searchsorted(_POISSON, (h >> np.uint64(11)).astype(np.float64) / (1 << 53), side="right").astype(np.float64)


def drawn(batch: dict, spec: ForestSpec, tree: int) -> np.ndarray:
    """Weight of every row of a batch in one tree of a forest; 0 where it takes no part."""
    w = bootstrap_weights(batch["rid"], tree, spec.seed) if spec.bootstrap else np.ones(len(batch["rid"]))
    return w if spec.skip_fold is None else np.where(batch["fold"] == spec.skip_fold, 0.0, w)


def _arrays(b: pa.RecordBatch | pa.Table) -> dict:
    out = {}
    for name in b.schema.names:
        column = b.column(name)
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        if pa.types.is_list(column.type):
            flat = column.flatten().to_numpy(zero_copy_only=False)
            out[name] = flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))
        else:
            out[name] = column.to_numpy(zero_copy_only=False)
    return out


def _matrix(x: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(np.arange(0, x.size + 1, x.shape[1], dtype=np.int32), np.ascontiguousarray(x).ravel())


# --------------------------------------------------------------------------- large nodes

def _cuts(data: DataFrame, n_features: int) -> list[np.ndarray]:
    """Increasing thresholds of every feature between its bins (all values, if few)."""
    probs = [i / BINS for i in range(1, BINS)]
    row = data.agg(*[F.percentile_approx(F.col("x")[f], probs, 20_000).alias(f"q{f}") for f in range(n_features)],
                   *[F.max(F.col("x")[f]).alias(f"m{f}") for f in range(n_features)]).first()
    return [np.array(sorted({v for v in row[f"q{f}"] or [] if v < row[f"m{f}"]})) for f in range(n_features)]


def _best_cut(h: np.ndarray, rule: TreeRule) -> tuple[float, int, float, float, bool]:
    """(gain, bin, rows left, rows right, whether the node is pure) from one feature's
    histogram: rows, weight and statistics (class weights, or label and squared label)."""
    left = np.cumsum(h, axis=0)
    whole = left[-1]
    right = whole - left
    stats = h.shape[1] - 2 if rule.classes else 1
    with np.errstate(divide="ignore", invalid="ignore"):
        score = sum(left[:, 2 + i] ** 2 / left[:, 1] + right[:, 2 + i] ** 2 / right[:, 1] for i in range(stats))
        base = sum(whole[2 + i] ** 2 / whole[1] for i in range(stats))
    pure = np.count_nonzero(whole[2:]) <= 1 if rule.classes else whole[3] - base <= 1e-12 * max(1.0, abs(whole[3]))
    score[(left[:, 0] < max(1, rule.min_leaf)) | (right[:, 0] < max(1, rule.min_leaf))] = -np.inf
    at = int(score.argmax())
    return float(score[at] - base), at, float(left[at, 0]), float(right[at, 0]), bool(pure)


def _grow_tops(data: DataFrame, specs: list[ForestSpec], n: int, n_features: int, classes: int, bound: int) -> dict:
    """Top trees whose ends have at most ``bound`` rows (or cannot be divided)."""
    tops = {(s, t): Top() for s, spec in enumerate(specs) for t in range(spec.trees)}
    if n <= bound:
        return tops
    cuts = _cuts(data, n_features)
    width = max(len(c) for c in cuts) + 1
    k = 2 + (classes or 2)
    pending = [(s, t, 0) for s, t in tops]
    while pending:
        batch, pending = pending[:max(1, PASS_NUMBERS // (n_features * width * k))], \
            pending[max(1, PASS_NUMBERS // (n_features * width * k)):]
        sent = {key: tops[key] for key in {(s, t) for s, t, _ in batch}}

        def run(batches, sent=sent, batch=batch):
            wanted = {}
            for i, (s, t, at) in enumerate(batch):
                wanted.setdefault((s, t), {})[at] = i
            hist = np.zeros((len(batch), n_features, width, k))
            for b in map(_arrays, batches):
                if not len(b["rid"]):
                    continue
                x, y = b["x"], b["y"]
                bins = [np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)]
                for (s, t), ends in wanted.items():
                    w = drawn(b, specs[s], t)
                    # cells are numbered within the tree: a tree's counts cost its own nodes only
                    lookup = np.full(len(sent[s, t].feature), -1)
                    lookup[list(ends)] = np.arange(len(ends))
                    rows = np.flatnonzero(w > 0)
                    node = lookup[sent[s, t].place(x[rows])]
                    rows, node = rows[node >= 0], node[node >= 0]
                    wr, yr = w[rows], y[rows]
                    stats = [None, wr]
                    stats += [np.where(yr == c, wr, 0.0) for c in range(classes)] if classes else [wr * yr, wr * yr ** 2]
                    ids = list(ends.values())
                    for f in range(n_features):
                        cell = node * width + bins[f][rows]
                        for j, v in enumerate(stats):
                            hist[ids, f, :, j] += np.bincount(cell, v, len(ids) * width).reshape(-1, width)
            node, f = np.divmod(np.arange(len(batch) * n_features), n_features)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int32()), pa.array(f, pa.int32()),
                                              _matrix(hist.reshape(len(node), -1))], names=["node", "f", "h"])

        def cut(batches, batch=batch):
            for b in batches:
                got = [_best_cut(np.array(h).reshape(width, k), specs[batch[i][0]].rule)
                       for i, h in zip(b.column(0).to_pylist(), b.column(2).to_pylist())]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), b.column(1), *(pa.array(c) for c in zip(*got))] if got else
                    [b.column(0), b.column(1), pa.array([], pa.float64()), pa.array([], pa.int64()), pa.array([], pa.float64()),
                     pa.array([], pa.float64()), pa.array([], pa.bool_())],
                    names=["node", "f", "gain", "at", "l", "r", "pure"])

        ship_package(data.sparkSession)
        sums = data.mapInArrow(run, "node int, f int, h array<double>").groupBy("node", "f") \
            .agg(vector_to_array(Summarizer.sum(array_to_vector("h"))).alias("h"))
        cutting = sums.mapInArrow(cut, "node int, f int, gain double, at long, l double, r double, pure boolean")
        found: dict = {}
        for r in cutting.collect():         # a line per large node and feature
            found.setdefault(r["node"], []).append(r)
        for i, (s, t, at) in enumerate(batch):
            rule, top = specs[s].rule, tops[s, t]
            usable = sorted((r for r in found.get(i, []) if r["gain"] > -math.inf and not r["pure"]), key=lambda r: r["f"])
            if rule.max_features is not None and rule.max_features < len(usable):
                rng = np.random.default_rng([specs[s].seed, t, at, len(top.feature)])
                usable = [usable[j] for j in sorted(rng.choice(len(usable), rule.max_features, replace=False))]
            rows = max((r["l"] + r["r"] for r in found.get(i, [])), default=0)
            if not usable or rows < rule.min_split or (rule.max_depth is not None and top.depth[at] >= rule.max_depth):
                continue
            best = max(usable, key=lambda r: (r["gain"], -r["f"]))
            children = top.split(at, best["f"], float(cuts[best["f"]][best["at"]]))
            pending += [(s, t, c) for c, size in zip(children, (best["l"], best["r"])) if size > bound]
    for top in tops.values():
        top.number()
    return tops


# --------------------------------------------------------------------------- fitting

class Forests:
    """Fitted forests: the table of subtrees, the top trees and the specifications."""

    def __init__(self, nodes: DataFrame, tops: dict, specs: list[ForestSpec], n_features: int, classes: int):
        self.nodes, self.tops, self.specs, self.n_features, self.classes = nodes, tops, specs, n_features, classes

    @property
    def width(self) -> int:
        return self.classes or 1


def training_table(df: DataFrame, features: str, label: str, fold: str | None = None) -> DataFrame:
    """(rid, x, y, fold) with fixed row ids, in the shared folder."""
    from assay.operators.knn import _vec_array
    return settled(df.select(_vec_array(df, features).alias("x"), F.col(label).cast("double").alias("y"),
                             (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"))
                   .where("y is not null").withColumn("rid", F.monotonically_increasing_id()))


def fit(data: DataFrame, specs: list[ForestSpec], bound: int = BOUND) -> Forests:
    """Grow all ``specs`` from ``data(rid, x, y, fold)``."""
    spark = data.sparkSession
    n, n_features = data.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n:
        raise ValueError("no labelled rows to grow trees from")
    classes, root = specs[0].rule.classes, max(1, math.isqrt(n_features))
    specs = [replace(s, rule=replace(s.rule, max_features=root)) if s.rule.max_features == SQRT else s for s in specs]
    tops = _grow_tops(data, specs, n, n_features, classes, bound)
    # a unit is what one task finishes: the same drawn rows serve every rule that needs them
    units: dict = {}
    for s, spec in enumerate(specs):
        for t in range(spec.trees):
            top = tops[s, t]
            for slot, (at, path) in enumerate(top.paths().items()):
                key = (spec.skip_fold, spec.seed if spec.bootstrap else None, t if spec.bootstrap else 0, path)
                units.setdefault(key, []).append((s, t, slot, top.depth[at]))
    members = list(units.values())
    dealers: dict = {}
    for u, group in enumerate(members):
        s, t, slot, _ = group[0]
        dealers.setdefault((s, t), {})[slot] = u

    def deal(batches):
        for b in batches:
            a = _arrays(b)
            if not len(a["rid"]):
                continue
            for (s, t), by_slot in dealers.items():
                w = drawn(a, specs[s], t)
                lookup = np.full(max(by_slot) + 1 if len(tops[s, t].feature) == 1 else len(tops[s, t].ends()), -1)
                lookup[list(by_slot)] = list(by_slot.values())
                unit = lookup[tops[s, t].slots(a["x"])]
                rows = np.flatnonzero((w > 0) & (unit >= 0))
                if len(rows):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(unit[rows], pa.int32()), pa.array(a["rid"][rows]), _matrix(a["x"][rows]),
                         pa.array(a["y"][rows]), pa.array(w[rows])], names=["unit", "rid", "x", "y", "w"])

    def finish(table: pa.Table) -> pa.Table:
        a = _arrays(table.sort_by("rid"))
        out = []
        for s, t, slot, depth in members[a["unit"][0]]:
            spec = specs[s]
            tree = grow(a["x"], a["y"], a["w"], spec.rule, np.random.default_rng([spec.seed, t, slot]), depth)
            out.append({"spec": s, "tree": t, "slot": slot, "feature": tree.feature, "threshold": tree.threshold,
                        "left": tree.left, "right": tree.right, "value": tree.value.ravel(), "weight": tree.weight,
                        "gains": tree.importances(n_features)})
        return pa.Table.from_arrays([pa.array([r[c] for r in out], t) for c, t in _NODE_TYPES], names=[c for c, _ in _NODE_TYPES])

    ship_package(spark)
    tasks = max(min(len(members), MOST_TASKS), len(members) // UNITS_PER_TASK)
    dealt = data.mapInArrow(deal, "unit int, rid long, x array<double>, y double, w double").repartition(tasks, "unit")
    path = scratch_path(spark, "forest")
    dealt.groupBy("unit").applyInArrow(finish, NODES).write.parquet(path)
    return Forests(spark.read.parquet(path), tops, specs, n_features, classes)


# --------------------------------------------------------------------------- scores of left-out folds

def whole_trees(n: int, n_features: int) -> bool:
    """Whether a task may hold all rows (``left_out_sums``)."""
    return n * max(1, n_features) <= WHOLE_NUMBERS


def left_out_sums(data: DataFrame, specs: list[ForestSpec], limits: list[int]) -> DataFrame:
    """``(rid, fold, y, p)``: what the forests that did not see a row's fold give it, the sums
    over the first ``limits`` trees (increasing) of each of the fold's specs, one after the
    other (limit, spec, class).  Every fold has the same number of specs, which differ by
    their rules only.

    A task has all rows (``whole_trees``) and grows ``TREES_PER_TASK`` trees of every rule for
    one left-out fold (rules that differ in depth share them); it scores that fold's rows at
    once and drops the trees.  So neither trees nor drawn rows are written: rows travel once
    per task, not once per tree."""
    spark = data.sparkSession
    n_features = data.agg(F.max(F.size("x"))).first()[0]
    classes, root = specs[0].rule.classes, max(1, math.isqrt(n_features))
    specs = [replace(s, rule=replace(s.rule, max_features=root)) if s.rule.max_features == SQRT else s for s in specs]
    of: dict = {}
    for s in specs:
        of.setdefault(s.skip_fold, []).append(s)
    width, n_rules = classes or 1, max(map(len, of.values()))
    size = len(limits) * n_rules * width
    groups = [(j, t, min(t + TREES_PER_TASK, high)) for j, (low, high) in enumerate(zip([0, *limits], limits))
              for t in range(low, high, TREES_PER_TASK)]

    def finish(table: pa.Table) -> pa.Table:
        skip, (segment, first, end) = table["skip"][0].as_py(), groups[table["part"][0].as_py()]
        a = _arrays(table.select(["rid", "x", "y", "fold"]).sort_by("rid"))
        own = np.flatnonzero(a["fold"] == skip)
        total = np.zeros((len(own), len(limits), n_rules, width))
        for t in range(first, end):
            made, grown = {}, {}
            for r, spec in enumerate(of[skip]):
                key = (spec.bootstrap, spec.seed)
                if key not in made:
                    w = drawn(a, spec, t)
                    rows = np.flatnonzero(w > 0)
                    made[key] = a["x"][rows], a["y"][rows], w[rows]
                x, y, w = made[key]
                if not len(w):
                    continue
                # a tree of less depth is the upper part of the deepest one by the same rule
                alike = replace(spec, rule=replace(spec.rule, max_depth=None))
                if alike not in grown:
                    depths = [o.rule.max_depth for o in of[skip] if replace(o, rule=replace(o.rule, max_depth=None)) == alike]
                    rule = replace(spec.rule, max_depth=None if None in depths else max(depths))
                    grown[alike] = grow(x, y, w, rule, np.random.default_rng([spec.seed, t, 0]))
                total[:, segment:, r] += grown[alike].predict(a["x"][own], spec.rule.max_depth)[:, None]
        return pa.Table.from_arrays([pa.array(a["rid"][own]), _matrix(total.reshape(len(own), size))], names=["rid", "p"]) \
            if len(own) else pa.table({"rid": pa.array([], pa.int64()), "p": pa.array([], pa.list_(pa.float64()))})

    ship_package(spark)
    copies = F.explode(F.array(*[F.struct(F.lit(f).alias("skip"), F.lit(g).alias("part")) for f in of for g in range(len(groups))]))
    dealt = data.select("rid", "x", "y", "fold", copies.alias("c")).select("rid", "x", "y", "fold", "c.*") \
        .repartition(len(of) * len(groups), "skip", "part")
    sums = dealt.groupBy("skip", "part").applyInArrow(finish, "rid long, p array<double>") \
        .groupBy("rid").agg(F.array(*[F.sum(F.col("p")[i]) for i in range(size)]).alias("p"))
    return data.select("rid", "fold", "y").join(sums, "rid")


# --------------------------------------------------------------------------- scoring

def score(forests: Forests, rows: DataFrame, limits: list[int] | None = None) -> DataFrame:
    """``(qid, spec, p)`` for ``rows(qid, spec, x)``: the mean over the trees of forest
    ``spec`` of a row's value (regression) or class shares.  ``limits`` asks for the means
    over the first so many trees, one after the other in ``p``."""
    spark, width, specs, tops = rows.sparkSession, forests.width, forests.specs, forests.tops
    sizes = forests.nodes.select("spec", "tree", "slot", F.size("feature").alias("n")).collect()   # a line per subtree
    block, filled, block_of, of_tree = 0, 0, {}, {}
    for r in sorted(sizes, key=lambda r: (r["spec"], r["tree"], r["slot"])):
        if filled and filled + r["n"] > BLOCK_NODES:
            block, filled = block + 1, 0
        filled += r["n"]
        block_of[r["spec"], r["tree"], r["slot"]] = block
        of_tree.setdefault(r["spec"], {}).setdefault(r["tree"], {})[r["slot"]] = block
    n_blocks = block + 1

    def locate(batches):
        for b in batches:
            a = _arrays(b)
            for s in np.unique(a["spec"]).tolist():
                rows_ = np.flatnonzero(a["spec"] == s)
                x, needs = a["x"][rows_], np.zeros((len(rows_), n_blocks), dtype=bool)
                for t, by_slot in of_tree.get(s, {}).items():
                    if len(by_slot) == 1:
                        needs[:, next(iter(by_slot.values()))] = True
                    else:
                        table = np.zeros(max(by_slot) + 1, dtype=np.int64)
                        table[list(by_slot)] = list(by_slot.values())
                        needs[np.arange(len(rows_)), table[tops[s, t].slots(x)]] = True
                for k in range(n_blocks):
                    at = np.flatnonzero(needs[:, k])
                    if len(at):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(a["qid"][rows_[at]]), pa.array(np.full(len(at), s, dtype=np.int32)), _matrix(x[at]),
                             pa.array(np.full(len(at), k, dtype=np.int32))], names=["qid", "spec", "x", "block"])

    def add_up(left: pa.Table, right: pa.Table) -> pa.Table:
        a = _arrays(left.select(["qid", "spec", "x"]))
        n_limits = len(limits or [0])
        total = np.zeros((len(a["qid"]), n_limits, width))
        seen: dict = {}
        for batch in right.to_batches(max_chunksize=16):
            for i in range(batch.num_rows):
                s, t, slot = (batch.column(c)[i].as_py() for c in ("spec", "tree", "slot"))
                if s not in seen:
                    seen[s] = np.flatnonzero(a["spec"] == s)
                at = seen[s]
                if not len(at):
                    continue
                if len(tops[s, t].feature) > 1:
                    at = at[tops[s, t].slots(a["x"][at]) == slot]
                feature, threshold, left_, right_, value = (batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in
                                                            ("feature", "threshold", "left", "right", "value"))
                tree = Tree(feature, threshold, left_, right_, value.reshape(-1, width), None, None)
                value = tree.predict(a["x"][at])
                for j, m in enumerate(limits or [specs[s].trees]):
                    if t < m:
                        total[at, j] += value / m
        return pa.Table.from_arrays([pa.array(a["qid"]), pa.array(a["spec"], pa.int32()), _matrix(total.reshape(len(total), -1))],
                                    names=["qid", "spec", "p"])

    ship_package(spark)
    parts = -(-rows.count() // BLOCK_ROWS) or 1
    located = rows.select("qid", "spec", "x").mapInArrow(locate, "qid long, spec int, x array<double>, block int") \
        .withColumn("part", F.pmod(F.xxhash64("qid"), F.lit(parts)))
    side = spark.createDataFrame([(*k, b) for k, b in block_of.items()], "spec int, tree int, slot int, block int")
    nodes = forests.nodes.drop("weight", "gains").join(side, ["spec", "tree", "slot"]) \
        .withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    tasks = max(n_blocks * parts, 1)
    keys = ["block", "part"]
    sums = located.repartition(tasks, *keys).groupBy(*keys).cogroup(nodes.repartition(tasks, *keys).groupBy(*keys)) \
        .applyInArrow(add_up, "qid long, spec int, p array<double>")
    if n_blocks == 1:
        return sums
    size = width * len(limits or [0])
    return sums.groupBy("qid", "spec").agg(F.array(*[F.sum(F.col("p")[i]) for i in range(size)]).alias("p"))


def importances(forests: Forests, spec: int = 0) -> np.ndarray:
    """Mean over the trees of each feature's share of the impurity a tree takes away.
    Splits of top trees count with the gain their histogram gave only through the subtrees
    below; they are added from the nodes' weights and values."""
    per_tree = forests.nodes.where(F.col("spec") == spec).groupBy("tree").agg(
        *[F.sum(F.col("gains")[f]).alias(f"g{f}") for f in range(forests.n_features)])
    gains = {r["tree"]: np.array([r[f"g{f}"] for f in range(forests.n_features)]) for r in per_tree.collect()}
    with_top = [t for t in gains if len(forests.tops[spec, t].feature) > 1]
    if with_top:
        roots = forests.nodes.where((F.col("spec") == spec) & F.col("tree").isin(with_top)).select(
            "tree", "slot", F.col("weight")[0].alias("w"), F.slice("value", 1, forests.width).alias("v")).collect()
        at: dict = {}
        for r in roots:
            at.setdefault(r["tree"], {})[r["slot"]] = (r["w"], np.array(r["v"]))
        for t in with_top:
            gains[t] = gains[t] + _top_gains(forests.tops[spec, t], at[t], forests.n_features)
    shares = [g / g.sum() for g in gains.values() if g.sum() > 0]
    out = np.mean(shares, axis=0) if shares else np.zeros(forests.n_features)
    return out / out.sum() if out.sum() > 0 else out


def _top_gains(top: Top, ends: dict, n_features: int) -> np.ndarray:
    """Gains of a top tree's splits from the weight and value of the subtrees at its ends."""
    w, s, out = {}, {}, np.zeros(n_features)
    for i in reversed(range(len(top.feature))):
        if top.feature[i] < 0:
            w[i], value = ends.get(top.slot[i], (0.0, 0.0))
            s[i] = w[i] * value
            continue
        a, b = top.left[i], top.right[i]
        w[i], s[i] = w[a] + w[b], s[a] + s[b]
        square = [float((s[j] * s[j]).sum() / w[j]) if w[j] else 0.0 for j in (a, b, i)]
        out[top.feature[i]] += max(0.0, square[0] + square[1] - square[2])
    return out


# --------------------------------------------------------------------------- estimator and model

class ForestEstimator(Estimator):
    """A forest (or, with one tree and no bootstrap, a decision tree) over a vector column."""

    def __init__(self, spec: ForestSpec, featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self.spec, self.features, self.label = spec, featuresCol, labelCol

    def _fit(self, df):
        return ForestModel(fit(training_table(df, self.features, self.label), [self.spec]), 0, self.features)


class ForestModel(Model, MLWritable, MLReadable):
    """Adds ``prediction`` and, for classes, ``probability`` (the lowest class wins ties)."""

    def __init__(self, forests: Forests | None = None, spec: int = 0, features: str = "features"):
        super().__init__()
        self.forests, self.spec, self.features = forests, spec, features
        self._importances = None

    @property
    def featureImportances(self) -> DenseVector:
        if self._importances is None:
            self._importances = DenseVector(importances(self.forests, self.spec))
        return self._importances

    def getNumTrees(self) -> int:
        return self.forests.specs[self.spec].trees

    def _transform(self, df):
        from assay.operators.knn import _vec_array
        q = settled(df.withColumn("_qid", F.monotonically_increasing_id()))
        p = score(self.forests, q.select(F.col("_qid").alias("qid"), F.lit(self.spec).alias("spec"),
                                         _vec_array(q, self.features).alias("x")))
        p = p.select(F.col("qid").alias("_qid"), *predicted(F.col("p"), self.forests.classes))
        return q.join(p, "_qid").drop("_qid")

    def write(self):
        return _ForestWriter(self)

    @classmethod
    def read(cls):
        return _ForestReader()


def predicted(p, classes: int) -> list:
    """Prediction columns from a row's mean value or class shares."""
    if not classes:
        return [p[0].alias("prediction")]
    return [array_to_vector(p).alias("probability"), (F.array_position(p, F.array_max(p)) - 1).cast("double").alias("prediction")]


class _ForestWriter(MLWriter):
    def __init__(self, model: ForestModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        m, f = self.model, self.model.forests
        spec = f.specs[m.spec]
        extra = {"spec": {**asdict(spec), "rule": asdict(spec.rule)}, "features": m.features, "n_features": f.n_features,
                 "classes": f.classes}
        DefaultParamsWriter.saveMetadata(m, path, self.sparkSession, extraMetadata={"extra": extra})
        f.nodes.where(F.col("spec") == m.spec).withColumn("spec", F.lit(0)).write.parquet(f"{path}/nodes")
        tops = [(t, top.feature, top.threshold, top.left, top.right, top.slot, top.depth)
                for (s, t), top in f.tops.items() if s == m.spec]
        self.sparkSession.createDataFrame(tops, "tree int, feature array<int>, threshold array<double>, left array<int>, "
                                                "right array<int>, slot array<int>, depth array<int>").write.parquet(f"{path}/tops")


class _ForestReader(MLReader):
    def load(self, path: str) -> ForestModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        e = meta["extra"]
        spec = ForestSpec(**{**e["spec"], "rule": TreeRule(**e["spec"]["rule"])})
        tops = {}
        for r in self.sparkSession.read.parquet(f"{path}/tops").collect():
            top = tops[0, r["tree"]] = Top()
            for c in ("feature", "threshold", "left", "right", "slot", "depth"):
                setattr(top, c, list(r[c]))
        model = ForestModel(Forests(self.sparkSession.read.parquet(f"{path}/nodes"), tops, [spec], e["n_features"],
                                    e["classes"]), 0, e["features"])
        model._resetUid(meta["uid"])
        return model
