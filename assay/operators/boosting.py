"""Gradient boosting by shared histogram scans.

Several ensembles (one per left-out fold, say) grow round by round together.  A round fits
one regression tree per ensemble and output to the current residuals: least squares for
regression, the binomial deviance for two classes, the multinomial deviance (softmax over
one output per class) for more.  A level of all these trees is one scan: tasks add up
count, residual and curvature per node, feature and bin; the sums, whose number depends on
features, bins and ensembles but not on rows, reach the driver, which picks the splits.
Leaf values are means (least squares) or Newton steps from the same sums.

Rows are packed: one table row holds the bin numbers, labels and scores of a batch of
rows as bytes, feature after feature, so that a scan hands them to numpy without a conversion
per number and small trees place their rows by whole-column comparisons.  Features whose bins
coincide on every row (a column and its logarithm) are counted once.  The
scores of the finished rounds are written anew every ``WRITE_ROUNDS`` rounds, so a scan adds only the last few trees, and lineage stays
short.  Because every ensemble scores all rows, the scores of left-out rows come for free.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from assay.operators._small import settled
from assay.operators.forest import _arrays, _cuts, _matrix, training_table
from assay.session import ship_package

WRITE_ROUNDS = 10
ROWS_PER_TASK = 8_192
FEW_NODES = 64              # nodes of a tree up to which its rows are placed node by node
FEW_NUMBERS = 4_000_000     # sums of all tasks up to which the driver adds them up
PACKED = "rid binary, b binary, y binary, fold binary, score binary"


@dataclass(frozen=True)
class BoostSpec:
    """One ensemble; ``classes`` 0 means regression."""
    classes: int = 0
    rounds: int = 100
    rate: float = 0.1
    depth: int = 3
    skip_fold: int | None = None

    @property
    def outputs(self) -> int:
        return self.classes if self.classes > 2 else 1


class SmallTree:
    """A tree as flat arrays; ``feature`` -1 marks a leaf, ``bin`` the last bin going left."""

    def __init__(self):
        self.feature, self.bin, self.left, self.right, self.value, self.cover = [-1], [0], [-1], [-1], [0.0], [0.0]

    def split(self, at: int, feature: int, bin_: int, values, covers) -> tuple[int, int]:
        n = len(self.feature)
        self.feature[at], self.bin[at], self.left[at], self.right[at] = feature, bin_, n, n + 1
        for v, c in zip(values, covers):
            for column, x in zip((self.feature, self.bin, self.left, self.right, self.value, self.cover), (-1, 0, -1, -1, v, c)):
                column.append(x)
        return n, n + 1

    def place_columns(self, columns, cuts) -> np.ndarray:
        """Leaf of each row of ``columns`` (one line per feature): for a few nodes one
        comparison of a whole column per node, whose bytes choose between the sides' leaves."""
        if len(self.feature) > FEW_NODES:
            return self.place(np.stack(columns, axis=1), cuts)

        def leaf(i):
            f = self.feature[i]
            if f < 0:
                return np.uint8(i)
            goes_left = np.negative((columns[f] <= cuts[i]).view(np.uint8))         # 255 or 0; NaN goes right
            left, right = leaf(self.left[i]), leaf(self.right[i])
            return right ^ ((left ^ right) & goes_left)
        at = leaf(0)
        return at if np.ndim(at) else np.zeros(len(columns[0]), dtype=np.uint8)

    def place(self, x: np.ndarray, cuts) -> np.ndarray:
        """Leaf of each row; ``cuts`` are the thresholds the nodes compare with."""
        feature, left, right = np.array(self.feature), np.array(self.left), np.array(self.right)
        cuts, at, rows = np.asarray(cuts), np.zeros(len(x), dtype=np.int64), np.arange(len(x))
        while len(rows):
            f = feature[at[rows]]
            rows, f = rows[f >= 0], f[f >= 0]
            here = at[rows]
            at[rows] = np.where(x[rows, f] <= cuts[here], left[here], right[here])
        return at


def residuals(y: np.ndarray, score: np.ndarray, classes: int) -> tuple[np.ndarray, np.ndarray]:
    """Negative gradient and curvature of the loss, per row and output."""
    if not classes:
        return y[:, None] - score, np.ones_like(score)
    if classes == 2:
        p = 1 / (1 + np.exp(-score))
        return y[:, None] - p, p * (1 - p)
    p = softmax(score)
    r = (y[:, None] == np.arange(classes)) - p
    return r, np.abs(r) * (1 - np.abs(r))


def softmax(score: np.ndarray) -> np.ndarray:
    e = np.exp(score - score.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def leaf_value(r: float, h: float, classes: int) -> float:
    """Mean residual, or one Newton step of the deviance."""
    if h < 1e-150:
        return 0.0
    return r / h * ((classes - 1) / classes if classes > 2 else 1.0)


class Boosted:
    """Ensembles of one fit: start scores, trees[round][ensemble][output], thresholds per
    feature, and the table of final scores (rid, y, fold, score)."""

    def __init__(self, specs, starts, trees, cuts, table):
        self.specs, self.starts, self.trees, self.cuts, self.table = specs, starts, trees, cuts, table

    def at(self, e: int) -> slice:
        a = sum(s.outputs for s in self.specs[:e])
        return slice(a, a + self.specs[e].outputs)

    def model(self, e: int = 0, features: str = "features") -> BoostedModel:
        spec = self.specs[e]
        flat = [[[t.feature, [float(self.cuts[f][b]) if f >= 0 else 0.0 for f, b in zip(t.feature, t.bin)], t.left, t.right,
                  [v * spec.rate for v in t.value], t.cover] for t in group[e]] for group in self.trees]
        return BoostedModel(featuresCol=features, state=json.dumps(
            {"classes": spec.classes, "start": self.starts[e].tolist(), "trees": flat}))

    def left_out(self) -> DataFrame:
        """(fold, y, prediction) of every row by the ensemble that did not see its fold."""
        s = F.array()
        for e, spec in enumerate(self.specs):
            if spec.skip_fold is not None:
                at = self.at(e)
                s = F.when(F.col("fold") == spec.skip_fold, F.slice("score", at.start + 1, spec.outputs)).otherwise(s)
        return self.table.select("fold", "y", decision(s, self.specs[0].classes)[0].alias("prediction"))


def decision(score, classes: int) -> list:
    """Prediction and, for classes, the probability array of a score array."""
    if not classes:
        return [score[0]]
    if classes == 2:
        p = 1 / (1 + F.exp(-score[0]))
        return [(score[0] > 0).cast("double"), F.array(1 - p, p)]
    top = F.array_max(score)
    e = F.transform(score, lambda v: F.exp(v - top))
    total = F.aggregate(e, F.lit(0.0), lambda a, b: a + b)
    return [(F.array_position(score, top) - 1).cast("double"), F.transform(e, lambda v: v / total)]


def fit(data: DataFrame, specs: list[BoostSpec]) -> Boosted:
    """Grow all ``specs`` (of one task, depth, rate and number of rounds) from
    ``data(rid, x, y, fold)``."""
    spark, first = data.sparkSession, specs[0]
    ship_package(spark)
    per_fold = {r["fold"]: r for r in data.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.size("x")).alias("d"), F.sum("y").alias("s"),
        F.array(*[F.count_if(F.col("y") == k) for k in range(max(first.classes, 1))]).alias("c")).collect()}
    if not per_fold:
        raise ValueError("no labelled rows to boost on")
    n_features, n = max(r["d"] for r in per_fold.values()), sum(r["n"] for r in per_fold.values())
    starts = [_start([r for f, r in per_fold.items() if f != s.skip_fold], s.classes) for s in specs]
    cuts = _cuts(data, n_features)
    width = max(len(c) for c in cuts) + 1
    owner = [(e, o) for e, s in enumerate(specs) for o in range(s.outputs)]
    start = np.concatenate(starts)

    def prepare(batches):
        for a in map(_arrays, batches):
            if len(a["rid"]):
                bins = np.column_stack([np.searchsorted(c, a["x"][:, f], side="left") for f, c in enumerate(cuts)])
                yield _packed(a["rid"], bins.astype(np.uint8).T, a["y"], a["fold"], np.tile(start, (len(bins), 1)))

    parts = data.rdd.getNumPartitions()
    tasks = min(max(parts, spark.sparkContext.defaultParallelism), -(-n // ROWS_PER_TASK))
    packed = (data.coalesce(tasks) if tasks < parts else data).mapInArrow(prepare, PACKED)
    table = settled(packed.repartition(tasks) if tasks > parts else packed)     # few files: packs dealt to all cores
    same = _same_bins(table, list(range(n_features)), len(owner))
    done, recent, counts = [], [], {}
    for _ in range(first.rounds):
        trees = _round(table, specs, owner, recent, same, width, cuts, tasks, counts)
        done.append([[trees[i] for i, (e, _) in enumerate(owner) if e == k] for k in range(len(specs))])
        recent.append(trees)
        if len(recent) == WRITE_ROUNDS or len(done) == first.rounds:
            table, recent = settled(table.mapInArrow(_scored(recent, first.rate, same, len(owner)), PACKED)), []
    def unpack(batches):
        for a in _unpacked(batches, same, len(owner)):
            yield pa.RecordBatch.from_arrays([pa.array(a["rid"]), pa.array(a["y"]), pa.array(a["fold"], pa.int32()), _matrix(a["score"])],
                                             names=["rid", "y", "fold", "score"])
    return Boosted(specs, starts, done, cuts, table.mapInArrow(unpack, "rid long, y double, fold int, score array<double>"))


def _packed(rid, b, y, fold, score) -> pa.RecordBatch:
    columns = (rid.astype(np.int64), b, y.astype(np.float64), fold.astype(np.int32), score.astype(np.float64))
    return pa.RecordBatch.from_arrays([pa.array([np.ascontiguousarray(c).tobytes()], pa.binary()) for c in columns],
                                      names=["rid", "b", "y", "fold", "score"])


def _unpacked(batches, same: list[int], outputs: int):
    """The packs' columns; ``b`` a list of the features' bins.  A pack holds the bins of all
    features, or of those only that stand for others (``same``)."""
    types, kept = {"rid": np.int64, "b": np.uint8, "y": np.float64, "fold": np.int32, "score": np.float64}, sorted(set(same))
    for batch in batches:
        for i in range(batch.num_rows):
            a = {c: np.frombuffer(batch.column(c)[i].as_buffer(), dtype=types[c]) for c in batch.schema.names}
            score = a["score"].reshape(-1, outputs)
            b = a["b"].reshape(-1, len(score))
            yield a | {"b": [b[f] for f in same] if len(b) == len(same) else [b[kept.index(f)] for f in same], "score": score}


def _start(rows, classes: int) -> np.ndarray:
    """Scores that fit best without a tree."""
    n = sum(r["n"] for r in rows)
    if not n:
        return np.zeros(classes if classes > 2 else 1)
    if not classes:
        return np.array([sum(r["s"] for r in rows) / n])
    p = np.clip(np.array([sum(r["c"][k] for r in rows) for k in range(classes)]) / n, 1e-15, 1 - 1e-15)
    return np.array([np.log(p[1] / (1 - p[1]))]) if classes == 2 else np.log(p)


def _added(a: dict, recent, rate: float) -> np.ndarray:
    score = a["score"].copy()
    for trees in recent:
        for i, t in enumerate(trees):
            score[:, i] += (rate * np.array(t.value)).take(t.place_columns(a["b"], t.bin))
    return score


def _scored(recent, rate: float, same: list[int], outputs: int):
    def run(batches):
        for a in _unpacked(batches, same, outputs):
            yield _packed(a["rid"], np.stack([a["b"][f] for f in sorted(set(same))]), a["y"], a["fold"], _added(a, recent, rate))
    return run


def _same_bins(table, each: list[int], outputs: int) -> list[int]:
    """For each feature the first one that has the same bin in every row."""
    n_features = len(each)
    pairs = [(f, g) for g in range(n_features) for f in range(g)]

    def run(batches):
        left = pairs
        for a in _unpacked(batches, each, outputs):
            left = [(f, g) for f, g in left if np.array_equal(a["b"][f], a["b"][g])]
        yield pa.RecordBatch.from_arrays([pa.array([[f * n_features + g for f, g in left]], pa.list_(pa.int32()))], names=["same"])

    left = set(f * n_features + g for f, g in pairs)
    for r in table.select("b", "score").mapInArrow(run, "same array<int>").distinct().collect():
        left &= set(r["same"])
    return [min([f for f in range(g) if f * n_features + g in left], default=g) for g in range(n_features)]


def _round(table, specs, owner, recent, same, width: int, cuts, tasks: int, counts: dict) -> list[SmallTree]:
    """One tree per ensemble and output, level by level.  ``same`` names for each feature the one
    that is counted for it; ``counts`` keeps the roots' rows by feature and bin, which do not
    change from round to round."""
    first, n_features = specs[0], len(same)
    counted = sorted(set(same))
    trees = [SmallTree() for _ in owner]
    open_ = [(i, 0) for i in range(len(owner))]
    cells = np.array([len(c) for c in cuts])
    for level in range(first.depth):
        if not open_:
            break
        with_rows = level > 0 or not counts
        curved = bool(first.classes)        # least squares: curvature 1
        kinds = [k for k, wanted in enumerate((with_rows, True, curved)) if wanted]

        def run(batches, open_=open_, trees=trees, kinds=kinds):
            by_tree: dict = {}
            for j, (i, at) in enumerate(open_):
                by_tree.setdefault(i, {})[at] = j
            hist = {i: np.zeros((len(counted), len(kinds), (len(ends) + 1) * width)) for i, ends in by_tree.items()}
            # rows that take no part go to a node of their own, which is dropped
            cell_of = {}
            for i, ends in by_tree.items():
                cell_of[i] = np.full(len(trees[i].feature), len(ends) * width)
                cell_of[i][list(ends)] = np.arange(len(ends)) * width
            for a in _unpacked(batches, same, len(owner)):
                score, known, bins = _added(a, recent, first.rate), {}, a["b"]
                for i, ends in by_tree.items():
                    e, o = owner[i]
                    if e not in known:
                        cols = [k for k, (own, _) in enumerate(owner) if own == e]
                        known[e] = residuals(a["y"], score[:, cols], specs[e].classes)
                    first_cell = cell_of[i].take(trees[i].place_columns(bins, trees[i].bin))
                    if specs[e].skip_fold is not None:
                        first_cell[a["fold"] == specs[e].skip_fold] = len(ends) * width
                    r, h = (np.ascontiguousarray(v[:, o]) for v in known[e])
                    total, size = hist[i], (len(ends) + 1) * width
                    for c, f in enumerate(counted):
                        cell = first_cell + bins[f]
                        for k, kind in enumerate(kinds):
                            total[c, k] += np.bincount(cell, (None, r, h)[kind], size)
            out = np.zeros((len(open_), len(counted), width, len(kinds)))
            for i, ends in by_tree.items():
                found = hist[i].reshape(len(counted), len(kinds), len(ends) + 1, width)
                out[list(ends.values())] = found[:, :, :-1].transpose(2, 0, 3, 1)
            at, c = np.divmod(np.arange(len(open_) * len(counted)), len(counted))
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(c, pa.int32()), _matrix(out.reshape(len(at), -1))],
                                             names=["node", "f", "h"])

        read = ["b", "y", "score"] + ["fold"] * any(s.skip_fold is not None for s in specs)
        sums = table.select(*read).mapInArrow(run, "node int, f int, h array<double>")
        if tasks * len(open_) * len(counted) * width * len(kinds) > FEW_NUMBERS:
            sums = sums.groupBy("node", "f").agg(vector_to_array(Summarizer.sum(array_to_vector("h"))).alias("h"))
        some = np.zeros((len(open_), len(counted), width, len(kinds)))
        for r in sums.toArrow().to_batches():
            at, f = r.column(0).to_numpy(), r.column(1).to_numpy()
            np.add.at(some, (at, f), r.column(2).flatten().to_numpy(zero_copy_only=False).reshape(len(at), width, len(kinds)))
        got = np.zeros((len(open_), n_features, width, 3))
        got[..., kinds] = some[:, [counted.index(f) for f in same]]
        if not with_rows:
            got[..., 0] = np.stack([counts[i] for i, _ in open_])
        elif level == 0:
            counts.update((i, got[j, ..., 0].copy()) for j, (i, _) in enumerate(open_))
        if not curved:
            got[..., 2] = got[..., 0]
        following = []
        for j, (i, at) in enumerate(open_):
            classes = specs[owner[i][0]].classes
            left = np.cumsum(got[j], axis=1)
            whole = left[0, -1]
            if at == 0 and level == 0:
                trees[i].value[0], trees[i].cover[0] = leaf_value(whole[1], whole[2], classes), float(whole[0])
            right = whole - left
            with np.errstate(divide="ignore", invalid="ignore"):
                gain = left[..., 1] ** 2 / left[..., 0] + right[..., 1] ** 2 / right[..., 0]
            gain[(left[..., 0] < 0.5) | (right[..., 0] < 0.5) | (np.arange(width)[None] >= cells[:, None])] = -np.inf
            f, b = np.unravel_index(int(gain.argmax()), gain.shape)
            if not np.isfinite(gain[f, b]) or gain[f, b] - whole[1] ** 2 / whole[0] <= 1e-14 * max(1e-300, abs(gain[f, b])):
                continue
            sides = left[f, b], right[f, b]
            kids = trees[i].split(at, int(f), int(b), [leaf_value(s[1], s[2], classes) for s in sides], [float(s[0]) for s in sides])
            following += [(i, kid) for kid, s in zip(kids, sides) if s[0] > 1.5]
        open_ = following
    return trees


class BoostedEstimator(Estimator):
    def __init__(self, spec: BoostSpec, featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self.spec, self.features, self.label = spec, featuresCol, labelCol

    def setMaxIter(self, rounds: int) -> BoostedEstimator:
        self.spec = replace(self.spec, rounds=rounds)
        return self

    def _fit(self, df):
        return fit(training_table(df, self.features, self.label), [self.spec]).model(0, self.features)


class BoostedModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction`` and, for classes, ``rawPrediction`` and ``probability``."""
    featuresCol = Param(Params._dummy(), "featuresCol", "", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "", TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol=None, state=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df):
        from assay.operators.knn import _vec_array
        ship_package(df.sparkSession)
        st = json.loads(self.getOrDefault(self.state))
        classes = st["classes"]
        out = df.withColumn("_score", _score_udf(st)(_vec_array(df, self.getOrDefault(self.featuresCol))))
        cols = decision(F.col("_score"), classes)
        out = out.withColumn("prediction", cols[0])
        if classes:
            out = out.withColumn("rawPrediction", array_to_vector("_score")).withColumn("probability", array_to_vector(cols[1]))
        return out.drop("_score")

    def outputs(self) -> int:
        return len(json.loads(self.getOrDefault(self.state))["start"])

    def trees(self, output: int = 0) -> tuple[float, list[dict]]:
        """Start score and the trees of one output: node -> (value, cover, left, right,
        feature, threshold), values times the learning rate."""
        st = json.loads(self.getOrDefault(self.state))
        out = []
        for group in st["trees"]:
            feature, threshold, left, right, value, cover = group[output]
            out.append({i: (value[i], cover[i], left[i], right[i], feature[i], threshold[i]) for i in range(len(feature))})
        return st["start"][output], out


def score_matrix(state: dict, x: np.ndarray) -> np.ndarray:
    """Scores of the rows of ``x``, one column per output."""
    out = np.tile(np.array(state["start"]), (len(x), 1))
    tree, columns = SmallTree(), np.ascontiguousarray(x.T)
    for group in state["trees"]:
        for o, (feature, threshold, left, right, value, _) in enumerate(group):
            tree.feature, tree.left, tree.right = feature, left, right
            out[:, o] += np.array(value)[tree.place_columns(columns, threshold)]
    return out


def _score_udf(state: dict):
    @arrow_udf("array<double>")
    def score(x: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.list_(pa.float64()))
        return _matrix(score_matrix(state, x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)))
    return score
