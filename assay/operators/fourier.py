"""RBF support vector machines (M10, M16) by random Fourier features that are never stored.

A row's features z(x) = sqrt(2/D) cos(W x + b), W ~ N(0, 2 gamma), b ~ U(0, 2 pi) (Rahimi &
Recht 2007), gamma = 1 / (d * Var(X)) as the 'scale' rule, are made anew in every scan from
its x, a batch at a time, and leave a task only as sums: loss, gradient and Hessian of the
penalised fit, whose Newton steps the driver takes (D + 2 numbers a fit).  So a fit reads its
rows some dozens of times and holds one batch of features per task, whatever the number of rows.
Fits of all classes and left-out folds go through the same scans.

* Regression: Huber's loss with its scale (Owen 2007), as Spark ML's ``loss="huber"``.
* Classes: the hinge, one class against the rest, its corner rounded over a band that ends at
  0.01 (Chapelle 2007); two classes get probabilities by a logistic curve over the margins of
  the training rows (Platt 1999), more by a softmax.

Both penalise half the squared coefficients by 1 / n, not the intercept.
"""

from __future__ import annotations

import json
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators._small import collect_bounded, settled
from assay.session import ship_package

FEATURES = 200
EPSILON = 1.35                              # Huber's: residuals up to so many scales count squared
BANDS = (1.0, 0.3, 0.1, 0.03, 0.01)         # half widths of the hinge's rounded corner, one after the other
LEAST_SCALE = 1e-3                          # Huber's scale is at least this share of the labels' deviation
CHUNK = 8_192                               # rows whose features are held at once
MAX_SCANS = 200
MAX_FOLDS = 1_000


@dataclass(frozen=True)
class FourierMap:
    w: np.ndarray
    b: np.ndarray

    @classmethod
    def draw(cls, gamma: float, d: int, features: int, seed: int) -> FourierMap:
        rng = np.random.default_rng(seed)
        return cls(rng.normal(0.0, math.sqrt(2 * gamma), size=(features, d)), rng.uniform(0, 2 * math.pi, size=features))

    def features(self, x: np.ndarray) -> np.ndarray:
        """z(x) and, last, a column of ones for the intercept."""
        out = np.empty((len(x), len(self.b) + 1))
        np.cos(x @ self.w.T + self.b, out=out[:, :-1])
        out[:, :-1] *= math.sqrt(2.0 / len(self.b))
        out[:, -1] = 1.0
        return out


@dataclass(frozen=True)
class Huber:
    """Parameters: coefficients, intercept, scale."""
    extra: int = 1

    def loss(self, s: np.ndarray, y: np.ndarray, theta: np.ndarray) -> float:
        r, scale = np.abs(y - s), theta[-1]
        return 0.5 * float(np.where(r <= EPSILON * scale, scale + r * r / scale, scale + 2 * EPSILON * r - scale * EPSILON ** 2).sum())

    def sums(self, z: np.ndarray, y: np.ndarray, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        p, scale = z.shape[1], theta[-1]
        s = z @ theta[:p]
        r = y - s
        near = np.abs(r) <= EPSILON * scale
        g, h = np.empty(p + 1), np.empty((p + 1, p + 1))
        g[:p] = -(z.T @ np.where(near, r / scale, EPSILON * np.sign(r)))
        g[p] = 0.5 * np.where(near, 1 - (r / scale) ** 2, 1 - EPSILON ** 2).sum()
        zn, rn = z[near], r[near]
        h[:p, :p] = zn.T @ zn / scale
        h[p, :p] = h[:p, p] = zn.T @ rn / scale ** 2
        h[p, p] = rn @ rn / scale ** 3
        return self.loss(s, y, theta), g, h


@dataclass(frozen=True)
class Hinge:
    """Parameters: coefficients, intercept.  Class ``positive`` against the rest; the corner
    is a parabola where the margin is within ``band`` of 1."""
    positive: int
    band: float
    extra: int = 0

    def _side(self, y: np.ndarray) -> np.ndarray:
        return np.where(y == self.positive, 1.0, -1.0)

    def loss(self, s: np.ndarray, y: np.ndarray, theta: np.ndarray) -> float:
        short = 1 - self._side(y) * s
        return float(np.where(np.abs(short) <= self.band, (short + self.band) ** 2 / (4 * self.band), np.maximum(short, 0.0)).sum())

    def sums(self, z: np.ndarray, y: np.ndarray, theta: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        s, side = z @ theta, self._side(y)
        short = 1 - side * s
        near = np.abs(short) <= self.band
        g = -(z.T @ (side * np.where(near, (short + self.band) / (2 * self.band), (short > 0).astype(float))))
        zn = z[near]
        return self.loss(s, y, theta), g, zn.T @ zn / (2 * self.band)


@dataclass
class Stats:
    """Of the rows of one fit: their number, sum and squares of all entries of x and of y, the highest y."""
    n: float
    x: float
    xx: float
    y: float
    yy: float
    top: float

    def gamma(self, d: int) -> float:
        var = self.xx / (self.n * d) - (self.x / (self.n * d)) ** 2 if self.n and d else 1.0
        return 1.0 / (d * var) if var > 0 else 1.0


class Fit:
    """Newton's method for one fit.  ``points`` are what the next scan evaluates: one with
    gradient and Hessian, or several by loss only where a step went too far."""

    def __init__(self, kind: str, stats: Stats, features: int, skip_fold: int | None = None, positive: int = 0, map_: int = 0):
        self.kind, self.skip_fold, self.map, self.penalty = kind, skip_fold, map_, 1.0 / max(stats.n, 1)
        self.positive, self.stage, self.scans, self.done = positive, 0, 0, False
        theta = np.zeros(features + 1)
        if kind == "huber":
            mean = stats.y / stats.n
            deviation = math.sqrt(max(stats.yy / stats.n - mean * mean, 0.0)) or 1.0
            self.floor = LEAST_SCALE * deviation
            theta[-1] = mean
            theta = np.append(theta, deviation)
        self.n, self.theta, self.value, self.step = stats.n, None, math.inf, None
        self.points, self.curved, self.slope, self.forced = [theta], True, 0.0, True

    @property
    def objective(self):
        return Huber() if self.kind == "huber" else Hinge(self.positive, BANDS[self.stage])

    def _coefficients(self, theta: np.ndarray) -> np.ndarray:
        return theta[:-2] if self.kind == "huber" else theta[:-1]

    def _penalised(self, loss: float, theta: np.ndarray) -> float:
        return loss / self.n + 0.5 * self.penalty * float((self._coefficients(theta) ** 2).sum())

    def tell(self, v: np.ndarray) -> None:
        """Take what a scan found at ``points``."""
        self.scans += 1
        if not np.isfinite(v).all():
            raise ValueError("a feature or label is not a finite number")
        if not self.curved:
            values = [self._penalised(loss, t) for loss, t in zip(v, self.points)]
            best = int(np.argmin(values))
            if values[best] >= self.value:          # nothing better in reach: as far as double precision goes
                self._next_stage()
            else:
                self.points, self.curved, self.forced = [self.points[best]], True, True
            return
        theta, p = self.points[0], len(self.points[0])
        value = self._penalised(v[0], theta)
        if not self.forced and value > self.value + 1e-4 * self.slope:
            self.points, self.curved = [self._clipped(self.theta + self.step * 0.5 ** k) for k in range(1, 13)], False
            return
        self.theta, self.value, self.forced = theta, value, False
        g, h = v[1:p + 1] / self.n, v[p + 1:].reshape(p, p) / self.n
        c = len(self._coefficients(theta))
        g[:c] += self.penalty * theta[:c]
        h[np.arange(c), np.arange(c)] += self.penalty
        h[np.arange(c, p), np.arange(c, p)] += 1e-12 * max(1.0, float(np.abs(h).max()))
        free = np.ones(p, dtype=bool)
        if self.kind == "huber" and theta[-1] <= self.floor and g[-1] >= 0:
            free[-1] = False
        self.step = np.zeros(p)
        self.step[free] = -np.linalg.lstsq(h[np.ix_(free, free)], g[free], rcond=1e-13)[0]
        if g @ self.step > 0:
            self.step[free] = -g[free]
        target = self._clipped(theta + self.step)
        self.slope = float(g @ (target - theta))
        last = self.kind == "huber" or self.stage == len(BANDS) - 1
        small = -float(g @ self.step) <= (1e-8 if last else 0.05 * BANDS[self.stage]) * max(abs(value), 1e-3)
        if small or self.scans >= MAX_SCANS:
            self._next_stage()
        else:
            self.points, self.curved = [target], True

    def _clipped(self, theta: np.ndarray) -> np.ndarray:
        """The scale falls to a third at most in one step, and not below its floor."""
        if self.kind == "huber":
            theta = theta.copy()
            theta[-1] = max(theta[-1], self.theta[-1] / 3, self.floor)
        return theta

    def _next_stage(self) -> None:
        if self.kind == "huber" or self.stage == len(BANDS) - 1 or self.scans >= MAX_SCANS:
            self.done = True
        else:
            self.stage, self.points, self.curved, self.forced = self.stage + 1, [self.theta], True, True

    def line(self) -> np.ndarray:
        """Coefficients and intercept."""
        return self.theta[:-1] if self.kind == "huber" else self.theta


def solve(rows: DataFrame, maps: list[FourierMap], fits: list[Fit]) -> None:
    """Bring all fits to their end, one scan of ``rows(x, y, fold)`` a step."""
    ship_package(rows.sparkSession)
    while any(not f.done for f in fits):
        asked = [(i, f.map, f.skip_fold, f.objective, f.curved, np.array(f.points)) for i, f in enumerate(fits) if not f.done]
        for i, v in _scan(rows, maps, asked).items():
            fits[i].tell(v)


def _scan(rows: DataFrame, maps: list[FourierMap], asked: list) -> dict[int, np.ndarray]:
    def run(batches):
        sums: dict = {}
        for x, y, fold in _chunks(batches):
            made: dict = {}
            for i, m, skip, objective, curved, points in asked:
                keep = fold != skip if skip is not None else slice(None)
                if m not in made:
                    made[m] = maps[m].features(x)
                z, t = made[m][keep], y[keep]
                if not len(t):
                    continue
                if curved:
                    loss, g, h = objective.sums(z, t, points[0])
                    v = np.concatenate([[loss], g, h.ravel()])
                else:
                    s = z @ points[:, :z.shape[1]].T
                    v = np.array([objective.loss(s[:, k], t, p) for k, p in enumerate(points)])
                if i in sums:
                    sums[i] += v
                else:
                    sums[i] = v
        if sums:
            ends = np.cumsum([0, *map(len, sums.values())]).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.ListArray.from_arrays(ends, np.concatenate(list(sums.values())))],
                                             names=["fit", "v"])

    total = rows.mapInArrow(run, "fit int, v array<double>").groupBy("fit").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
    return {r["fit"]: r["v"].toArray() for r in total.collect()}         # a line per fit


def _chunks(batches):
    for b in batches:
        for at in range(0, b.num_rows, CHUNK):
            c = b.slice(at, CHUNK)
            x = c.column(0).flatten().to_numpy(zero_copy_only=False).reshape(c.num_rows, -1)
            yield x, c.column(1).to_numpy(zero_copy_only=False), c.column(2).to_numpy(zero_copy_only=False)


def training_rows(df: DataFrame, features: str, label: str, fold: str | None = None) -> DataFrame:
    """(x, y, fold) of the rows; a frame that is not kept yet is written once, since
    many scans follow."""
    from assay.operators.knn import _vec_array
    rows = df.select(_vec_array(df, features).alias("x"), F.col(label).cast("double").alias("y"),
                     (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold"))
    return rows if df.storageLevel != StorageLevel.NONE else settled(rows)


def fold_stats(rows: DataFrame) -> tuple[int, dict[int, Stats]]:
    """(features of a row, figures of each fold's rows)."""
    total = F.aggregate("x", F.lit(0.0), lambda a, v: a + v)
    square = F.aggregate("x", F.lit(0.0), lambda a, v: a + v * v)
    found = rows.groupBy("fold").agg(F.max(F.size("x")).alias("d"), F.count(F.lit(1)), F.sum(total), F.sum(square), F.sum("y"),
                                     F.sum(F.col("y") * F.col("y")), F.max("y"), F.max(F.col("y").isNull() | F.isnan("y")).alias("bad"))
    got = collect_bounded(found, MAX_FOLDS)
    if not got:
        raise ValueError("no rows to fit a margin to")
    if any(r["bad"] for r in got):
        raise ValueError("labels must not be null or NaN")
    return max(r["d"] for r in got), {r["fold"]: Stats(*[float(v) for v in r[2:8]]) for r in got}


def _together(stats: list[Stats]) -> Stats:
    return Stats(*[sum(getattr(s, c) for s in stats) for c in ("n", "x", "xx", "y", "yy")], max(s.top for s in stats))


class FourierEstimator(Estimator):
    """SVR (``classes`` 0) or SVC over a vector column."""

    def __init__(self, classes: int = 0, featuresCol: str = "features", labelCol: str = "label", numFeatures: int = FEATURES,
                 seed: int = 42):
        super().__init__()
        self.classes, self.features, self.label, self.number, self.seed = classes, featuresCol, labelCol, numFeatures, seed

    def _fit(self, df):
        rows = training_rows(df, self.features, self.label)
        return self.finished(rows, *self.lines(rows, [None])[None])

    def lines(self, rows: DataFrame, skips: list) -> dict:
        """Left-out fold (None: none) -> (map, a line of coefficients and intercept per margin)."""
        d, by_fold = fold_stats(rows)
        maps, fits, of = [], [], {}
        for skip in skips:
            rest = [s for f, s in by_fold.items() if f != skip]
            if not rest:
                raise ValueError("a fold holds all rows")
            stats = _together(rest)
            maps.append(FourierMap.draw(stats.gamma(d), d, self.number, self.seed))
            some = [1] if self.classes <= 2 else range(max(2, int(stats.top) + 1))
            of[skip] = [Fit("hinge" if self.classes else "huber", stats, self.number, skip, c, len(maps) - 1) for c in some]
            fits += of[skip]
        solve(rows, maps, fits)
        return {skip: (maps[own[0].map], np.array([f.line() for f in own])) for skip, own in of.items()}

    def finished(self, rows: DataFrame, map_: FourierMap, lines: np.ndarray) -> FourierModel:
        state = {"w": map_.w.tolist(), "b": map_.b.tolist(), "lines": lines.tolist(), "classes": self.classes}
        if self.classes and len(lines) == 1:
            scored = rows.select(array_to_vector(_margins(map_, lines)("x")).alias("_m"), F.col("y").alias("label"))
            curve = LogisticRegression(featuresCol="_m", regParam=1e-6, family="binomial").fit(scored)
            state |= {"slope": float(curve.coefficients[0]), "shift": float(curve.intercept)}
        return FourierModel(featuresCol=self.features, state=json.dumps(state))

    def cross_validated(self, rows: DataFrame) -> tuple[FourierModel, float]:
        """(model of all rows, mean over the folds of the squared error or accuracy of the fit
        on the other folds)."""
        folds = sorted(r[0] for r in collect_bounded(rows.select("fold").distinct(), MAX_FOLDS))
        fitted = self.lines(rows, [None, *folds])
        classes = self.classes

        def run(batches):
            hits: dict = {}
            for x, y, fold in _chunks(batches):
                for f in np.unique(fold).tolist():
                    own = fold == f
                    p = _predicted(fitted[f][0].features(x[own]) @ fitted[f][1].T, classes)
                    n, hit = hits.get(f, (0, 0.0))
                    hits[f] = (n + len(p), hit + float((p == y[own]).sum() if classes else ((p - y[own]) ** 2).sum()))
            yield pa.RecordBatch.from_arrays([pa.array(list(hits), pa.int32()), pa.array([n for n, _ in hits.values()], pa.int64()),
                                              pa.array([h for _, h in hits.values()], pa.float64())], names=["fold", "n", "hit"])

        per = rows.mapInArrow(run, "fold int, n long, hit double").groupBy("fold").agg((F.sum("hit") / F.sum("n")).alias("m"))
        return self.finished(rows, *fitted[None]), per.agg(F.avg("m")).first()[0]


def _predicted(margins: np.ndarray, classes: int) -> np.ndarray:
    if not classes:
        return margins[:, 0]
    return (margins[:, 0] > 0).astype(float) if margins.shape[1] == 1 else margins.argmax(axis=1).astype(float)


def _margins(map_: FourierMap, lines: np.ndarray):
    @F.pandas_udf("array<double>")
    def margins(x: pd.Series) -> pd.Series:
        if len(x) == 0:
            return pd.Series([], dtype=object)
        x = np.stack(x.to_numpy())
        return pd.Series([m for at in range(0, len(x), CHUNK) for m in map_.features(x[at:at + CHUNK]) @ lines.T])
    return margins


class FourierModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction`` and, for classes, ``rawPrediction`` and ``probability``."""
    featuresCol = Param(Params._dummy(), "featuresCol", "", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "", TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol=None, state=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df):
        from assay.operators.knn import _vec_array
        st = json.loads(self.getOrDefault(self.state))
        lines = np.array(st["lines"])
        m = _margins(FourierMap(np.array(st["w"]), np.array(st["b"])), lines)(_vec_array(df, self.getOrDefault(self.featuresCol)))
        if not st["classes"]:
            return df.withColumn("prediction", m[0])
        if len(lines) == 1:
            out = df.withColumn("rawPrediction", m).withColumn("rawPrediction", array_to_vector(
                F.array(-F.col("rawPrediction")[0], F.col("rawPrediction")[0])))
            margin = vector_to_array("rawPrediction")[1]
            p = 1 / (1 + F.exp(-(margin * st["slope"] + st["shift"])))
            return out.withColumns({"probability": array_to_vector(F.array(1 - p, p)), "prediction": (margin > 0).cast("double")})
        out = df.withColumn("rawPrediction", array_to_vector(m))
        raw = vector_to_array("rawPrediction")
        ex = F.transform(raw, lambda v: F.exp(v - F.array_max(raw)))
        tot = F.aggregate(ex, F.lit(0.0), lambda a, b: a + b)
        return out.withColumns({"probability": array_to_vector(F.transform(ex, lambda v: v / tot)),
                                "prediction": (F.array_position(raw, F.array_max(raw)) - 1).cast("double")})
