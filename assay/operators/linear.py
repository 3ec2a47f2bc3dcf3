"""Linear regressors (M3-M6) and their cross-validation from one scan.

A fold's rows enter every least-squares problem only through the sums of products of
(1, x, y).  One pass collects that matrix for each fold, shifted by the columns' means so
that nothing cancels; the training rows of a fold are the total minus its own matrix.  From
there ordinary and ridge regression are closed forms, lasso and elastic net coordinate
descent on the matrix, and a fold's squared error is a quadratic form.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators._small import collect_bounded

MAX_FOLDS = 1_000


@dataclass(frozen=True)
class Penalty:
    """``ridge`` is added to the Gram matrix; ``alpha`` weighs (over n) ``l1`` of the absolute
    and 1 - ``l1`` of half the squared coefficients."""
    ridge: float = 0.0
    alpha: float = 0.0
    l1: float = 0.0


PENALTIES = {"Linear Regression": Penalty(), "Ridge Regression": Penalty(ridge=1.0),
             "Lasso Regression": Penalty(alpha=0.1, l1=1.0), "ElasticNet": Penalty(alpha=0.1, l1=0.5)}


@dataclass
class Moments:
    """Sums of products of (1, x - shift, y - shift) of some rows."""
    m: np.ndarray
    shift: np.ndarray

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.m - other.m, self.shift)

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.m + other.m, self.shift)

    def centred(self) -> tuple[float, np.ndarray, np.ndarray, np.ndarray]:
        """Rows, mean of (x, y) less the shift, Gram matrix and products with y, about the means."""
        n = self.m[0, 0]
        mean = self.m[0, 1:] / n
        c = self.m[1:, 1:] - n * np.outer(mean, mean)
        return n, mean, c[:-1, :-1], c[:-1, -1]

    def squared_error(self, coefficients: np.ndarray, intercept: float) -> float:
        """Sum over the rows of (y - intercept - x . coefficients) squared."""
        moved = self.shift[-1] - intercept - self.shift[:-1] @ coefficients
        v = np.concatenate([[moved], -coefficients, [1.0]])
        return float(v @ self.m @ v)


def fold_moments(df: DataFrame, features: str = "features", label: str = "label", fold: str | None = None) -> dict[int, Moments]:
    """Moments of each fold's rows (one entry 0 without a fold column); rows without a label
    take no part."""
    rows = df.select(_array(df, features).alias("x"), F.col(label).cast("double").alias("y"),
                     (F.col(fold) if fold else F.lit(0)).cast("int").alias("fold")).where("y is not null")
    first = rows.select(Summarizer.mean(array_to_vector(F.concat("x", F.array("y")))).alias("m")).first()
    if first["m"] is None:
        return {}
    shift = first["m"].toArray()
    d = len(shift)

    def run(batches):
        sums: dict = {}
        for b in batches:
            if not b.num_rows:
                continue
            x = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, d - 1)
            y, folds = b.column(1).to_numpy(zero_copy_only=False), b.column(2).to_numpy(zero_copy_only=False)
            z = np.column_stack([np.ones(len(y)), x - shift[:-1], y - shift[-1]])
            for f in np.unique(folds).tolist():
                own = z[folds == f]
                sums[f] = sums.get(f, 0.0) + own.T @ own
        if sums:
            flat = np.concatenate([s.ravel() for s in sums.values()])
            ends = np.arange(0, len(flat) + 1, (d + 1) ** 2, dtype=np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.ListArray.from_arrays(ends, flat)],
                                             names=["fold", "m"])

    total = rows.mapInArrow(run, "fold int, m array<double>").groupBy("fold") \
        .agg(Summarizer.sum(array_to_vector("m")).alias("m"))
    return {r["fold"]: Moments(r["m"].toArray().reshape(d + 1, d + 1), shift) for r in collect_bounded(total, MAX_FOLDS)}


def _array(df: DataFrame, c: str):
    from assay.operators.knn import _vec_array
    return _vec_array(df, c)


def solve(moments: Moments, penalty: Penalty) -> tuple[np.ndarray, float]:
    """Coefficients and intercept of the penalised least squares of the moments' rows."""
    n, mean, gram, xy = moments.centred()
    if penalty.alpha:
        w = _descent(gram / n, xy / n, penalty.alpha * penalty.l1, penalty.alpha * (1 - penalty.l1))
    elif penalty.ridge:
        w = np.linalg.solve(gram + penalty.ridge * np.eye(len(gram)), xy)
    else:
        # columns on one scale, then the smallest solution where some depend on others
        scale = np.sqrt(np.maximum(np.diag(gram), 0.0))
        scale[scale == 0] = 1.0
        w = np.linalg.lstsq(gram / np.outer(scale, scale), xy / scale, rcond=1e-12)[0] / scale
    return w, float(moments.shift[-1] + mean[-1] - (moments.shift[:-1] + mean[:-1]) @ w)


def _descent(q: np.ndarray, c: np.ndarray, l1: float, l2: float, tol: float = 1e-12, rounds: int = 100_000) -> np.ndarray:
    """Coordinate descent on 1/2 w'qw - c'w + l1 |w| + l2/2 w'w."""
    w, g = np.zeros(len(c)), c.copy()           # g = c - q w
    size = max(1e-300, float(np.abs(c).max(initial=0.0)))
    for _ in range(rounds):
        moved = 0.0
        for j in range(len(w)):
            d = q[j, j] + l2
            if d <= 0:
                continue
            r = g[j] + q[j, j] * w[j]
            new = np.sign(r) * max(abs(r) - l1, 0.0) / d
            if new != w[j]:
                moved = max(moved, abs(new - w[j]) * d)
                g -= q[:, j] * (new - w[j])
                w[j] = new
        if moved <= tol * size:
            break
    return w


def cross_validated(folds: dict[int, Moments], penalty: Penalty) -> float:
    """Mean over the folds of the squared error of the model fitted on the other folds."""
    total = sum(list(folds.values())[1:], next(iter(folds.values())))
    return float(np.mean([own.squared_error(*solve(total - own, penalty)) / own.m[0, 0] for own in folds.values()]))


class GramRegression(Estimator):
    """Linear regression by name (``PENALTIES``) over a vector column."""

    def __init__(self, name: str = "Linear Regression", featuresCol: str = "features", labelCol: str = "label"):
        super().__init__()
        self.name, self.features, self.label = name, featuresCol, labelCol

    def _fit(self, df):
        folds = fold_moments(df, self.features, self.label)
        if not folds:
            raise ValueError("no labelled rows to fit a line to")
        return self.model(folds[0])

    def model(self, moments: Moments) -> LinearModel:
        w, b = solve(moments, PENALTIES[self.name])
        return LinearModel(featuresCol=self.features, state=json.dumps({"coefficients": w.tolist(), "intercept": b}))


class LinearModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``prediction`` as a column expression."""
    featuresCol = Param(Params._dummy(), "featuresCol", "", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "", TypeConverters.toString)

    @keyword_only
    def __init__(self, featuresCol=None, state=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @property
    def coefficients(self) -> DenseVector:
        return DenseVector(json.loads(self.getOrDefault(self.state))["coefficients"])

    @property
    def intercept(self) -> float:
        return json.loads(self.getOrDefault(self.state))["intercept"]

    def _transform(self, df):
        from assay.operators.knn import _vec_array
        x = _vec_array(df, self.getOrDefault(self.featuresCol))
        w = F.array(*[F.lit(float(c)) for c in self.coefficients])
        dot = F.aggregate(F.zip_with(x, w, lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
        return df.withColumn("prediction", dot + F.lit(float(self.intercept)))
