"""Logistic regression (M12) by Newton's method on sums.

A scan adds up loss, gradient and Hessian of the penalised likelihood over batches of rows; the
driver takes the step ((features + 1) x classes numbers).  So the fit ends after some ten scans
where L-BFGS takes a scan or more for each of its hundreds of steps on features that nearly depend on
each other, and it ends at the minimum rather than near it.  Columns are centred and brought to one
scale inside; the penalty stays on the coefficients of the given columns.  The result is Spark's own
model.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators.fourier import _chunks, training_rows
from assay.session import ship_package

MAX_CLASSES = 100
MAX_SCANS = 100
DECREMENT = 1e-9            # the last step is taken where it promises less than this share of the loss
HALVINGS = 12


class NewtonLogisticRegression(LogisticRegression):
    """``LogisticRegression`` with a ridge penalty and an intercept.  Other settings, and labels or
    features that allow no such fit (one class only, an empty class, no numbers), go to Spark's
    solver, which also says what is wrong with them."""

    def _fit(self, dataset: DataFrame):
        x, label = self.getFeaturesCol(), self.getLabelCol()
        plain = self.getRegParam() > 0 and self.getElasticNetParam() == 0 and not self.getStandardization() and self.getFitIntercept() \
            and self.getFamily() == "auto" and not self.isDefined(self.weightCol)
        counts = dataset.groupBy(F.col(label).cast("double").alias("y")).count().limit(MAX_CLASSES + 1).collect() if plain else []
        classes = len(counts)
        if not 1 < classes <= MAX_CLASSES or {r["y"] for r in counts} != {float(k) for k in range(classes)}:
            return super()._fit(dataset)
        about = dataset.select(Summarizer.metrics("mean", "std").summary(F.col(x)).alias("s")).select("s.*").first()
        mean, scale = about["mean"].toArray(), about["std"].toArray()
        if not (np.isfinite(mean).all() and np.isfinite(scale).all()):
            return super()._fit(dataset)
        constant = scale == 0
        scale = np.where(constant, 1.0, scale)
        share = np.array([r["count"] for r in sorted(counts, key=lambda r: r["y"])], dtype=float)
        theta = _minimum(training_rows(dataset, x, label), mean, scale, share, self.getRegParam())
        w = np.where(constant, 0.0, theta[:, :-1] / scale)
        b = theta[:, -1] - w @ mean
        if classes > 2:
            b -= b.mean()
        return self._copyValues(_model(dataset.sparkSession, self.uid, w, b, classes))


def _model(spark, uid: str, w: np.ndarray, b: np.ndarray, classes: int) -> LogisticRegressionModel:
    sc = spark.sparkContext
    linalg = sc._jvm.org.apache.spark.ml.linalg

    def numbers(v):
        out = sc._gateway.new_array(sc._jvm.double, len(v))
        for i, a in enumerate(v):
            out[i] = float(a)
        return out
    made = sc._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
        uid, linalg.DenseMatrix(*w.shape, numbers(w.ravel()), True), linalg.DenseVector(numbers(b)), classes, classes > 2)
    model = LogisticRegressionModel(made)
    model._resetUid(uid)
    return model


def _minimum(rows: DataFrame, mean: np.ndarray, scale: np.ndarray, share: np.ndarray, penalty: float) -> np.ndarray:
    """Coefficients of the scaled columns and, last, the intercept: a line per class, or the
    second class's only of two."""
    n, classes, d = share.sum(), len(share), len(mean)
    ridge = penalty / scale ** 2
    free = [1] if classes == 2 else list(range(classes))
    theta = np.zeros((len(free), d + 1))
    theta[:, -1] = np.log(share[free] / n) if classes > 2 else np.log(share[1] / share[0])
    shared = np.zeros(theta.shape)
    shared[:, -1] = 1.0                                 # adding one number to all intercepts changes nothing
    curb = np.outer(shared, shared) / theta.size if classes > 2 else 0.0

    def at(points, curved):
        """Penalised loss at each point, and gradient and Hessian at the one of a curved scan."""
        v = _sums(rows, mean, scale, classes, free, points, curved) / n
        loss = [a + 0.5 * float((ridge * p[:, :-1] ** 2).sum()) for a, p in zip(v, points)]
        if not curved:
            return loss
        k = theta.size
        g, h = v[1:k + 1].copy(), v[k + 1:].reshape(k, k) + curb
        pull = np.concatenate([np.broadcast_to(ridge, (len(free), d)), np.zeros((len(free), 1))], axis=1)
        return loss[0], g + (pull * points[0]).ravel(), h + np.diag(pull.ravel())

    value, g, h = at([theta], True)
    for _ in range(MAX_SCANS):
        step = -np.linalg.lstsq(h, g, rcond=1e-14)[0].reshape(theta.shape)
        promise = -float(g @ step.ravel())
        if promise <= DECREMENT * value:
            return theta + step if promise >= 0 else theta
        found = at([theta + step], True)
        if found[0] > value - 1e-4 * promise:
            points = [theta + step * 0.5 ** k for k in range(1, HALVINGS + 1)]
            losses = at(points, False)
            best = int(np.argmin(losses))
            if losses[best] >= value:                   # as far as double precision goes
                return theta
            step, found = step * 0.5 ** (best + 1), at([points[best]], True)
        theta, (value, g, h) = theta + step, found
    return theta


def _sums(rows: DataFrame, mean, scale, classes: int, free: list[int], points: list[np.ndarray], curved: bool) -> np.ndarray:
    """Over all rows: the loss at each point, or loss, gradient and Hessian at one."""
    def run(batches):
        total = 0.0
        for x, y, _ in _chunks(batches):
            z = np.ones((len(x), len(mean) + 1))
            z[:, :-1] = (x - mean) / scale
            own = y.astype(np.int64)
            out = []
            for theta in points:
                s = np.zeros((len(z), classes))
                s[:, free] = z @ theta.T
                s -= s.max(axis=1, keepdims=True)
                e = np.exp(s)
                whole = e.sum(axis=1)
                out.append([float((np.log(whole) - s[np.arange(len(s)), own]).sum())])
            if curved:
                p = (e / whole[:, None])[:, free]
                out.append(((p - (own[:, None] == np.array(free))).T @ z).ravel())
                k = z.shape[1]
                h = np.empty((len(free), k, len(free), k))
                for i in range(len(free)):
                    for j in range(i, len(free)):
                        h[i, :, j] = z.T @ (z * (p[:, i] * ((i == j) - p[:, j]))[:, None])
                        h[j, :, i] = h[i, :, j].T
                out.append(h.ravel())
            total = total + np.concatenate(out)
        if np.ndim(total):
            yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(np.array([0, len(total)], dtype=np.int32), total)], names=["v"])

    ship_package(rows.sparkSession)
    return rows.mapInArrow(run, "v array<double>").agg(Summarizer.sum(array_to_vector("v")).alias("v")).first()["v"].toArray()
