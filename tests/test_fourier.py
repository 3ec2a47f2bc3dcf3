"""SVMs over Fourier features: optimality, folds together, what is stored, degenerate labels."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from assay.operators import fourier as FR
from assay.operators import training as TR


def frame(spark, x, y):
    rows = [(i, Vectors.dense(v.tolist()), float(t), i % 3) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["k", "features", "label", "fold"]).cache()


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 3))
    return x, np.sin(2 * x[:, 0]) + x[:, 1] + 0.2 * rng.normal(size=300) + 3 * (rng.random(300) < 0.1)


def fits_of(df, kind, classes, top):
    data = FR.training_rows(df, "features", "label", "fold")
    d, by_fold = FR.fold_stats(data)
    stats = FR._together(list(by_fold.values()))
    map_ = FR.FourierMap.draw(stats.gamma(d), d, 40, 42)
    fits = [FR.Fit(kind, stats, 40, None, c) for c in range(top)]
    FR.solve(data, [map_], fits)
    return map_, fits


def test_huber_optimum(spark, rows):
    x, y = rows
    map_, (fit,) = fits_of(frame(spark, x, y), "huber", 0, 1)
    _, g, _ = FR.Huber().sums(map_.features(x), y, fit.theta)
    g[:-2] += fit.theta[:-2]                    # the penalty, times the number of rows
    assert np.abs(g).max() < 0.05 and fit.scans < 40


def test_hinge_optimum_of_every_class(spark, rows):
    x, y = rows
    t = np.digitize(y, np.quantile(y, [1 / 3, 2 / 3])).astype(float)
    map_, fits = fits_of(frame(spark, x, t), "hinge", 3, 3)
    z = map_.features(x)
    for c, fit in enumerate(fits):
        side = np.where(t == c, 1.0, -1.0)

        def value(w):
            return np.maximum(0, 1 - side * (z @ w)).sum() + 0.5 * (w[:-1] ** 2).sum()
        _, g, _ = FR.Hinge(c, FR.BANDS[-1]).sums(z, t, fit.theta)
        g[:-1] += fit.theta[:-1]
        assert np.abs(g).max() < 0.2 and fit.scans < 80
        rng = np.random.default_rng(c)
        assert all(value(fit.theta) <= value(fit.theta + s * rng.normal(size=41)) + 0.5 for s in (0.01, 0.1, 1) for _ in range(20))


def test_folds_together_equal_fits_on_the_rest(spark, rows):
    x, y = rows
    df = frame(spark, x, y)
    model, metric = TR.fit_and_cross_validate("regression", "SVR", df)
    errors = []
    for f in range(3):
        alone = TR.estimator_for("regression", "SVR", df.where(f"fold <> {f}")).fit(df.where(f"fold <> {f}"))
        errors.append(alone.transform(df.where(f"fold = {f}")).agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).first()[0])
    assert metric == pytest.approx(np.mean(errors), rel=1e-4)
    whole = TR.estimator_for("regression", "SVR", df).fit(df)
    a, b = [[r.prediction for r in m.transform(df).orderBy("k").collect()] for m in (model, whole)]
    assert a == pytest.approx(b, rel=1e-5)


def test_features_are_not_stored(spark, rows, monkeypatch):
    """Scans keep nothing: what Spark holds during a fit is no more than before it."""
    x, y = rows
    df = frame(spark, x, y)
    df.count()
    before, seen, scan = len(spark._jsc.getPersistentRDDs()), [], FR._scan

    def watched(*a):
        out = scan(*a)
        seen.append(len(spark._jsc.getPersistentRDDs()))
        return out
    monkeypatch.setattr(FR, "_scan", watched)
    model = TR.estimator_for("regression", "SVR", df).fit(df)
    assert seen and max(seen) <= before
    assert {"_rff"}.isdisjoint(model.transform(df).columns)


def test_unscaled_features_with_labels_0_and_1_do_not_diverge(spark):
    rng = np.random.default_rng(8)
    x = np.column_stack([rng.integers(1, 20_000, 400), rng.integers(1, 3_000, 400), rng.integers(1, 90, 400)]).astype(float)
    df = frame(spark, x, (rng.random(400) < 0.8).astype(float))
    p = TR.estimator_for("regression", "SVR", df).fit(df).transform(df)
    assert p.agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).first()[0] < 0.3


def test_bad_numbers_are_named(spark):
    df = frame(spark, np.array([[1.0, 2.0], [np.nan, 1.0], [0.0, 3.0]]), [1.0, 2.0, 3.0])
    with pytest.raises(ValueError, match="finite"):
        TR.estimator_for("regression", "SVR", df).fit(df)
    no_label = df.fillna(0.0).withColumn("label", F.when(F.col("k") > 0, F.col("label")))
    for task, name in (("regression", "SVR"), ("multiclass", "SVC")):
        with pytest.raises(ValueError, match="labels must not be null"):
            TR.estimator_for(task, name, no_label, 3).fit(no_label)
