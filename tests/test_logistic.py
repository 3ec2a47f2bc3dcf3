"""Logistic regression by Newton steps against Spark's solver run to its end; labels it leaves to that solver."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.linalg import Vectors

from assay.operators import learners as L
from assay.operators import logistic as LG


def frame(spark, x, y, parts=3):
    return spark.createDataFrame([(Vectors.dense(r.tolist()), float(v)) for r, v in zip(x, y)], ["features", "label"]).repartition(parts)


@pytest.mark.parametrize("classes", [2, 3])
def test_newton_ends_where_spark_does_in_few_scans(spark, monkeypatch, tmp_path, classes):
    rng = np.random.default_rng(classes)
    x = rng.normal(size=(900, 3)) * [1.0, 50.0, 0.1] + [0.0, 900.0, 0.0]
    x = np.column_stack([x, x[:, 0] + 1e-3 * rng.normal(size=900), np.full(900, 7.0)])      # nearly the first, and a constant
    s = x[:, 0] + (x[:, 1] - 900) / 40 + rng.normal(size=900)
    df, scans, sums = frame(spark, x, np.digitize(s, [0.0, 1.2][:classes - 1])), [], LG._sums
    monkeypatch.setattr(LG, "_sums", lambda *a: scans.append(1) or sums(*a))
    est = L.classifier("Logistic Regression", 900, classes)
    model = est.fit(df)
    assert len(scans) <= 12
    exact = LogisticRegression(maxIter=5000, tol=1e-15, regParam=1 / 900, standardization=False).fit(df)
    p, q = (np.array([r[0].toArray() for r in m.transform(df).select("probability").collect()]) for m in (model, exact))
    np.testing.assert_allclose(p, q, atol=2e-4)
    assert model.numClasses == classes and model.coefficientMatrix.toArray()[:, -1].tolist() == [0.0] * (1 if classes == 2 else 3)
    model.write().save(str(tmp_path / "m"))
    again = LogisticRegressionModel.load(str(tmp_path / "m")).transform(df).select("probability").first()[0].toArray()
    assert again.tolist() == model.transform(df).select("probability").first()[0].toArray().tolist()


def test_one_class_only_and_empty_classes_go_to_spark(spark):
    x = np.random.default_rng(1).normal(size=(40, 2))
    one = L.classifier("Logistic Regression", 40, 2).fit(frame(spark, x, np.ones(40)))
    assert {r[0] for r in one.transform(frame(spark, x, np.ones(40))).select("prediction").collect()} == {1.0}
    gap = L.classifier("Logistic Regression", 40, 3).fit(frame(spark, x, np.arange(40) % 2 * 2))
    assert gap.numClasses == 3
    with pytest.raises(Exception):
        L.classifier("Logistic Regression", 40, 2).fit(frame(spark, x, np.arange(40) % 2 - 0.5))
