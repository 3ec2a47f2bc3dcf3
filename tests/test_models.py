"""Learners against closed forms and optimality conditions, reloads, and the leaderboard."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from assay.operators import learners as L
from assay.operators import training as TR


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(11)
    x = rng.normal(size=(240, 3)) * [1.0, 2.0, 0.5] + [0.0, 1.0, -2.0]
    y = x @ [1.5, -0.7, 0.0] + 3 + rng.normal(size=240) * 0.5
    rows = [(i, Vectors.dense(v.tolist()), float(t), i % 5) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["k", "features", "label", "fold"]).cache(), x, y


def fitted(df, task, name, classes=2, **kw):
    return TR.estimator_for(task, name, df, classes, **kw).fit(df)


def test_linear_and_ridge_closed_form(data):
    df, x, y = data
    c, t = x - x.mean(0), y - y.mean()
    for name, alpha in (("Linear Regression", 0.0), ("Ridge Regression", 1.0)):
        want = np.linalg.solve(c.T @ c + alpha * np.eye(3), c.T @ t)
        assert fitted(df, "regression", name).coefficients.toArray() == pytest.approx(want, rel=1e-4, abs=1e-5)


def test_lasso_and_elastic_net_optimality(data):
    """The gradient of the squared loss balances the penalty at every coefficient."""
    df, x, y = data
    c, t = x - x.mean(0), y - y.mean()
    for name, l1, l2 in (("Lasso Regression", 0.1, 0.0), ("ElasticNet", 0.05, 0.05)):
        w = fitted(df, "regression", name).coefficients.toArray()
        g = c.T @ (t - c @ w) / len(t) - l2 * w
        for gi, wi in zip(g, w):
            if abs(wi) > 1e-9:
                assert gi == pytest.approx(l1 * np.sign(wi), abs=2e-3)
            else:
                assert abs(gi) <= l1 + 2e-3


def test_logistic_optimality(data):
    df, x, y = data
    df = df.withColumn("label", (F.col("label") > float(np.median(y))).cast("double"))
    m = fitted(df, "binary", "Logistic Regression")
    w, b, t = m.coefficients.toArray(), m.intercept, (y > np.median(y)).astype(float)
    r = t - 1 / (1 + np.exp(-(x @ w + b)))
    assert np.abs(x.T @ r - w).max() < 0.05 and abs(r.sum()) < 0.05


def test_folds_have_their_own_penalty(data):
    df, x, y = data
    half = df.where("k < 60")
    a = L.FoldwiseEstimator("regression", "Ridge Regression").fit(half).coefficients.toArray()
    c, t = x[:60] - x[:60].mean(0), y[:60] - y[:60].mean()
    assert a == pytest.approx(np.linalg.solve(c.T @ c + np.eye(3), c.T @ t), rel=1e-4)


def test_reloaded_models_predict_the_same(data, tmp_path):
    from pyspark.ml import PipelineModel
    df, _, y = data
    for name in ("Linear Regression", "Decision Tree", "Random Forest", "Gradient Boosting", "SVR", "KNN"):
        kw = {"num_trees": 5} if name == "Random Forest" else {}
        est = TR.estimator_for("regression", name, df, **kw)
        if name == "Gradient Boosting":
            est.setMaxIter(5)
        m = PipelineModel([est.fit(df)])
        TR.save_model(m, f"{tmp_path}/{name}")
        again = TR.load_model(f"{tmp_path}/{name}")
        a, b = [[r["prediction"] for r in x.transform(df).orderBy("k").collect()] for x in (m, again)]
        assert a == pytest.approx(b), name


def test_margin_classifiers_have_probabilities_and_reload(data, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    df, _, y = data
    low, high = (float(v) for v in np.quantile(y, [1 / 3, 2 / 3]))
    two = df.withColumn("label", (F.col("label") > low).cast("double"))
    three = df.withColumn("label", ((F.col("label") > low).cast("int") + (F.col("label") > high).cast("int")).cast("double"))
    for frame, classes, name in ((two, 2, "SVC"), (three, 3, "SVC"), (three, 3, "Gradient Boosting")):
        est = TR.estimator_for("multiclass", name, frame, classes)
        if name == "Gradient Boosting":
            est.setMaxIter(3)
        m = PipelineModel([est.fit(frame)])
        TR.save_model(m, f"{tmp_path}/{name}{classes}")
        rows = [[(r["prediction"], r["p"]) for r in x.transform(frame).withColumn("p", vector_to_array("probability"))
                 .orderBy("k").collect()] for x in (m, TR.load_model(f"{tmp_path}/{name}{classes}"))]
        assert rows[0] == rows[1]
        p = np.array([p for _, p in rows[0]])
        assert p.shape == (240, classes) and p.sum(axis=1) == pytest.approx(np.ones(240))
        if classes == 2:
            truth = (y > low).astype(float)
            assert p[truth == 1, 1].mean() > 0.7 > 0.4 > p[truth == 0, 1].mean()


def test_leaderboard_keeps_every_model_and_failures(data):
    df, _, _ = data
    train, test = df.where("k < 200"), df.where("k >= 200")
    rows = TR.leaderboard(train, test, "regression", ["Linear Regression", "Decision Tree", "KNN", "No such model"]).collect()
    assert [r["status"] for r in rows] == ["ok", "ok", "ok", "failed"] and "No such model" in rows[3]["error"]
    assert rows[0]["rmse"] < 0.7 and rows[0]["cv_rmse"] < 0.7 and rows[0]["r2"] > 0.8


def test_null_feature_rows_are_kept(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0), (float("nan"), 1.0)], "a double, b double")
    assert [r["features"].toArray().tolist() for r in L.assemble(df, ["a", "b"]).collect()] == [[1.0, 0.0], [0.0, 2.0], [0.0, 1.0]]
