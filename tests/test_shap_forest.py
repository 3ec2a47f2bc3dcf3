"""Shapley values of grown forests: blocks of leaves against the definition over subsets."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from assay.operators import explain as X
from assay.operators import forest as FO
from assay.operators.trees import TreeRule
from test_knn_explain import _subset_shapley


def _data(spark, n=300, classes=False):
    x = np.random.default_rng(8).normal(size=(n, 4)).round(2)
    y = x[:, 0] * x[:, 1] + (x[:, 2] > 0)
    rows = [(i % (n // 2), Vectors.dense(v.tolist()), float(t > 0.5 if classes else t)) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["k", "features", "label"]), x    # every key stands twice


def _whole(forests, tree, output=0):
    """One tree with its top, as nodes of the definition."""
    top, width = forests.tops[0, tree], forests.width
    sub = {r["slot"]: r for r in forests.nodes.where(F.col("tree") == tree).collect()}
    nodes, size = {}, len(top.feature)

    def add(at, r):
        nonlocal size
        where = [at, *range(size, size + len(r["feature"]) - 1)]
        size += len(where) - 1
        for i, w in enumerate(where):
            inner = r["left"][i] >= 0
            nodes[w] = (r["value"][i * width + output], r["weight"][i], where[r["left"][i]] if inner else -1,
                        where[r["right"][i]] if inner else -1, r["feature"][i], r["threshold"][i])
        return r["weight"][0]

    def visit(i):
        if top.feature[i] < 0:
            return add(i, sub[top.slot[i]])
        w = visit(top.left[i]) + visit(top.right[i])
        nodes[i] = (0.0, w, top.left[i], top.right[i], top.feature[i], top.threshold[i])
        return w
    visit(0)
    return nodes


@pytest.mark.parametrize("bound", [60, 65_536])
def test_regression_forest_with_and_without_tops(spark, bound, monkeypatch):
    monkeypatch.setattr(X, "LEAF_BLOCK", 150)           # several blocks of leaves
    df, x = _data(spark)
    forests = FO.fit(FO.training_table(df, "features", "label"), [FO.ForestSpec(4)], bound)
    assert (len(forests.tops[0, 0].feature) > 1) == (bound == 60)
    model = FO.ForestModel(forests, 0, "features")
    scored = model.transform(df).withColumnRenamed("prediction", "mp")
    got = X.shap_values(scored, "features", ["k", "features", "mp"], X.leaf_table(model), 4).collect()
    assert len(got) == 300                              # keys that repeat give no extra rows
    trees = [_whole(forests, t) for t in range(4)]
    for i, r in enumerate(got):
        assert r["prediction"] == pytest.approx(r["mp"], abs=1e-9)
        if i % 100 == 0:
            v = r["features"].toArray()
            assert np.allclose(r["shap"], sum(_subset_shapley(t, v, 4) for t in trees) / 4, atol=1e-9)


def test_positive_class_of_a_deep_forest(spark):
    df, x = _data(spark, classes=True)
    model = FO.ForestModel(FO.fit(FO.training_table(df, "features", "label"), [FO.ForestSpec(20, TreeRule(2))]), 0, "features")
    from pyspark.ml.functions import vector_to_array
    scored = model.transform(df).withColumn("p", vector_to_array("probability")[1])
    for positive in (0, 1):
        sv = X.shap_values(scored, "features", ["k", "p", "features"], X.leaf_table(model, positive=positive), 4)
        for r in sv.collect():
            assert r["prediction"] == pytest.approx(r["p"] if positive else 1 - r["p"], abs=1e-9)
    dep = X.shap_dependence(sv, ["k"], list("abcd"), ["b", "d"]).collect()
    assert len(dep) == 600 and {r["feature"] for r in dep} == {"b", "d"}


def test_leaf_edges(spark):
    """Rows that stand on a threshold, are NaN or infinite; a tree of one leaf; no rows."""
    nodes = {0: (0.0, 4.0, 1, 2, 0, 1.0), 1: (2.0, 1.0, -1, -1, -1, None), 2: (6.0, 3.0, -1, -1, -1, None)}
    xs = [1.0, 2.0, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(i, Vectors.dense([v, 0.0])) for i, v in enumerate(xs)], ["k", "features"])
    one = (0.5, {0: (10.0, 1.0, -1, -1, -1, None)})
    got = {r["k"]: r for r in X.shap_values(df, "features", ["k"], [(1.0, nodes), one], 2).collect()}
    assert [got[i]["prediction"] for i in range(5)] == [7.0, 11.0, 11.0, 11.0, 7.0]
    assert all(r["base_value"] == 10.0 and r["shap"][1] == 0.0 for r in got.values())
    assert X.shap_values(df.limit(0), "features", ["k"], [(1.0, nodes)], 2).count() == 0


@pytest.mark.parametrize("bound", [60, 65_536])
def test_forest_by_subsets_equals_leaf_by_leaf(spark, bound, monkeypatch):
    """Several blocks of subtrees and rows, trees with and without tops, odd values; no leaf meets a row."""
    df, x = _data(spark, classes=True)
    odd = [(900 + i, Vectors.dense([v, 0.0, -v, 1.0]), 0.0) for i, v in enumerate([float("nan"), float("inf"), float("-inf"), 1e300])]
    rows = df.union(spark.createDataFrame(odd, df.columns))
    forests = FO.fit(FO.training_table(df, "features", "label"), [FO.ForestSpec(6, TreeRule(2))], bound)
    model = FO.ForestModel(forests, 0, "features")
    slow = {r["n"]: r for r in X.shap_values(rows.withColumn("n", F.hash("k", "features")), "features", ["n"],
                                             X.leaf_table(model, positive=1), 4).collect()}
    monkeypatch.setattr(X, "SUBSET_NODES", 100)
    monkeypatch.setattr(X, "SUBSET_ROWS", 150)
    monkeypatch.setattr(X, "_explain", None)
    fast = X.forest_shap(rows.withColumn("n", F.hash("k", "features")), "features", ["n"], model, 4).collect()
    assert len(fast) == 304
    for r in fast:
        s = slow[r["n"]]
        assert np.allclose([r["base_value"], r["prediction"], *r["shap"]], [s["base_value"], s["prediction"], *s["shap"]], atol=1e-10)


def test_dominated_sums_match_brute_force():
    rng = np.random.default_rng(1)
    for n, m, top in ((400, 300, 40), (5, 7, 1), (0, 3, 4), (50, 0, 9)):
        c1, c2, q1, q2 = rng.integers(0, top, n), rng.integers(0, top, n), rng.integers(0, top, m), rng.integers(0, top, m)
        w = rng.normal(size=n)
        want = ((c1[None] <= q1[:, None]) & (c2[None] <= q2[:, None])) @ w
        assert np.allclose(X.dominated(c1, c2, w, q1, q2), want, atol=1e-12)
