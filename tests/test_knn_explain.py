"""kNN against brute force, Shapley additivity, curve operators on hand curves."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.operators import curves as C
from assay.operators import explain as X
from assay.operators import knn as K


def test_knn_join_matches_brute_force_with_hot_cell(spark):
    rng = np.random.default_rng(3)
    refs = np.vstack([rng.normal(0, 0.01, size=(300, 4)), rng.normal(5, 1, size=(60, 4))])  # one dense cluster
    qs = rng.normal(0, 1, size=(25, 4))
    r = spark.createDataFrame([(i, v.tolist(), i % 3) for i, v in enumerate(refs)], "rid long, v array<double>, y int")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(qs)], "qid long, v array<double>")
    nn = K.knn_join(q, r, "qid", "rid", "v", "v", k=5, payload=["y"], num_pivots=8, block_rows=16)
    got = {}
    for row in nn.collect():
        got.setdefault(row["qid"], []).append((row["rank"], row["rid"]))
    for i, qv in enumerate(qs):
        d = np.sqrt(((refs - qv) ** 2).sum(axis=1))
        want = sorted(range(len(refs)), key=lambda j: (d[j], j))[:5]
        assert [rid for _, rid in sorted(got[i])] == want


def test_knn_edges_and_probed_recall(spark):
    rng = np.random.default_rng(4)
    refs = np.vstack([rng.normal(c, 0.2, size=(60, 6)) for c in range(20)])
    qs = refs[::17] + rng.normal(0, 0.05, size=refs[::17].shape)
    r = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(refs)] + [(5000, None)], "rid long, v array<double>")
    q = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(qs)] + [(None, qs[0].tolist())], "qid long, v array<double>")
    assert K.knn_join(q, r.limit(0), "qid", "rid", "v", "v").count() == 0
    exact = {(x.qid, x.rid) for x in K.knn_join(q, r, "qid", "rid", "v", "v").collect()}
    want = {(i, int(j)) for i, x in enumerate(qs) for j in np.argsort(((refs - x) ** 2).sum(1), kind="stable")[:5]}
    assert exact == want
    probed = {(x.qid, x.rid) for x in K.knn_join(q, r, "qid", "rid", "v", "v", probes=4).collect()}
    assert len(probed & want) >= 0.9 * len(want)
    few = K.knn_join(q.limit(1), r.limit(3), "qid", "rid", "v", "v").collect()
    assert [x["rank"] for x in few] == [1, 2, 3]


def test_knn_model_reloads_equal(spark, tmp_path):
    from pyspark.ml.linalg import Vectors
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, Vectors.dense(rng.normal(size=3).tolist()), float(i % 3)) for i in range(90)], ["k", "features", "label"])
    model = K.KNNEstimator(k=5, mode="vote").fit(df)
    model.write().overwrite().save(f"{tmp_path}/knn")
    again = K.KNNModel.load(f"{tmp_path}/knn")
    assert model.transform(df).orderBy("k").collect() == again.transform(df).orderBy("k").collect()


def test_knn_vote_smallest_label_wins_ties(spark):
    nn = spark.createDataFrame([(1, 2), (1, 1), (1, 2), (1, 1), (1, 0)], "q int, y int")
    assert K.knn_predict(nn, "q", "y", "vote").first()["prediction"] == 1.0
    assert K.knn_predict(nn, "q", "y", "mean").first()["prediction"] == pytest.approx(1.2)


def test_tree_shap_additivity(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor
    rng = np.random.default_rng(5)
    rows = [(i, *rng.normal(size=4).tolist()) for i in range(400)]
    df = spark.createDataFrame(rows, "k long, a double, b double, c double, d double")
    df = df.withColumn("label", F.col("a") * 2 + F.when(F.col("b") > 0, 1.0).otherwise(0.0) + F.col("c") * F.col("d"))
    data = VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)
    gbt = GBTRegressor(maxIter=20, maxDepth=3, seed=1).fit(data)
    import tempfile
    trees = X.tree_tables(gbt, tempfile.mkdtemp(prefix="gbt-"))
    sv = X.shap_values(data, "features", ["k"], trees, 4)
    j = sv.join(gbt.transform(data).select("k", F.col("prediction").alias("mp")), "k")
    for r in j.collect():
        assert r["base_value"] + sum(r["shap"]) == pytest.approx(r["mp"], abs=1e-9)
        assert r["prediction"] == pytest.approx(r["mp"], abs=1e-9)


def _subset_shapley(nodes, x, d):
    """Definition: cover-weighted expectations over all subsets of the tree's features."""
    from itertools import combinations
    used = sorted({v[4] for v in nodes.values() if v[2] >= 0})

    def expect(at, known):
        value, cover, left, right, f, t = nodes[at]
        if left < 0:
            return value
        if f in known:
            return expect(left if x[f] <= t else right, known)
        return (nodes[left][1] * expect(left, known) + nodes[right][1] * expect(right, known)) / cover
    phi, m = np.zeros(d), len(used)
    for i in used:
        rest = [u for u in used if u != i]
        for k in range(m):
            for s in combinations(rest, k):
                w = math.factorial(k) * math.factorial(m - 1 - k) / math.factorial(m)
                phi[i] += w * (expect(min(nodes), {*s, i}) - expect(min(nodes), set(s)))
    return phi


def test_forest_and_classifier_shapley_values(spark, tmp_path):
    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.functions import vector_to_array
    from pyspark.ml.regression import RandomForestRegressor
    rng = np.random.default_rng(7)
    df = spark.createDataFrame([(i, *rng.normal(size=5).tolist()) for i in range(300)], "k long, a double, b double, c double, d double, e double")
    df = df.withColumn("label", F.col("a") * F.col("b") + F.when(F.col("c") > F.col("d"), 1.0).otherwise(0.0))
    data = VectorAssembler(inputCols=list("abcde"), outputCol="features").transform(df)
    reg = RandomForestRegressor(numTrees=5, maxDepth=12, seed=1).fit(data)
    trees = X.tree_tables(reg, f"{tmp_path}/reg")
    assert max(len(p) for _, p in X.leaf_paths(trees[0][1])) == 5
    sv = X.shap_values(data, "features", ["k"], trees, 5).join(reg.transform(data).select("k", "features", F.col("prediction").alias("m")), "k")
    for n, r in enumerate(sv.orderBy("k").collect()):
        assert r["prediction"] == pytest.approx(r["m"], abs=1e-9)
        if n < 3:
            want = sum(w * _subset_shapley(t, r["features"].toArray(), 5) for w, t in trees)
            assert np.allclose(r["shap"], want, atol=1e-9)
    data = data.withColumn("label", (F.col("label") > 0.5).cast("double"))
    cls = RandomForestClassifier(numTrees=5, maxDepth=12, seed=1).fit(data)
    sv = X.shap_values(data, "features", ["k"], X.tree_tables(cls, f"{tmp_path}/cls"), 5) \
        .join(cls.transform(data).select("k", vector_to_array("probability")[1].alias("p")), "k")
    for r in sv.collect():
        assert r["prediction"] == pytest.approx(r["p"], abs=1e-9)


def test_partial_dependence_grids(spark):
    rows = [(float(i % 7), i / 100, None if i % 2 else 1.0) for i in range(1000)] + [(float("nan"), None, None)]
    g = X.grid_values(spark.createDataFrame(rows, "a double, b double, c double").repartition(7), ["a", "b", "c"], n=50)
    assert g["a"] == [0, 1, 2, 3, 4, 5, 6] and g["c"] == [1.0]
    q = np.quantile(np.arange(1000) / 100, [0.05, 0.95])
    assert g["b"] == pytest.approx(np.linspace(*q, 50).tolist())


def test_gradient_matches_numpy_and_peaks(spark):
    x = np.linspace(0, 10, 50)
    y = np.tanh(x - 5) * 3
    p = 1 / (1 + np.exp(-(x - 3)))
    df = spark.createDataFrame([("s", "f", i, float(a), float(b), float(c)) for i, (a, b, c) in enumerate(zip(x, y, p))],
                               "segment string, feature string, grid_ix int, x double, y double, p double")
    g = C.gradient(df, ["segment", "feature"]).orderBy("grid_ix").collect()
    assert [r["rate"] for r in g] == pytest.approx(list(np.gradient(y, x)))
    t = C.thresholds(df, ["segment", "feature"]).first()
    rate = np.abs(np.gradient(y, x))
    want = [x[i] for i in range(1, 49) if rate[i] > 2 * rate.mean() and rate[i] > rate[i - 1] and rate[i] > rate[i + 1]]
    assert t["detected_thresholds"] == pytest.approx(want)
    cross = [x[i] for i in range(1, 50) if (p[i - 1] < 0.5) != (p[i] < 0.5)]
    assert t["binary_thresholds"] == pytest.approx(cross)


def test_partial_dependence_of_linear_model_is_its_slope(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    rng = np.random.default_rng(2)
    rows = [(float(a), float(b), float(3 * a - b + 1)) for a, b in rng.normal(size=(200, 2))]
    df = spark.createDataFrame(rows, "a double, b double, label double")
    pm = Pipeline(stages=[VectorAssembler(inputCols=["a", "b"], outputCol="features"),
                          LinearRegression()]).fit(df)
    pd_ = X.partial_dependence(pm, df.drop("label"), ["a"], n=10).orderBy("grid_ix").collect()
    xs, ys = [r["x"] for r in pd_], [r["average_prediction"] for r in pd_]
    slope = (ys[-1] - ys[0]) / (xs[-1] - xs[0])
    assert slope == pytest.approx(3.0, rel=1e-6)


def test_sweep_scores_the_swept_rows_with_both_models(spark):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression
    x = np.random.default_rng(13).normal(size=(300, 2))
    df = spark.createDataFrame([(float(a), float(b), float(2 * a - 3 * b + 1), float(a + b > 0)) for a, b in x],
                               "a double, b double, label double, c double")
    asm = VectorAssembler(inputCols=["a", "b"], outputCol="features")
    reg = Pipeline(stages=[asm, LinearRegression()]).fit(df)
    cls = Pipeline(stages=[asm, LogisticRegression(labelCol="c", regParam=0.1)]).fit(df)
    base = {"s": (0.5, -1.0), "t": (4.0, 2.0)}
    grid = spark.createDataFrame([(s, f, i, float(v), *r) for s, r in base.items() for f in ("a", "b") for i, v in enumerate((-1, 0, 3))],
                                 "segment string, feature string, grid_ix int, x double, a double, b double")
    got = X.sweep(reg, cls, grid, ["a", "b"], positive=1).collect()
    assert len(got) == 12
    w, b0 = cls.stages[-1].coefficients.toArray(), cls.stages[-1].intercept
    for r in got:
        row = [r["x"] if f == r["feature"] else v for f, v in zip("ab", base[r["segment"]])]
        assert r["y"] == pytest.approx(2 * row[0] - 3 * row[1] + 1, abs=1e-6)
        assert r["p"] == pytest.approx(1 / (1 + math.exp(-(np.dot(w, row) + b0))), abs=1e-9)


def test_knn_folds_take_one_join(spark, monkeypatch):
    """Left-out scores of all folds come from one join and equal those of brute force per fold."""
    from pyspark.ml.linalg import Vectors

    from assay.operators import training as TR
    rng = np.random.default_rng(5)
    x = np.concatenate([rng.normal(size=(150, 3)).round(1), rng.normal(5, 1, size=(60, 3)).round(1), np.zeros((40, 3))])
    y, fold = rng.integers(0, 2, len(x)).astype(float), rng.integers(0, 4, len(x))
    df = spark.createDataFrame([(Vectors.dense(v.tolist()), float(t), int(f)) for v, t, f in zip(x, y, fold)],
                               ["features", "label", "fold"]).coalesce(1).cache()
    calls, join = [], K.knn_join
    monkeypatch.setattr(K, "knn_join", lambda *a, **kw: calls.append(1) or join(*a, **kw))
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    near = [sorted((d, j) for j, d in enumerate(row) if fold[j] != fold[i])[:5] for i, row in enumerate(dist)]
    mean = np.array([np.mean([y[j] for _, j in n]) for n in near])
    for task, hit in (("regression", (mean - y) ** 2), ("binary", (mean > 0.5) == y)):
        model, metric = TR.fit_and_cross_validate(task, "KNN", df)
        assert metric == pytest.approx(np.mean([hit[fold == f].mean() for f in range(4)]), abs=1e-12)
        assert model.transform(df).count() == len(x)
    assert len(calls) == 4                              # one for the folds, one for the model, of each task
