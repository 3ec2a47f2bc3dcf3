"""Boosting against a small NumPy version, deviance per round, folds in one fit, reload."""

import json

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import vector_to_array

from assay.operators import boosting as B
from assay.operators.forest import training_table
from assay.operators.trees import TreeRule, grow


def rows(n, classes, seed=2):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 40, n), rng.integers(0, 25, n), np.ones(n)]).astype(float)
    s = x[:, 0] / 8 + (x[:, 1] > 12) * 2 + rng.normal(size=n) * 0.5
    y = s if not classes else np.digitize(s, np.quantile(s, [0.5] if classes == 2 else [0.33, 0.7])).astype(float)
    return x, y, np.arange(n) % 4


def small(x, y, classes, rounds, rate=0.1, depth=3):
    """Scores after every round."""
    if not classes:
        score = np.full((len(y), 1), y.mean())
    elif classes == 2:
        score = np.full((len(y), 1), np.log(y.mean() / (1 - y.mean())))
    else:
        score = np.tile(np.log([(y == k).mean() for k in range(classes)]), (len(y), 1))
    out = []
    for _ in range(rounds):
        r, h = B.residuals(y, score, classes)
        new = score.copy()
        for o in range(score.shape[1]):
            leaf = grow(x, r[:, o], np.ones(len(y)), TreeRule(max_depth=depth), np.random.default_rng(0)).leaf_of(x)
            for k in np.unique(leaf):
                m = leaf == k
                new[m, o] += rate * B.leaf_value(r[m, o].sum(), h[m, o].sum(), classes)
        score = new
        out.append(score)
    return out


def deviance(y, score, classes):
    if not classes:
        return ((y - score[:, 0]) ** 2).mean()
    p = B.softmax(score) if classes > 2 else np.column_stack([1 / (1 + np.exp(score[:, 0])), 1 / (1 + np.exp(-score[:, 0]))])
    return -np.log(p[np.arange(len(y)), y.astype(int)]).mean()


@pytest.mark.parametrize("classes", [0, 2, 3])
def test_equals_a_small_version_and_deviance_falls(spark, classes, monkeypatch):
    monkeypatch.setattr(B, "WRITE_ROUNDS", 2)
    monkeypatch.setattr(B, "ROWS_PER_TASK", 150)
    x, y, fold = rows(400, classes)
    df = spark.createDataFrame([(Vectors.dense(v.tolist()), float(t), int(f)) for v, t, f in zip(x, y, fold)],
                               ["features", "label", "fold"])
    data = training_table(df, "features", "label", "fold")
    specs = [B.BoostSpec(classes, rounds=5), B.BoostSpec(classes, rounds=5, skip_fold=1)]
    both = B.fit(data, specs)
    for e, keep in ((0, fold >= 0), (1, fold != 1)):
        state = json.loads(both.model(e).getOrDefault("state"))
        want = small(x[keep], y[keep], classes, 5)
        for r in range(5):
            got = B.score_matrix({**state, "trees": state["trees"][:r + 1]}, x[keep])
            assert np.allclose(got, want[r], atol=1e-9)
        falls = [deviance(y[keep], s, classes) for s in want]
        assert all(b < a for a, b in zip(falls, falls[1:]))
    left_out = both.left_out().where("fold = 1").toPandas()
    model = both.model(1).transform(df.where("fold = 1")).select("label", "prediction").toPandas()
    assert sorted(zip(left_out.y, left_out.prediction.round(9))) == sorted(zip(model.label, model.prediction.round(9)))


def test_three_classes_have_probabilities_and_reload(spark, tmp_path):
    from pyspark.ml import PipelineModel
    x, y, _ = rows(300, 3)
    df = spark.createDataFrame([(i, Vectors.dense(v.tolist()), float(t)) for i, (v, t) in enumerate(zip(x, y))],
                               ["k", "features", "label"])
    model = PipelineModel([B.BoostedEstimator(B.BoostSpec(3, rounds=15)).fit(df)])
    model.write().overwrite().save(f"{tmp_path}/m")
    a, b = [m.transform(df).withColumn("p", vector_to_array("probability")).orderBy("k").collect()
            for m in (model, PipelineModel.load(f"{tmp_path}/m"))]
    assert [r.p for r in a] == [r.p for r in b] and np.array([r.p for r in a]).sum(1) == pytest.approx(np.ones(300))
    assert np.mean([r.prediction == r.label for r in a]) > 0.8


def test_one_class_one_row_and_no_rows(spark):
    df = spark.createDataFrame([(Vectors.dense([1.0]), 1.0)], ["features", "label"])
    got = B.BoostedEstimator(B.BoostSpec(2, rounds=2)).fit(df).transform(df).first()
    assert got.prediction == 1.0
    assert B.BoostedEstimator(B.BoostSpec(0, rounds=2)).fit(df).transform(df).first().prediction == 1.0
    with pytest.raises(ValueError, match="no labelled rows"):
        B.BoostedEstimator(B.BoostSpec()).fit(df.limit(0))


def test_small_trees_place_columns_like_rows():
    from assay.operators.boosting import SmallTree
    rng = np.random.default_rng(3)
    for dtype in (np.uint8, np.float64):
        x = rng.integers(0, 256, (5_000, 4)).astype(dtype)
        if dtype is np.float64:
            x[::7, 1] = np.nan
        tree, open_ = SmallTree(), [0]
        for _ in range(15):
            at = open_.pop(0)
            open_ += tree.split(at, int(rng.integers(4)), int(rng.integers(40, 215)), [0.0, 0.0], [1.0, 1.0])
        assert (tree.place_columns(np.ascontiguousarray(x.T), tree.bin) == tree.place(x, tree.bin)).all()


def test_small_trees_place_rows_by_bytes_as_node_by_node():
    rng = np.random.default_rng(5)
    tree = B.SmallTree()
    ends = [0]
    for _ in range(12):
        at = ends.pop(int(rng.integers(len(ends))))
        ends += tree.split(at, int(rng.integers(3)), int(rng.integers(1, 9)), [0.0, 0.0], [1.0, 1.0])
    x = rng.integers(0, 10, (500, 3)).astype(float)
    x[::7, 1], x[::11, 2] = np.nan, np.inf
    assert tree.place_columns(x.T, tree.bin).tolist() == tree.place(x, tree.bin).tolist()
    b = np.nan_to_num(x, nan=9, posinf=9).astype(np.uint8)
    assert tree.place_columns(list(b.T), tree.bin).tolist() == tree.place(b, tree.bin).tolist()
    assert B.SmallTree().place_columns(x.T, [0]).tolist() == [0] * 500


def test_features_with_the_same_bins_are_counted_once(spark):
    rng = np.random.default_rng(6)
    x = rng.uniform(1, 9, (700, 2))
    y = (x[:, 0] > 4) + 0.5 * (x[:, 1] > 3) + rng.normal(0, 0.1, 700)
    wide = np.column_stack([x[:, 0], np.log(x[:, 0]), x[:, 1], 2 * x[:, 1]])

    def frame(m):
        return spark.createDataFrame([(i, r.tolist(), float(v), i % 3) for i, (r, v) in enumerate(zip(m, y))],
                                     "rid long, x array<double>, y double, fold int")
    specs = [B.BoostSpec(rounds=12), B.BoostSpec(rounds=12, skip_fold=1)]
    a, b = B.fit(frame(x), specs), B.fit(frame(wide), specs)
    packs = [B._packed(np.arange(4), np.array(rows, dtype=np.uint8), np.zeros(4), np.zeros(4), np.zeros((4, 1)))
             for rows in ([[0, 1, 2, 2], [0, 1, 2, 2], [0, 1, 2, 2]], [[0, 1, 0, 1], [0, 1, 0, 1], [0, 1, 1, 1]])]
    table = spark.createDataFrame([tuple(bytes(c[0].as_py()) for c in p.columns) for p in packs], B.PACKED)
    assert B._same_bins(table, [0, 1, 2], 1) == [0, 0, 2]
    for rounds_a, rounds_b in zip(a.trees, b.trees):
        for (s,), (t,) in zip(rounds_a, rounds_b):
            assert [f if f < 0 else 2 * f for f in s.feature] == t.feature and s.bin == t.bin
            np.testing.assert_allclose(s.value, t.value, rtol=1e-9)
