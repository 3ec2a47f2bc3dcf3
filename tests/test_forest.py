"""Trees against a brute-force CART, large nodes, forests scored in blocks, reload."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from assay.operators import forest as FO
from assay.operators.trees import TreeRule, grow


def brute(x, y, w, rule, depth=0):
    """Nested (feature, threshold, left, right) or value, split by split."""
    if rule.classes:
        value = tuple(w[y == k].sum() / w.sum() for k in range(rule.classes))
    else:
        value = float(np.average(y, weights=w))
    if len(set(y)) == 1 or len(y) < max(rule.min_split, 2 * rule.min_leaf) or (rule.max_depth is not None and depth >= rule.max_depth):
        return value

    def sums(m):
        cols = [w * (y == k) for k in range(rule.classes)] if rule.classes else [w * y]
        return sum(c[m].sum() ** 2 for c in cols) / w[m].sum()
    best = None
    for f in range(x.shape[1]):
        values = np.unique(x[:, f])
        for a, b in zip(values, values[1:]):
            go = x[:, f] <= a
            if min(go.sum(), (~go).sum()) < rule.min_leaf:
                continue
            score = sums(go) + sums(~go)
            if best is None or score > best[0] + 1e-9 * abs(best[0]):
                best = (score, f, a + (b - a) / 2, go)
    if best is None:
        return value
    _, f, t, go = best
    return (f, t, brute(x[go], y[go], w[go], rule, depth + 1), brute(x[~go], y[~go], w[~go], rule, depth + 1))


def route(node, row):
    while isinstance(node, tuple) and len(node) == 4:
        node = node[2] if row[node[0]] <= node[1] else node[3]
    return node


@pytest.mark.parametrize("rule", [TreeRule(), TreeRule(max_depth=3), TreeRule(min_split=9, min_leaf=4), TreeRule(classes=3),
                                  TreeRule(classes=3, min_leaf=5)])
def test_equals_brute_force_cart(rule):
    rng = np.random.default_rng(4)
    x = np.column_stack([rng.normal(size=500), rng.integers(0, 6, 500), np.ones(500), rng.normal(size=500).round(1)])
    y = (np.rint(x[:, 0] * 2 + x[:, 1]) % (3 if rule.classes else 100)).astype(float)
    y = np.where(rng.random(500) < 0.1, rng.integers(0, 3, 500), y).astype(float)
    w = rng.integers(1, 4, 500).astype(float)
    tree, want = grow(x, y, w, rule, np.random.default_rng(0)), brute(x, y, w, rule)
    got = tree.predict(x)
    assert np.allclose(got, np.array([np.atleast_1d(route(want, r)) for r in x]))
    assert (tree.feature >= 0).sum() + 1 == (tree.feature < 0).sum()


def frame(spark, n=3_000, classes=0, seed=1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 4)).round(2)
    y = np.rint(2 * x[:, 0] + (x[:, 1] > 0) * 3 - 1 + rng.normal(size=n) * 0.3)
    y = np.clip(y, 0, classes - 1) if classes else y
    rows = [(i, Vectors.dense(v.tolist()), float(t), i % 5) for i, (v, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, ["k", "features", "label", "fold"]), x, y


def test_one_tree_learns_its_rows_and_equals_the_local_tree(spark):
    df, x, y = frame(spark, 500)
    model = FO.ForestEstimator(FO.ForestSpec(trees=1, bootstrap=False)).fit(df)
    got = [r.prediction for r in model.transform(df).orderBy("k").collect()]
    local = grow(x, y, np.ones(len(y)), TreeRule(), np.random.default_rng(0))
    assert got == pytest.approx(local.predict(x)[:, 0])
    gains = local.importances(4)
    assert model.featureImportances.toArray() == pytest.approx(gains / gains.sum())


def test_large_nodes_are_split_by_histograms_and_scored_in_blocks(spark, monkeypatch):
    df, x, y = frame(spark, 3_000)
    data = FO.training_table(df, "features", "label", "fold")
    spec = FO.ForestSpec(trees=1, bootstrap=False)
    whole, parted = FO.fit(data, [spec]), FO.fit(data, [spec], bound=400)
    assert len(parted.tops[0, 0].feature) > 10 and parted.nodes.count() == len(parted.tops[0, 0].ends())
    models = [FO.ForestModel(f, 0) for f in (whole, parted)]
    monkeypatch.setattr(FO, "BLOCK_NODES", 300)
    monkeypatch.setattr(FO, "BLOCK_ROWS", 700)
    a, b = [[r.prediction for r in m.transform(df).orderBy("k").collect()] for m in models]
    assert a == pytest.approx(y.tolist(), abs=1) and np.mean(np.abs(np.array(b) - y) > 1e-9) < 0.02
    i, j = (m.featureImportances.toArray() for m in models)
    assert i == pytest.approx(j, abs=0.05) and j.sum() == pytest.approx(1)


def test_forest_of_classes_with_drawn_features(spark, tmp_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.functions import vector_to_array
    df, x, y = frame(spark, 1_500, classes=3)
    spec = FO.ForestSpec(trees=30, rule=TreeRule(classes=3, max_features=2))
    train, test = df.where("k < 1000"), df.where("k >= 1000")
    for bound in (FO.BOUND, 300):
        forests = FO.fit(FO.training_table(train, "features", "label"), [spec], bound)
        model = PipelineModel([FO.ForestModel(forests, 0)])
        rows = model.transform(test).withColumn("p", vector_to_array("probability")).orderBy("k").collect()
        assert np.mean([r.prediction == r.label for r in rows]) > 0.85
        assert np.array([r.p for r in rows]).sum(axis=1) == pytest.approx(np.ones(500))
        path = f"{tmp_path}/{bound}"
        model.write().overwrite().save(path)
        again = PipelineModel.load(path).transform(test).orderBy("k").collect()
        assert [r.prediction for r in again] == [r.prediction for r in rows]


def test_folds_and_rules_share_a_fit(spark):
    df, x, y = frame(spark, 400)
    data = FO.training_table(df, "features", "label", "fold")
    specs = [FO.ForestSpec(trees=6, rule=TreeRule(min_leaf=m), skip_fold=f) for m in (1, 3) for f in (None, 2)]
    together = FO.fit(data, specs)
    for s, spec in enumerate(specs):
        alone = FO.fit(data, [spec])
        def trees(f, i):
            return sorted((r.tree, r.feature, r.threshold) for r in f.nodes.where(f"spec = {i}").collect())
        assert trees(together, s) == trees(alone, 0)
    w = FO.bootstrap_weights(np.arange(20_000), 3, 42)
    assert abs(w.mean() - 1) < 0.03 and abs(w.var() - 1) < 0.05


def test_no_rows(spark):
    df, _, _ = frame(spark, 10)
    with pytest.raises(ValueError, match="no labelled rows"):
        FO.ForestEstimator(FO.ForestSpec(trees=2)).fit(df.limit(0))
    model = FO.ForestEstimator(FO.ForestSpec(trees=2)).fit(df)
    assert model.transform(df.limit(0)).count() == 0



def test_the_top_of_a_tree_does_not_depend_on_the_trees_beside_it(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(0, 50, (600, 2)).astype(float)
    df = spark.createDataFrame([(Vectors.dense(v.tolist()), float(v[0] // 7)) for v in x], ["features", "label"])
    data = FO.training_table(df, "features", "label")
    few, many = (FO._grow_tops(data, [FO.ForestSpec(trees=k)], 600, 2, 0, 200) for k in (2, 9))
    assert len(many[0, 1].feature) > 3
    for t in range(2):
        assert (few[0, t].feature, few[0, t].threshold) == (many[0, t].feature, many[0, t].threshold)


def test_leaf_of_follows_the_nodes(spark):
    rng = np.random.default_rng(6)
    x, y = rng.normal(size=(700, 3)), rng.integers(0, 9, 700).astype(float)
    tree = grow(x, y, np.ones(700), TreeRule(), np.random.default_rng(0))
    x[::9, 1] = np.nan
    for row, leaf in zip(x, tree.leaf_of(x)):
        at = 0
        while tree.feature[at] >= 0:
            at = tree.left[at] if row[tree.feature[at]] <= tree.threshold[at] else tree.right[at]
        assert at == leaf


@pytest.mark.parametrize("classes", [0, 2])
def test_trees_scored_where_they_grow_equal_kept_trees(spark, monkeypatch, classes):
    from assay.operators import training as TR
    df, _, _ = frame(spark, 300, classes=classes)
    grid = {"n_estimators": [12, 25], "max_depth": [None, 3], "min_samples_split": [2], "min_samples_leaf": [1, 4]}
    task = "binary" if classes else "regression"
    kept = []
    fit = FO.fit
    monkeypatch.setattr(FO, "fit", lambda data, specs, *a: kept.append(len(specs)) or fit(data, specs, *a))
    logs = []
    for numbers in (FO.WHOLE_NUMBERS, 0):
        monkeypatch.setattr(FO, "WHOLE_NUMBERS", numbers)
        _, log = TR.tune_forest(df, task, 2, grid)
        logs.append([(str(sorted(r["params"].items())), r["mean_test_score"]) for r in log.collect()])
    assert kept == [1, 20, 1]         # only the best is kept; then all, and the best
    assert [p for p, _ in logs[0]] == [p for p, _ in logs[1]]
    assert [s for _, s in logs[0]] == pytest.approx([s for _, s in logs[1]], rel=1e-9)


def test_rules_share_the_rows_of_large_nodes(spark):
    df, _, _ = frame(spark, 900)
    data = FO.training_table(df, "features", "label", "fold")
    specs = [FO.ForestSpec(trees=2, rule=TreeRule(min_split=m)) for m in (2, 3)]
    together = FO.fit(data, specs, 300)
    assert len(together.tops[0, 0].feature) > 1
    assert together.tops[0, 0].paths() == together.tops[1, 0].paths()
    for s, spec in enumerate(specs):
        alone = FO.fit(data, [spec], 300)
        def trees(f, i):
            return sorted((r.tree, r.slot, r.feature, r.threshold) for r in f.nodes.where(f"spec = {i}").collect())
        assert trees(together, s) == trees(alone, 0)
