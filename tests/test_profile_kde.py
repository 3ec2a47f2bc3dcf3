"""Kernel densities by the fast Gauss transform against kernels summed one by one."""

import numpy as np

from assay.operators import profile as P


def _kernels(v, h, x):
    return np.exp(-0.5 * ((x[:, None] - v[None]) / h) ** 2).sum(1) / (len(v) * h * np.sqrt(2 * np.pi))


def test_density_equals_summed_kernels(spark):
    rng = np.random.default_rng(1)
    parts = {"a": rng.normal(0, 1, 700), "b": np.repeat(rng.normal(50, 0.01, 4), 100), "c": np.array([7.0]), "d": np.full(9, 3.0)}
    parts[None] = rng.normal(-20, 5, 30)
    rows = [(s, float(x)) for s, v in parts.items() for x in v] + [("a", None), ("b", float("nan"))]
    df = spark.createDataFrame(rows, "s string, v double").repartition(7)
    got = P.kde(df, ["v"], "s").toPandas()
    want = {"a": parts["a"], "b": parts["b"], "all": np.concatenate(list(parts.values()))}
    present = {s for s in got["segment"] if isinstance(s, str)}
    assert present == set(want)         # one value, or no spread: no density
    for s, v in want.items():
        g = got[got["segment"] == s].sort_values("grid_ix")
        h = v.std(ddof=1) * len(v) ** -0.2
        assert g["grid_ix"].tolist() == list(range(200))
        assert np.allclose(g["x"], np.linspace(v.min() - 3 * h, v.max() + 3 * h, 200), rtol=1e-12, atol=1e-12)
        assert np.abs(g["density"].to_numpy() - _kernels(v, h, g["x"].to_numpy())).max() < 1e-12 / h


def test_density_without_segment_far_outlier_and_empty_table(spark):
    v = np.append(np.random.default_rng(2).normal(0, 1, 300), 1e6)
    df = spark.createDataFrame([(float(x),) for x in v], "v double")
    g = P.kde(df, ["v"]).toPandas().sort_values("grid_ix")
    h = v.std(ddof=1) * len(v) ** -0.2
    assert np.abs(g["density"].to_numpy() - _kernels(v, h, g["x"].to_numpy())).max() < 1e-12 / h
    assert P.kde(df.limit(0), ["v"]).count() == 0
