"""Fitted stages: hand values, constant columns, nulls, save/load."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from assay.operators import stages as ST


@pytest.fixture()
def small(spark):
    rows = [(i, "A" if i % 2 else "B", float(i), 5.0, float(i * i)) for i in range(1, 21)] + [(99, "A", None, 5.0, 1000.0)]
    return spark.createDataFrame(rows, "k int, seg string, x double, c double, y double")


def test_iqr_clip_matches_pandas(spark, small):
    m = ST.OutlierHandler(inputCols=["y"], method="clip").fit(small)
    out = m.transform(small).toPandas().sort_values("k")
    ref = small.toPandas().sort_values("k")
    q1, q3 = ref["y"].quantile(0.25), ref["y"].quantile(0.75)
    expected = ref["y"].clip(q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1))
    assert list(out["y"]) == pytest.approx(list(expected))
    assert out.loc[out.k == 99, "x"].isna().all()   # nulls stay null


def test_remove_sequential_vs_joint(spark, small):
    joint = ST.OutlierHandler(inputCols=["x", "y"], method="remove").fit(small).transform(small)
    seq = ST.OutlierHandler(inputCols=["x", "y"], method="remove", mode="sequential").fit(small).transform(small)
    assert joint.where(F.col("x").isNull()).count() == 0          # null rows drop
    assert seq.count() <= small.count() and joint.count() <= small.count()


def test_winsorize_per_segment(spark, small):
    m = ST.OutlierHandler(inputCols=["y"], method="winsorize", segmentCol="seg").fit(small)
    b = m.bounds()
    pdf = small.toPandas()
    for s in ("A", "B"):
        lo, hi = pdf.loc[pdf.seg == s, "y"].quantile([0.05, 0.95])
        assert b[s]["y"] == pytest.approx([lo, hi])


def test_standard_scaler_population_std_and_constant(spark, small):
    m = ST.ColumnScaler(inputCols=["y", "c"], kind="standard").fit(small)
    pdf = m.transform(small).toPandas()
    assert pdf["y"].mean() == pytest.approx(0.0, abs=1e-9)
    assert pdf["y"].std(ddof=0) == pytest.approx(1.0)
    assert (pdf["c"] == 0.0).all()                   # constant column divides by 1


def test_minmax_constant_gives_zero(spark, small):
    pdf = ST.ColumnScaler(inputCols=["y", "c"], kind="minmax").fit(small).transform(small).toPandas()
    assert pdf["y"].min() == 0.0 and pdf["y"].max() == 1.0 and (pdf["c"] == 0.0).all()


def test_skew_transformer_picks_columns(spark):
    import numpy as np
    rng = np.random.default_rng(0)
    pdf = pd.DataFrame({"sk": rng.exponential(size=500), "sym": rng.normal(size=500)})
    df = spark.createDataFrame(pdf)
    m = ST.SkewTransformer(inputCols=["sk", "sym"]).fit(df)
    assert m.fitted()["skew"]["sk"] == pytest.approx(pdf["sk"].skew(), rel=1e-9)
    assert m.outputCols() == ["sk_log"]


def test_pipeline_save_load_same_output(spark, small, tmp_path):
    from pyspark.ml import Pipeline, PipelineModel
    p = Pipeline(stages=[ST.OutlierHandler(inputCols=["y"], method="clip", segmentCol="seg"),
                         ST.ColumnScaler(inputCols=["x", "y"], kind="standard")])
    pm = p.fit(small)
    pm.write().overwrite().save(str(tmp_path / "m"))
    again = PipelineModel.load(str(tmp_path / "m"))
    a = pm.transform(small).orderBy("k").collect()
    b = again.transform(small).orderBy("k").collect()
    assert a == b


def test_pca_variance_ratio(spark):
    import numpy as np
    rng = np.random.default_rng(1)
    z = rng.normal(size=(300, 2))
    pdf = pd.DataFrame({"a": z[:, 0], "b": z[:, 0] * 2 + 0.01 * z[:, 1], "c": z[:, 1]})
    df = spark.createDataFrame(pdf)
    pm, k, cum = ST.pca_components(df, ["a", "b", "c"], 0.95)
    ev = list(pm.stages[-1].explainedVariance)
    assert all(ev[i] >= ev[i + 1] for i in range(len(ev) - 1)) and sum(ev) == pytest.approx(1.0)
    assert k == 2 and cum >= 0.95


def test_exact_quantiles_selection_matches_pandas_at_every_part_count(spark):
    import numpy as np
    from assay.operators import quantiles as Q
    rng = np.random.default_rng(0)
    n = 6000
    pdf = pd.DataFrame({"g": rng.choice(["0", "1", None], n),
                        "v": np.concatenate([rng.exponential(size=4000), np.full(500, 2.5), -rng.exponential(size=500),
                                             10.0 ** rng.uniform(-300, 300, 500), np.full(300, np.nan), [0.0, -0.0] * 100])})
    df = spark.createDataFrame(pdf)
    probs = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0]
    for parts in (4096, 7):
        out = {r["g"]: r["_q"] for r in Q.exact_quantiles(df, ["g"], "v", probs, buckets=parts).collect()}
        assert len(out) == 3
        for g, sub in pdf.groupby("g", dropna=False):
            want = sub["v"].quantile(probs).tolist()
            assert out[None if pd.isna(g) else g] == pytest.approx(want, rel=1e-12, abs=1e-300)
    whole = Q.exact_quantiles(df, [], "v", probs).first()["_q"]
    assert whole == pytest.approx(pdf["v"].quantile(probs).tolist(), rel=1e-12)
    assert Q.exact_quantiles(df.limit(0), ["g"], "v", probs).count() == 0


def test_order_statistics_with_infinities_end(spark):
    from assay.operators import quantiles as Q
    inf = float("inf")
    rows = [("a", float(x)) for x in range(2000)] + [("a", inf), ("b", -inf), ("b", inf), ("b", 1.0), ("c", inf), ("d", 5e-324), ("d", 1e-323)]
    df = spark.createDataFrame(rows, "g string, v double")
    got = {r["g"]: r["_q"] for r in Q.exact_quantiles(df, ["g"], "v", [0.0, 0.5, 1.0]).collect()}
    assert got == {"a": [0.0, 1000.0, inf], "b": [-inf, 1.0, inf], "c": [inf] * 3, "d": [5e-324, 5e-324, 1e-323]}


def test_selection_levels_do_not_grow_with_rows(spark):
    """A level is one scan; twenty times the rows need at most one level more."""
    from unittest import mock
    from assay.operators import quantiles as Q
    levels = []
    for n in (20_000, 400_000):
        df = spark.range(n).select((F.xxhash64("id") / F.lit(2.0 ** 63)).alias("v"))
        with mock.patch.object(Q, "settled", side_effect=Q.settled) as s:
            Q.exact_quantiles(df, [], "v", [0.1, 0.5, 0.9]).collect()
        levels.append(s.call_count)
    assert levels[1] <= levels[0] + 1 <= 7


def test_the_feature_pipeline_is_code_the_jvm_compiles(spark):
    """HotSpot interprets methods over 8000 bytes: the fitted stages must stay below."""
    from assay.plans import model_data as MD
    from conftest import SF001
    train = MD.labelled(spark, SF001)
    out = MD.feature_pipeline(MD.FEATS, MD.SEG, MD.ROLES).fit(train).transform(train)
    debug = getattr(getattr(spark._jvm.org.apache.spark.sql.execution.debug, "package$"), "MODULE$")
    parts = debug.codegenStringSeq(out._jdf.queryExecution().executedPlan())
    assert max(parts.apply(i)._3().maxMethodCodeSize() for i in range(parts.size())) <= 8000


def test_clip_keeps_null_and_nan_and_passes_null_bounds(spark):
    nan = float("nan")
    df = spark.createDataFrame([(0, None, 1.0, 2.0), (1, nan, 1.0, 2.0), (2, 0.0, 1.0, 2.0), (3, 3.0, 1.0, 2.0),
                                (4, 0.0, None, 2.0), (5, 3.0, 1.0, None), (6, 1.5, 1.0, 2.0)], "k int, x double, lo double, hi double")
    got = [r[0] for r in df.orderBy("k").select(ST.clip(F.col("x"), F.col("lo"), F.col("hi"))).collect()]
    assert got[0] is None and got[1] != got[1] and got[2:] == [1.0, 2.0, 0.0, 3.0, 1.5]
