"""Hand values for the scalar functions and their quirks (FIXTURES section 1 and 9)."""

import math

import pytest
from pyspark.sql import functions as F

from assay.functions import scalar as S

SAMPLE = {"fixed acidity": 7.4, "volatile acidity": 0.7, "citric acid": 0.0, "residual sugar": 1.9,
          "chlorides": 0.076, "free sulfur dioxide": 11.0, "total sulfur dioxide": 34.0,
          "density": 0.9978, "pH": 3.51, "sulphates": 0.56, "alcohol": 9.4}
ROLES = dict(a="fixed acidity", b="volatile acidity", s="residual sugar", f="free sulfur dioxide",
             t="total sulfur dioxide", h="alcohol", d="density")


def test_derived_ratios_hand_values(spark):
    df = spark.createDataFrame([tuple(SAMPLE.values())], list(SAMPLE))
    row = df.select(*[v.alias(k) for k, v in S.derived_ratios(**ROLES).items()]).first()
    expected = dict(total_acidity=8.1, acidity_to_sugar=2.793103, free_to_total_so2_ratio=0.314286,
                    alcohol_to_acidity=1.032967, sugar_to_alcohol=0.182692, balance_score=1.089962,
                    body_score=8.480680)
    for k, v in expected.items():
        assert row[k] == pytest.approx(v, abs=1e-6), k


def test_balance_score_zero_denominator_is_null(spark):
    df = spark.createDataFrame([(7.0, 0.5, 0.0, 10.0, 30.0, 9.0, 0.99)], "a double, b double, s double, f double, t double, h double, d double")
    row = df.select(S.derived_ratios("a", "b", "s", "f", "t", "h", "d")["balance_score"].alias("x")).first()
    assert row["x"] is None


def test_multiclass_right_closed_bins(spark):
    df = spark.createDataFrame([(s,) for s in [0, 4, 5, 6, 7, 10, -1, 11]], "s int")
    got = [r[0] for r in df.select(S.multiclass(F.col("s"))).collect()]
    assert got == [0, 0, 1, 1, 2, 2, None, None]
    got = [r[0] for r in df.select(S.binary_class(F.col("s"))).collect()]
    assert got == [0, 0, 0, 1, 1, 1, 0, 1]


def test_round_half_even(spark):
    df = spark.createDataFrame([(5.25,), (5.75,), (5.1,), (6.3,)], "x double")
    assert [r[0] for r in df.select(S.round_half(F.col("x"))).collect()] == [5.0, 6.0, 5.0, 6.5]


def test_recode_unmapped_null_and_decode(spark):
    df = spark.createDataFrame([("red",), ("white",), ("rose",)], "t string")
    assert [r[0] for r in df.select(S.recode(F.col("t"), {"red": 0, "white": 1})).collect()] == [0, 1, None]
    idx = spark.createDataFrame([(0,), (2,), (3,)], "i int")
    assert [r[0] for r in idx.select(S.decode(F.col("i"), S.LABELS_3)).collect()] == ["Bad", "Good", None]


def test_conform_missing_and_extra(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0)], "a double, b double, z double")
    out, missing, extra = S.conform(df, ["b", "c", "a"])
    assert out.columns == ["b", "c", "a"] and out.first() == (2.0, 0.0, 1.0)
    assert missing == ["c"] and extra == ["z"]


def test_parse_range_and_format_list(spark):
    df = spark.createDataFrame([("0.3-0.7 g/L",), ("about 12 - 14.5 %",), ("none",)], "t string")
    lo, hi = S.parse_range(F.col("t"))
    assert [tuple(r) for r in df.select(lo, hi).collect()] == [(0.3, 0.7), (12.0, 14.5), (None, None)]
    arr = spark.createDataFrame([([1.234, 5.0],), ([],)], "a array<double>")
    assert [r[0] for r in arr.select(S.format_list(F.col("a"))).collect()] == ["1.23, 5.00", "None"]


def test_verdict_cases(spark):
    df = spark.createDataFrame([(10.5, 10.0, True), (13.0, 10.0, True), (None, 10.0, False),
                                (None, None, True), (None, None, False)],
                               "n double, d double, h boolean")
    pct, v = S.verdict(F.col("n"), F.col("d"), F.col("h"))
    got = [r[0] for r in df.select(v).collect()]
    assert got == ["match", "differs", "none detected", "no reference", "nothing detected"]


def test_serving_transforms(spark):
    df = spark.createDataFrame([(0.0,)], "x double")
    row = df.select(*[c.alias(k) for k, c in S.serving_transforms(["x"]).items()]).first()
    assert row["x_log"] == pytest.approx(math.log1p(1e-5)) and row["x_sqrt"] == pytest.approx(math.sqrt(1e-5))


def test_jitter_mean_deviation_and_repeatability(spark):
    df = spark.range(0, 20_000, 1, 4).select("id", F.when(F.col("id") % 100 != 0, F.col("id") % 7).alias("v"))
    noisy = df.withColumn("j", S.jitter(F.col("v"), seed=7, scale=0.25))
    r = noisy.select((F.col("j") - F.col("v")).alias("d")).agg(F.avg("d"), F.stddev("d"), F.count("d"), F.max(F.abs("d"))).first()
    assert r[0] == pytest.approx(0, abs=5 * 0.25 / math.sqrt(r[2])) and r[1] == pytest.approx(0.25, rel=0.03)
    assert r[2] == 19_800 and 0.7 < r[3] < 2            # a null stays one
    again = df.withColumn("j", S.jitter(F.col("v"), seed=7, scale=0.25))
    assert noisy.orderBy("id").collect() == again.orderBy("id").collect()
    other = df.withColumn("j", S.jitter(F.col("v"), seed=8, scale=0.25))
    assert noisy.where("v is not null").join(other.select("id", F.col("j").alias("k")), "id").where("j = k").count() == 0
    assert df.withColumn("j", S.jitter(F.col("v"), scale=0.0)).where("j != v").count() == 0
