"""Splits, folds and metrics (M1, M2, M18-M23) against brute force."""

import hashlib
import math

import pytest
from pyspark.sql import functions as F

from assay.operators import metrics as ME
from assay.operators import split as SP


def _md5_order(keys, seed=42):
    return sorted(keys, key=lambda k: hashlib.md5(f"{seed}{k}".encode()).hexdigest())


def test_split_is_first_fifth_of_md5_order(spark):
    df = spark.range(0, 1003).withColumnRenamed("id", "k")
    out = SP.with_split(df, ["k"], 0.2, 42)
    test = {r[0] for r in out.where("split = 'test'").select("k").collect()}
    expected = set(_md5_order(range(1003))[:math.ceil(0.2 * 1003)])
    assert test == expected


def test_kth_smallest_over_levels(spark):
    df = spark.range(0, 500).withColumn("h", SP.hash60(F.col("id").cast("string")))
    vals = sorted(r[0] for r in df.select("h").collect())
    got = SP.kth_smallest(df, "h", {k: ("", k) for k in (0, 1, 77, 250, 500)})
    assert got == {0: None, **{k: vals[k - 1] for k in (1, 77, 250, 500)}}


def test_null_class_is_split_like_any_other(spark):
    df = spark.range(0, 1000).select(F.col("id").alias("k"), F.when(F.col("id") % 2 == 0, F.lit("a")).alias("y"))
    s = SP.with_split(df, ["k"], 0.2, 42, stratify="y").where("split = 'test'").groupBy("y").count().collect()
    assert {r["y"]: r["count"] for r in s} == {"a": 100, None: 100}
    f = SP.with_folds(df, ["k"], 5, 42, stratify="y").groupBy("y", "fold").count().collect()
    assert len(f) == 10 and {r["count"] for r in f} == {100}


def test_report_reads_its_input_once(spark, tmp_path):
    spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, p int").write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    report = ME.classification_report(df, "y", "p")
    assert "FileScan" not in report._jdf.queryExecution().executedPlan().toString()


def test_stratified_split_and_folds_balanced(spark):
    df = spark.range(0, 997).withColumn("y", (F.col("id") % 3).cast("int")).withColumnRenamed("id", "k")
    s = SP.with_split(df, ["k"], 0.2, 42, stratify="y")
    per = {r["y"]: r["count"] for r in s.where("split = 'test'").groupBy("y").count().collect()}
    tot = {r["y"]: r["count"] for r in df.groupBy("y").count().collect()}
    assert all(per[c] == math.ceil(0.2 * tot[c]) for c in tot)
    f = SP.with_folds(df, ["k"], 5, 42, stratify="y")
    sizes = f.groupBy("y", "fold").count().collect()
    for c in tot:
        cs = [r["count"] for r in sizes if r["y"] == c]
        assert len(cs) == 5 and max(cs) - min(cs) <= 1


def test_folds_same_at_different_partitioning(spark):
    df = spark.range(0, 400).withColumnRenamed("id", "k")
    a = SP.with_folds(df.repartition(1), ["k"], 5).orderBy("k").collect()
    b = SP.with_folds(df.repartition(16), ["k"], 5).orderBy("k").collect()
    assert a == b


def test_metrics_hand_values(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 3.0), (4.0, 2.0)], "y double, p double")
    m = ME.regression_metrics(df, "y", "p").first()
    assert m["mse"] == pytest.approx(1.25) and m["rmse"] == pytest.approx(math.sqrt(1.25))
    assert m["r2"] == pytest.approx(1 - 5.0 / 5.0)
    c = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, p int")
    assert ME.accuracy(c, "y", "p").first()["accuracy"] == pytest.approx(0.5)
    cm = {(r["label"], r["prediction"]): r["n"] for r in ME.confusion(c, "y", "p").collect()}
    assert len(cm) == 9 and cm[(0, 0)] == 1 and cm[(2, 2)] == 0
    rep = {r["class"]: r for r in ME.classification_report(c, "y", "p").collect()}
    assert rep["2"]["precision"] == 0.0 and rep["2"]["recall"] == 0.0     # undefined -> 0
    assert rep["1"]["precision"] == pytest.approx(1 / 3) and rep["macro avg"]["support"] == 4
