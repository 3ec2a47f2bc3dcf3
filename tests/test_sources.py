"""Delimited reads with declared schema, errors, registry picks, set ops."""

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import types as T

from assay.operators import ordering as OR
from assay.operators import training as TR
from assay.sources import tables as IO

SCHEMA = T.StructType([T.StructField("fixed acidity", T.DoubleType()), T.StructField("citric acid", T.DoubleType()),
                       T.StructField("quality", T.IntegerType())])


def test_read_delimited_declared_schema_and_corrupt_rows(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("fixed acidity;citric acid;quality\n7.4;0;5\noops;1;6\n")
    df = IO.read_delimited(spark, str(p), SCHEMA, sep=";", corrupt_column="_bad")
    rows = df.orderBy("quality").collect()
    assert rows[0]["citric acid"] == 0.0 and isinstance(rows[0]["citric acid"], float)   # never inferred as int
    assert rows[1]["fixed acidity"] is None and rows[1]["_bad"] == "oops;1;6"


def test_missing_file_is_an_error_not_a_crash(spark, tmp_path):
    with pytest.raises(AnalysisException):
        IO.read_delimited(spark, str(tmp_path / "absent.csv"), SCHEMA, sep=";").collect()


def test_write_partitioned_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "red"), (2, "white"), (3, "red")], "k int, seg string")
    path = IO.write_table(df, str(tmp_path / "t"), partition_by="seg")
    back = IO.read_table(spark, path).where("seg = 'red'")
    assert sorted(r["k"] for r in back.collect()) == [1, 3]
    assert "PartitionFilters: [isnotnull(seg" in back._jdf.queryExecution().executedPlan().toString()


def test_pick_model_priority_and_fallback(spark):
    reg = spark.createDataFrame([("red", "regression", "standard", "/a"), ("red", "regression", "tuned", "/b"),
                                 ("white", "regression", "standard", "/c")],
                                "segment string, task string, variant string, path string")
    assert TR.pick_model(reg, "red", "regression").first()["path"] == "/b"
    assert TR.pick_model(reg, "white", "regression").first()["path"] == "/c"          # falls back
    assert TR.pick_model(reg, "red", "regression", order=("standard", "tuned")).first()["path"] == "/a"


def test_column_diff_and_union_by_name(spark):
    d = {(r["name"], r["status"]) for r in OR.column_diff(spark, ["a", "b", "c"], ["b", "c", "z"]).collect()}
    assert d == {("a", "missing"), ("z", "extra")}
    u = OR.union_tagged({"red": spark.createDataFrame([(1.0, 2)], "x double, q int"),
                         "white": spark.createDataFrame([(3, 4.0)], "q int, x double")}, "source")
    assert sorted((r["x"], r["q"], r["source"]) for r in u.collect()) == [(1.0, 2, "red"), (4.0, 3, "white")]


def test_pick_model_ties_and_nothing_to_pick(spark):
    from assay.operators import training as TR
    reg = spark.createDataFrame([("red", "regression", "tuned", p) for p in ("/z", "/m", "/q")] +
                                [("red", "binary", "draft", "/d")], "segment string, task string, variant string, path string")
    assert TR.pick_model(reg, "red", "regression").first()["path"] == "/m"
    assert TR.pick_model(reg, "red", "binary").count() == 0             # a variant that is in no order
    assert TR.pick_model(reg, "rose", "regression").count() == 0
