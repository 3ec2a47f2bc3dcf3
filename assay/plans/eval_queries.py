"""Split, fold and metric queries (M1, M2, M18-M23 folds) on binding B1 with oracles.

Metrics need predictions that SQL can restate, so they score two baseline models
fitted on the train split only: the per-segment mean score (regression) and price
tertile bins (3 classes).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.functions.scalar import multiclass
from assay.operators import metrics as ME
from assay.operators import split as SP
from assay.operators._small import attach
from assay.plans.bindings import B1, M_SQL, measurements
from assay.plans.catalog import query, rounded

KEYS = list(B1.key)
SEG = B1.segment
KEY_SQL = ("md5('42' || CONCAT_WS('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), "
           "CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)))")


def labelled(spark, sf):
    return measurements(spark, sf).withColumn("quality_multiclass", multiclass(F.col("score")))


LAB_SQL = f"""{M_SQL}, lab AS (SELECT *, CAST(CASE WHEN score BETWEEN 0 AND 4 THEN 0 WHEN score <= 6 THEN 1
  ELSE 2 END AS INTEGER) AS quality_multiclass, {KEY_SQL} AS h FROM m)"""

SPLIT_SQL = f"""{LAB_SQL},
sp AS (SELECT *, CASE WHEN ROW_NUMBER() OVER (ORDER BY h) <= CEIL(0.2 * COUNT(*) OVER ()) THEN 'test'
  ELSE 'train' END AS split FROM lab)"""


@query("m1_split", f"""WITH {SPLIT_SQL} SELECT {', '.join(KEYS)}, split FROM sp""")
def m1_split(spark, sf):
    return SP.with_split(measurements(spark, sf).select(*KEYS), KEYS, 0.2, 42)


@query("m2_stratified_split", f"""WITH {LAB_SQL}
SELECT {', '.join(KEYS)}, quality_multiclass, CASE WHEN ROW_NUMBER() OVER (PARTITION BY quality_multiclass ORDER BY h)
  <= CEIL(0.2 * COUNT(*) OVER (PARTITION BY quality_multiclass)) THEN 'test' ELSE 'train' END AS split FROM lab""")
def m2_stratified_split(spark, sf):
    d = labelled(spark, sf).select(*KEYS, "quality_multiclass")
    return SP.with_split(d, KEYS, 0.2, 42, stratify="quality_multiclass")


def _fold_sql(part: str) -> str:
    p = f"PARTITION BY {part} " if part else ""
    return f"""r AS (SELECT *, ROW_NUMBER() OVER ({p}ORDER BY h) - 1 AS rk, COUNT(*) OVER ({'PARTITION BY ' + part if part else ''}) AS n FROM lab),
f AS (SELECT *, n // 5 AS q, n % 5 AS rem FROM r)
SELECT {', '.join(KEYS)}, {part + ', ' if part else ''}CAST(CASE WHEN rk < rem * (q + 1) THEN rk // (q + 1)
  ELSE rem + (rk - rem * (q + 1)) // q END AS INTEGER) AS fold FROM f"""


@query("m22_folds", f"WITH {LAB_SQL},\n" + _fold_sql(""))
def m22_folds(spark, sf):
    return SP.with_folds(measurements(spark, sf).select(*KEYS), KEYS, 5, 42)


@query("m23_stratified_folds", f"WITH {LAB_SQL},\n" + _fold_sql("quality_multiclass"))
def m23_stratified_folds(spark, sf):
    d = labelled(spark, sf).select(*KEYS, "quality_multiclass")
    return SP.with_folds(d, KEYS, 5, 42, stratify="quality_multiclass")


def _split_frame(spark, sf):
    return SP.with_split(labelled(spark, sf), KEYS, 0.2, 42)


def _seg_mean_predictions(spark, sf):
    d = _split_frame(spark, sf)
    fit = d.where(F.col("split") == "train").groupBy(SEG).agg(F.avg("score").alias("prediction"))
    return attach(d.where(F.col("split") == "test"), fit, [SEG])


@query("m18_regression_metrics", f"""WITH {SPLIT_SQL},
fit AS (SELECT l_returnflag, AVG(score) AS prediction FROM sp WHERE split = 'train' GROUP BY l_returnflag),
t AS (SELECT sp.*, fit.prediction FROM sp JOIN fit USING (l_returnflag) WHERE split = 'test')
SELECT l_returnflag, ROUND(AVG(POW(score - prediction, 2)), 6) AS mse, ROUND(SQRT(AVG(POW(score - prediction, 2))), 6) AS rmse,
  ROUND(1 - SUM(POW(score - prediction, 2)) / (VAR_POP(score) * COUNT(score)), 9) AS r2, COUNT(*) AS n
FROM t GROUP BY l_returnflag""")
def m18_regression_metrics(spark, sf):
    return rounded(ME.regression_metrics(_seg_mean_predictions(spark, sf), "score", "prediction", [SEG]),
                   absolute={"r2": 9})


TERTILES_SQL = f"""{SPLIT_SQL},
q AS (SELECT QUANTILE_CONT(l_extendedprice, 1.0 / 3) AS t1, QUANTILE_CONT(l_extendedprice, 2.0 / 3) AS t2
  FROM sp WHERE split = 'train'),
pr AS (SELECT sp.*, CASE WHEN l_extendedprice < q.t1 THEN 0 WHEN l_extendedprice < q.t2 THEN 1 ELSE 2 END AS prediction
  FROM sp, q WHERE split = 'test')"""


def _tertile_predictions(spark, sf):
    d = _split_frame(spark, sf)
    from assay.operators.profile import quantile_frame
    tr = d.where(F.col("split") == "train").select(F.lit(1).alias("_k"), F.col("l_extendedprice").alias("value"))
    t1, t2 = quantile_frame(tr, ["_k"], [1.0 / 3, 2.0 / 3]).first()["_q"]
    p = F.col("l_extendedprice")
    return d.where(F.col("split") == "test").withColumn(
        "prediction", F.when(p < t1, 0).when(p < t2, 1).otherwise(2))


@query("m19_accuracy", f"""WITH {TERTILES_SQL}
SELECT ROUND(AVG(CAST(quality_multiclass = prediction AS DOUBLE)), 6) AS accuracy, COUNT(*) AS n FROM pr""")
def m19_accuracy(spark, sf):
    return rounded(ME.accuracy(_tertile_predictions(spark, sf), "quality_multiclass", "prediction"))


@query("m21_confusion", f"""WITH {TERTILES_SQL},
ls AS (SELECT DISTINCT v FROM (SELECT quality_multiclass AS v FROM pr UNION ALL SELECT prediction FROM pr)),
c AS (SELECT quality_multiclass AS label, prediction, COUNT(*) AS n FROM pr GROUP BY ALL)
SELECT a.v AS label, b.v AS prediction, COALESCE(c.n, 0) AS n FROM ls a CROSS JOIN ls b
LEFT JOIN c ON c.label = a.v AND c.prediction = b.v""")
def m21_confusion(spark, sf):
    return ME.confusion(_tertile_predictions(spark, sf), "quality_multiclass", "prediction")


@query("m20_classification_report", f"""WITH {TERTILES_SQL},
ls AS (SELECT DISTINCT v FROM (SELECT quality_multiclass AS v FROM pr UNION ALL SELECT prediction FROM pr)),
per AS (SELECT v, (SELECT COUNT(*) FROM pr WHERE quality_multiclass = v) AS support,
  (SELECT COUNT(*) FROM pr WHERE prediction = v) AS npred,
  (SELECT COUNT(*) FROM pr WHERE prediction = v AND quality_multiclass = v) AS tp FROM ls),
pm AS (SELECT CAST(v AS VARCHAR) AS class, COALESCE(tp / NULLIF(npred, 0), 0.0) AS precision,
  COALESCE(tp / NULLIF(support, 0), 0.0) AS recall, support FROM per),
r AS (SELECT class, precision, recall,
  COALESCE(2 * precision * recall / NULLIF(precision + recall, 0), 0.0) AS f1, support FROM pm),
a AS (SELECT * FROM r
  UNION ALL SELECT 'macro avg', AVG(precision), AVG(recall), AVG(f1), SUM(support) FROM r
  UNION ALL SELECT 'weighted avg', SUM(precision * support) / SUM(support), SUM(recall * support) / SUM(support),
    SUM(f1 * support) / SUM(support), SUM(support) FROM r)
SELECT class, ROUND(precision, 6) AS precision, ROUND(recall, 6) AS recall, ROUND(f1, 6) AS f1,
  CAST(support AS BIGINT) AS support FROM a""")
def m20_classification_report(spark, sf):
    return rounded(ME.classification_report(_tertile_predictions(spark, sf), "quality_multiclass", "prediction"))
