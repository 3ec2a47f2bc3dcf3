"""Exact kNN join and kNN learners on binding B4 (embeddings), checked against all-pairs SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.operators import knn as K
from assay.operators import split as SP
from assay.plans.bindings import embeddings
from assay.plans.catalog import query, rounded

EMB_SQL = """e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v, label, md5('42' || CAST(vec_id AS VARCHAR)) AS h
  FROM embeddings),
sp AS (SELECT *, ROW_NUMBER() OVER (ORDER BY h) <= CEIL(0.2 * COUNT(*) OVER ()) AS is_test FROM e),
pairs AS (SELECT q.vec_id, r.vec_id AS ref_id, list_distance(q.v, r.v) AS distance, r.label AS ref_label
  FROM sp q, sp r WHERE q.is_test AND NOT r.is_test),
rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY distance, ref_id) AS rank FROM pairs),
nn AS (SELECT * FROM rk WHERE rank <= 5)"""


def _neighbours(spark, sf):
    e = embeddings(spark, sf)
    e = SP.with_split(e, ["vec_id"], 0.2, 42).withColumn("v", F.col("embedding").cast("array<double>"))
    test = e.where(F.col("split") == "test").select("vec_id", "v")
    train = e.where(F.col("split") == "train").select(F.col("vec_id").alias("ref_id"), "v",
                                                      F.col("label").alias("ref_label"))
    return K.knn_join(test, train, "vec_id", "ref_id", "v", "v", k=5, payload=["ref_label"])


@query("j4_knn_join", f"""WITH {EMB_SQL}
SELECT vec_id, rank, ref_id, ROUND(distance, 6) AS distance FROM nn""")
def j4_knn_join(spark, sf):
    nn = _neighbours(spark, sf)
    return rounded(nn.select("vec_id", F.col("rank").cast("long").alias("rank"), "ref_id", "distance"))


@query("m11_knn_regressor", f"""WITH {EMB_SQL}
SELECT vec_id, ROUND(AVG(CAST(ref_label AS DOUBLE)), 6) AS prediction FROM nn GROUP BY vec_id""")
def m11_knn_regressor(spark, sf):
    return rounded(K.knn_predict(_neighbours(spark, sf), "vec_id", "ref_label", "mean"))


@query("m17_knn_classifier", f"""WITH {EMB_SQL},
v AS (SELECT vec_id, ref_label, COUNT(*) AS votes FROM nn GROUP BY ALL)
SELECT vec_id, CAST(arg_min(ref_label, (-votes, ref_label)) AS DOUBLE) AS prediction FROM v GROUP BY vec_id""")
def m17_knn_classifier(spark, sf):
    return K.knn_predict(_neighbours(spark, sf), "vec_id", "ref_label", "vote")
