"""Evaluation metrics (M18-M21) as aggregates over (label, prediction) columns.

All are one pass with partial aggregation; the classification report and the
confusion matrix count (label, prediction) pairs once and derive labels, totals and
averages from that table, whose size is the number of classes squared.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assay.operators._small import settled


def regression_metrics(df: DataFrame, label: str, pred: str, group=()) -> DataFrame:
    """MSE, RMSE, R2 = 1 - SSE/SST (per group when given)."""
    y, p = F.col(label).cast("double"), F.col(pred).cast("double")
    g = list(group)
    agg = [F.avg(F.pow(y - p, 2)).alias("mse"), F.count(F.lit(1)).alias("n"),
           F.sum(F.pow(y - p, 2)).alias("_sse"), (F.var_pop(y) * F.count(y)).alias("_sst")]
    out = df.groupBy(*g).agg(*agg) if g else df.agg(*agg)
    return out.select(*g, "mse", F.sqrt("mse").alias("rmse"),
                      (1 - F.try_divide(F.col("_sse"), F.col("_sst"))).alias("r2"), "n")


def accuracy(df: DataFrame, label: str, pred: str, group=()) -> DataFrame:
    """M19."""
    g = list(group)
    a = [F.avg((F.col(label).cast("double") == F.col(pred).cast("double")).cast("double")).alias("accuracy"),
         F.count(F.lit(1)).alias("n")]
    return df.groupBy(*g).agg(*a) if g else df.agg(*a)


def confusion(df: DataFrame, label: str, pred: str, labels=None) -> DataFrame:
    """Counts for every (true, predicted) pair of the label set, zero cells kept."""
    counts = settled(df.groupBy(F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("prediction"))
                     .agg(F.count(F.lit(1)).alias("n")))
    if labels is None:
        ls = counts.select(F.col("label").alias("v")).union(counts.select(F.col("prediction").alias("v"))).distinct()
    else:
        ls = df.sparkSession.createDataFrame([(int(v),) for v in labels], "v int")
    grid = _grid(ls)
    return (grid.join(counts, ["label", "prediction"], "left")
            .select("label", "prediction", F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def _grid(ls: DataFrame) -> DataFrame:
    """All (label, prediction) pairs of a class list: collect the list into one array
    and explode it twice (a generator, no join)."""
    arr = ls.agg(F.array_sort(F.collect_set("v")).alias("a"))
    return (arr.select(F.explode("a").alias("label"), "a")
            .select("label", F.explode("a").alias("prediction")))


def classification_report(df: DataFrame, label: str, pred: str, labels=None) -> DataFrame:
    """Precision, recall, F1, support per class, plus 'macro avg' and 'weighted avg'
    rows; 0 where undefined.  Class rows carry the class as text."""
    cm = settled(confusion(df, label, pred, labels))
    per = cm.groupBy("label").agg(F.sum("n").alias("support"),
                                  F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n"))).alias("tp"))
    predicted = cm.groupBy(F.col("prediction").alias("label")).agg(F.sum("n").alias("npred"))
    j = per.join(predicted, "label")
    prec = F.coalesce(F.try_divide(F.col("tp"), F.col("npred")), F.lit(0.0))
    rec = F.coalesce(F.try_divide(F.col("tp"), F.col("support")), F.lit(0.0))
    f1 = F.coalesce(F.try_divide(2 * prec * rec, prec + rec), F.lit(0.0))
    rows = j.select(F.col("label").cast("string").alias("class"), prec.cast("double").alias("precision"),
                    rec.cast("double").alias("recall"), f1.cast("double").alias("f1"),
                    F.col("support").cast("long").alias("support"))
    w = Window.partitionBy()
    tot = rows.withColumn("_t", F.sum("support").over(w))
    macro = rows.agg(F.lit("macro avg").alias("class"), F.avg("precision").alias("precision"),
                     F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), F.sum("support").alias("support"))
    weighted = tot.agg(F.lit("weighted avg").alias("class"),
                       (F.sum(F.col("precision") * F.col("support")) / F.first("_t")).alias("precision"),
                       (F.sum(F.col("recall") * F.col("support")) / F.first("_t")).alias("recall"),
                       (F.sum(F.col("f1") * F.col("support")) / F.first("_t")).alias("f1"),
                       F.sum("support").alias("support"))
    return rows.unionByName(macro).unionByName(weighted)
