"""Model frames, leaderboards, cross-validation, tuning, importances.

The driver only orchestrates: every fit, prediction and metric is a Spark job, and
what comes back to the driver is a handful of numbers per model (metrics, times,
params) -- the leaderboard rows.
"""

from __future__ import annotations

import itertools
import time
import traceback
from dataclasses import replace

from pyspark.ml.evaluation import MulticlassClassificationEvaluator, RegressionEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.operators import boosting as BO
from assay.operators import forest as FO
from assay.operators import fourier as FR
from assay.operators import learners as L
from assay.operators import linear as LI
from assay.operators import metrics as ME
from assay.operators._small import collect_bounded
from assay.operators.knn import KNNEstimator
from assay.operators.learners import FoldwiseEstimator

REG_SCHEMA = T.StructType([
    T.StructField("ordinal", T.IntegerType()), T.StructField("model", T.StringType()),
    T.StructField("rmse", T.DoubleType()), T.StructField("r2", T.DoubleType()),
    T.StructField("cv_rmse", T.DoubleType()), T.StructField("train_seconds", T.DoubleType()),
    T.StructField("status", T.StringType()), T.StructField("error", T.StringType())])
CLS_SCHEMA = T.StructType([
    T.StructField("ordinal", T.IntegerType()), T.StructField("model", T.StringType()),
    T.StructField("accuracy", T.DoubleType()), T.StructField("cv_accuracy", T.DoubleType()),
    T.StructField("train_seconds", T.DoubleType()), T.StructField("status", T.StringType()),
    T.StructField("error", T.StringType())])


def estimator_for(task: str, name: str, train: DataFrame, num_classes: int = 2, **kw):
    n, s = L.label_stats(train, "label")
    if task == "regression":
        return L.regressor(name, n, s, **kw)
    return L.classifier(name, n, num_classes, **kw)


def evaluator_for(task: str):
    if task == "regression":
        return RegressionEvaluator(metricName="mse", labelCol="label", predictionCol="prediction")
    return MulticlassClassificationEvaluator(metricName="accuracy", labelCol="label", predictionCol="prediction")


def cross_validate(est, train: DataFrame, task: str, fold_col: str = "fold", param_maps=None,
                   parallelism: int = 5):
    """K-fold CV on a precomputed fold column (exact, repeatable folds).
    Returns the CrossValidatorModel; ``avgMetrics`` are mean fold MSE or accuracy.  Folds
    (and grid points) train concurrently: on small inputs each fit is latency-bound."""
    k = train.agg(F.max(fold_col)).first()[0] + 1
    cv = CrossValidator(estimator=est, estimatorParamMaps=param_maps or [{}], evaluator=evaluator_for(task),
                        numFolds=k, foldCol=fold_col, parallelism=parallelism, seed=L.SEED)
    return cv.fit(train)


def fit_and_cross_validate(task: str, name: str, train: DataFrame, num_classes: int = 2, cv: bool = True, **kw):
    """(model on all rows, mean fold MSE or accuracy or None).  Linear models take all folds
    from one scan's moments, trees, forests and boosting grow all folds together, SVMs take
    their steps for all folds in the same scans, kNN is one join in which a row's own fold does not
    count; logistic regression is fitted fold by fold."""
    est = estimator_for(task, name, train, num_classes, **kw)
    if not cv:
        return est.fit(train), None
    if isinstance(est, LI.GramRegression):
        folds = LI.fold_moments(train, est.features, est.label, "fold")
        total = sum(list(folds.values())[1:], next(iter(folds.values())))
        return est.model(total), LI.cross_validated(folds, LI.PENALTIES[name])
    if isinstance(est, (FO.ForestEstimator, BO.BoostedEstimator)):
        data = FO.training_table(train, est.features, est.label, "fold")
        folds = [r[0] for r in collect_bounded(data.select("fold").distinct(), LI.MAX_FOLDS)]
        specs = [est.spec, *(replace(est.spec, skip_fold=f) for f in sorted(folds))]
        if isinstance(est, BO.BoostedEstimator):
            fitted = BO.fit(data, specs)
            return fitted.model(0, est.features), fold_mean(fitted.left_out(), task)
        forests = FO.fit(data, specs)
        scored = left_out(forests, data, {s.skip_fold: [i] for i, s in enumerate(specs) if s.skip_fold is not None})
        p = scored.select("fold", "y", FO.predicted(F.col("p"), forests.classes)[-1].alias("prediction"))
        return FO.ForestModel(forests, 0, est.features), fold_mean(p, task)
    if isinstance(est, FR.FourierEstimator):
        return est.cross_validated(FR.training_rows(train, est.features, est.label, "fold"))
    if isinstance(est, KNNEstimator):
        model, scored = est.cross_validated(train, "fold")
        folds = range(train.agg(F.max("fold")).first()[0] + 1)
        met = {r[0] for r in collect_bounded(scored.select("fold").distinct(), LI.MAX_FOLDS)}
        if missing := [f for f in folds if f not in met]:
            raise ValueError(f"The validation data at fold {missing[0]} is empty.")
        ev = evaluator_for(task)
        return model, sum(ev.evaluate(scored.where(F.col("fold") == f)) for f in folds) / len(folds)
    cvm = cross_validate(FoldwiseEstimator(task, name, num_classes, **kw), train, task)
    return est.fit(train), float(cvm.avgMetrics[0])


def left_out(forests: FO.Forests, data: DataFrame, by_fold: dict, limits: list[int] | None = None) -> DataFrame:
    """(fold, y, spec, p): every row scored by the forests (``by_fold``: their numbers) that
    did not see its fold."""
    specs = F.create_map(*[F.lit(x) if not isinstance(x, list) else F.array(*[F.lit(i) for i in x])
                           for kv in by_fold.items() for x in kv])
    rows = data.select(F.col("rid").alias("qid"), F.explode(specs[F.col("fold")]).alias("spec"), "x")
    return FO.score(forests, rows, limits).join(data.select(F.col("rid").alias("qid"), "fold", "y"), "qid")


def fold_mean(scored: DataFrame, task: str, by: tuple = ()):
    """Mean over the folds of the squared error or accuracy in ``scored(fold, y, prediction)``;
    one number, or a frame with ``by`` and ``metric``."""
    hit = F.pow(F.col("y") - F.col("prediction"), 2) if task == "regression" else (F.col("y") == F.col("prediction")).cast("double")
    per = scored.groupBy(*by, "fold").agg(F.avg(hit).alias("m")).groupBy(*by).agg(F.avg("m").alias("metric"))
    return per if by else per.first()["metric"]


def leaderboard(train: DataFrame, test: DataFrame, task: str, models=None, cv: bool = True,
                num_classes: int = 2, **kw) -> DataFrame:
    """Fit, score and cross-validate each model; a failing model stays as a row with
    its error (quirk Q14).  ``train`` carries 'features', 'label' and 'fold'."""
    spark = train.sparkSession
    models = models or (L.REGRESSORS if task == "regression" else L.CLASSIFIERS)
    rows = []
    for i, name in enumerate(models, start=1):
        t0 = time.time()
        try:
            model, metric = fit_and_cross_validate(task, name, train, num_classes, cv, **kw)
            pred = model.transform(test)
            if task == "regression":
                m = ME.regression_metrics(pred, "label", "prediction").first()
                cv_rmse = metric ** 0.5 if cv else None
                rows.append((i, name, m["rmse"], m["r2"], cv_rmse, time.time() - t0, "ok", None))
            else:
                acc = ME.accuracy(pred, "label", "prediction").first()["accuracy"]
                rows.append((i, name, acc, metric, time.time() - t0, "ok", None))
        except Exception as e:  # noqa: BLE001 -- a failing model is a leaderboard row
            err = f"{type(e).__name__}: {e}"
            traceback.print_exc()
            if task == "regression":
                rows.append((i, name, None, None, None, time.time() - t0, "failed", err))
            else:
                rows.append((i, name, None, None, time.time() - t0, "failed", err))
    return spark.createDataFrame(rows, REG_SCHEMA if task == "regression" else CLS_SCHEMA)


#: M24 grid, 24 points; the 100-tree points are the first trees of the 200-tree ones.
GRID = {"n_estimators": [100, 200], "max_depth": [None, 10, 20], "min_samples_split": [2, 5], "min_samples_leaf": [1, 2]}


def tune_forest(train: DataFrame, task: str, num_classes: int = 2, grid: dict | None = None):
    """M24 + S6: grid search by CV, refit on the best (the first one wins ties); returns
    (best model, tuning log frame).  All folds and grid points grow in one pass: the same
    drawn rows serve every rule, and fewer trees are a prefix of more.  Trees are scored where
    they grow and not kept, up to a million numbers of features; beyond, they are written."""
    spark, grid = train.sparkSession, grid or GRID
    data = FO.training_table(train, "features", "label", "fold")
    folds = sorted(r[0] for r in collect_bounded(data.select("fold").distinct(), LI.MAX_FOLDS))
    classes = 0 if task == "regression" else max(num_classes, 2)
    counts = sorted(grid["n_estimators"])
    rules = list(itertools.product(grid["max_depth"], grid["min_samples_split"], grid["min_samples_leaf"]))
    specs = [L.forest_spec("Random Forest", classes, d, counts[-1], sp, lf, fold) for d, sp, lf in rules for fold in folds]
    width = classes or 1
    n, n_features = data.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if n and FO.whole_trees(n, n_features):
        scored = FO.left_out_sums(data, specs, counts)
        parts = [F.struct(F.lit(i).alias("rule"), F.lit(m).alias("n"), FO.predicted(
                     F.transform(F.slice("p", 1 + (j * len(rules) + i) * width, width), lambda v: v / m), classes)[-1].alias("prediction"))
                 for j, m in enumerate(counts) for i in range(len(rules))]
        long = scored.select("fold", "y", F.inline(F.array(*parts)))
    else:
        forests = FO.fit(data, specs)
        of = {f: [i for i, s in enumerate(specs) if s.skip_fold == f] for f in folds}
        scored = left_out(forests, data, of, counts)
        parts = [F.struct(F.lit(m).alias("n"), FO.predicted(F.slice("p", 1 + i * width, width), classes)[-1].alias("prediction"))
                 for i, m in enumerate(counts)]
        long = scored.select("fold", "y", F.floor(F.col("spec") / len(folds)).cast("int").alias("rule"), F.inline(F.array(*parts)))
    metric = {(r["rule"], r["n"]): r["metric"] for r in collect_bounded(fold_mean(long, task, ("rule", "n")))}
    sign = -1.0 if task == "regression" else 1.0        # the log reports negative squared errors
    log = []
    for i, (depth, split, leaf) in enumerate(rules):
        for n in counts:
            log.append(({"n_estimators": str(n), "max_depth": str(depth), "min_samples_split": str(split),
                         "min_samples_leaf": str(leaf)}, sign * float(metric[i, n]), (depth, split, leaf, n)))
    depth, split, leaf, n = max(log, key=lambda r: r[1])[2]
    best = FO.ForestEstimator(L.forest_spec("Random Forest", classes, depth, n, split, leaf)).fit(train)
    return best, spark.createDataFrame([r[:2] for r in log], "params map<string,string>, mean_test_score double")


def feature_importance(model, features, k: int = 15, spark=None) -> DataFrame:
    """Importances zipped with names, top k by value (ties by name)."""
    imp = [float(v) for v in model.featureImportances.toArray()]
    df = spark.createDataFrame(list(zip(list(features), imp)), "feature string, importance double")
    return df.orderBy(F.desc("importance"), "feature").limit(min(k, len(features)))


# --------------------------------------------------------------------------- S4 / S5

def save_model(model, path: str) -> str:
    """Persist a fitted stage or pipeline (``PipelineModel`` directory)."""
    model.write().overwrite().save(path)
    return path


def load_model(path: str):
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)


def pick_model(registry: DataFrame, segment: str, task: str, order=("tuned", "standard")) -> DataFrame:
    """Choose a stored model for (segment, task) by variant priority, falling back in
    ``order``; the first path of equals.  The registry is a table (segment, task, variant, path)."""
    prio = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(i))])
    cand = registry.where((F.col("segment") == segment) & (F.col("task") == task)) \
                   .withColumn("priority", F.element_at(prio, F.col("variant"))) \
                   .where(F.col("priority").isNotNull())
    return cand.orderBy("priority", "path").limit(1)
