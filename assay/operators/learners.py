"""Learners (M3-M17) as Spark ML estimators, parameterised like the reference's models.

* Linear family (M3-M6): exact solutions from one scan's moments (``linear.py``).
* Logistic regression (M12): Spark minimises the *mean* loss, the reference's penalty is on
  the *sum*: C=1 is ``regParam = 1 / n``, with ``standardization=False``; Newton steps on sums
  (``logistic.py``).
* Trees and forests (M7, M8, M13, M14): grown without a depth cap (``forest.py``).
* Boosting (M9, M15): 100 rounds of depth 3, softmax over the classes for three
  (``boosting.py``).
* RBF SVMs (M10, M16) are re-aimed to random Fourier features + a linear model (``fourier.py``).
* kNN (M11, M17) is the exact k-nearest-neighbour join in ``knn.py``.
"""


from pyspark.ml import Estimator
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators.boosting import BoostedEstimator, BoostSpec
from assay.operators.forest import SQRT, ForestEstimator, ForestSpec
from assay.operators.fourier import FourierEstimator
from assay.operators.linear import PENALTIES, GramRegression
from assay.operators.logistic import NewtonLogisticRegression
from assay.operators.trees import TreeRule

SEED = 42

REGRESSORS = ["Linear Regression", "Ridge Regression", "Lasso Regression", "ElasticNet",
              "Decision Tree", "Random Forest", "Gradient Boosting", "SVR", "KNN"]
CLASSIFIERS = ["Logistic Regression", "Decision Tree", "Random Forest", "Gradient Boosting", "SVC", "KNN"]


def forest_spec(name: str, classes: int, max_depth: int | None = None, num_trees: int = 100, min_split: int = 2,
                min_leaf: int = 1, skip_fold: int | None = None) -> ForestSpec:
    """A single tree on all rows, or a forest; class forests draw the square root of the
    features for each split."""
    forest = name == "Random Forest"
    rule = TreeRule(classes, max_depth, min_split, min_leaf, SQRT if forest and classes else None)
    return ForestSpec(num_trees if forest else 1, rule, forest, SEED, skip_fold)


def label_stats(df: DataFrame, label: str):
    r = df.agg(F.count(F.col(label)).alias("n"), F.stddev_pop(F.col(label).cast("double")).alias("s")).first()
    return r["n"], (r["s"] or 0.0)


def regressor(name: str, n: int, label_std: float, features: str = "features", label: str = "label",
              max_depth: int | None = None, num_trees: int = 100):
    """One regression estimator by the reference's model name."""
    if name in PENALTIES:
        return GramRegression(name, features, label)
    if name in ("Decision Tree", "Random Forest"):
        return ForestEstimator(forest_spec(name, 0, max_depth, num_trees), features, label)
    if name == "Gradient Boosting":
        return BoostedEstimator(BoostSpec(0), features, label)
    if name == "SVR":
        return FourierEstimator(0, features, label, seed=SEED)
    if name == "KNN":
        from assay.operators.knn import KNNEstimator
        return KNNEstimator(featuresCol=features, labelCol=label, k=5, mode="mean")
    raise ValueError(f"unknown regressor {name}")


def classifier(name: str, n: int, num_classes: int, features: str = "features", label: str = "label",
               max_depth: int | None = None, num_trees: int = 100):
    """One classification estimator by the reference's model name."""
    common = dict(featuresCol=features, labelCol=label)
    if name == "Logistic Regression":
        return NewtonLogisticRegression(maxIter=1000, regParam=1.0 / max(n, 1), elasticNetParam=0.0,
                                        standardization=False, family="auto", **common)
    if name in ("Decision Tree", "Random Forest"):
        return ForestEstimator(forest_spec(name, max(num_classes, 2), max_depth, num_trees), features, label)
    if name == "Gradient Boosting":
        return BoostedEstimator(BoostSpec(max(num_classes, 2)), features, label)
    if name == "SVC":
        return FourierEstimator(max(num_classes, 2), features, label, seed=SEED)
    if name == "KNN":
        from assay.operators.knn import KNNEstimator
        return KNNEstimator(featuresCol=features, labelCol=label, k=5, mode="vote")
    raise ValueError(f"unknown classifier {name}")


class FoldwiseEstimator(Estimator):
    """A learner whose penalty depends on its rows: the row count and label deviation are
    taken from the rows of each fit, so a CV fold gets its own penalty."""

    def __init__(self, task: str, name: str, num_classes: int = 2, **kw):
        super().__init__()
        self.task, self.name, self.num_classes, self.kw = task, name, num_classes, kw

    def _fit(self, df):
        n, s = label_stats(df, "label")
        est = regressor(self.name, n, s, **self.kw) if self.task == "regression" \
            else classifier(self.name, n, self.num_classes, **self.kw)
        return est.fit(df)


# --------------------------------------------------------------------------- importances

def assemble(df: DataFrame, features, out: str = "features") -> DataFrame:
    """Feature vector of every row; a null or NaN feature counts as 0, as in the model path."""
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(df.fillna(0.0, subset=list(features)))


def forest_importances(df: DataFrame, features, label: str, num_trees: int = 100) -> DataFrame:
    """random-forest (100 trees, seed 42) importances as a (feature, score) table."""
    features = list(features)
    data = assemble(df.where(F.col(label).isNotNull()), features).select("features", F.col(label).cast("double").alias("label"))
    n, s = label_stats(data, "label")
    rf = regressor("Random Forest", n, s, num_trees=num_trees)
    m = rf.fit(data)
    imp = m.featureImportances.toArray().tolist()
    return df.sparkSession.createDataFrame(list(zip(features, [float(v) for v in imp])), "feature string, score double")
