"""Training and test frames for the model queries (binding B1).

Split first (M1, or M2 stratified for classes), then fit the feature pipeline on the
train rows only (quirk Q3), assemble the feature vector and add the CV fold column.
The train frame is cached: every model and every fold re-reads it.  Key hashes are taken
once and written beside the rows: the cuts of split and folds and all fits scan that table.
"""

from __future__ import annotations

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from assay.functions.scalar import binary_class, multiclass
from assay.operators.pipeline import feature_pipeline
from assay.operators.split import hash60, key_string, with_folds, with_split
from assay.plans.bindings import B1, measurements
from assay.session import scratch_path

KEYS = list(B1.key)
SEG = B1.segment
FEATS = list(B1.features)
ROLES = dict(a="l_discount", b="l_tax", s="l_tax", f="l_discount", t="l_tax", h="unit_price", d="l_discount")
TARGET = {"regression": "score", "binary": "quality_binary", "multiclass": "quality_multiclass"}
NUM_CLASSES = {"regression": 0, "binary": 2, "multiclass": 3}
HASH = "key_hash"
SEED = 42
NOT_FEATURES = set(KEYS) | {SEG, HASH, "score", "quality_binary", "quality_multiclass", "split", "fold", "segment_numeric"}

_CACHE: dict = {}


def labelled(spark, sf):
    return measurements(spark, sf).withColumns({"quality_binary": binary_class(F.col("score")),
                                                "quality_multiclass": multiclass(F.col("score"))})


def hashed_rows(spark, sf):
    """The labelled rows with the hash of their key, written once per sf."""
    key = (sf, HASH)
    if key not in _CACHE:
        path = scratch_path(spark, "labelled")
        labelled(spark, sf).withColumn(HASH, hash60(key_string(KEYS), SEED)).write.parquet(path)
        _CACHE[key] = spark.read.parquet(path)
    return _CACHE[key]


def model_data(spark, sf, task: str):
    """(train, test, feature names, fitted feature pipeline) for a task; cached per (sf, task)."""
    key = (sf, task)
    if key in _CACHE:
        return _CACHE[key]
    target = TARGET[task]
    d = with_split(hashed_rows(spark, sf), KEYS, 0.2, SEED, stratify=None if task == "regression" else target, hashed=HASH)
    train_raw = d.where(F.col("split") == "train")
    pm = feature_pipeline(FEATS, SEG, ROLES).fit(train_raw)
    tr, te = pm.transform(train_raw), pm.transform(d.where(F.col("split") == "test"))
    feats = [f.name for f in tr.schema.fields
             if f.name not in NOT_FEATURES and f.dataType.typeName() in ("double", "float", "integer", "long")]
    asm = VectorAssembler(inputCols=feats, outputCol="features", handleInvalid="keep")

    def frame(x):
        x = x.fillna(0.0, subset=feats)  # balance_score is null where its denominator is zero
        return asm.transform(x).select(*KEYS, SEG, "features", F.col(target).cast("double").alias("label"), HASH)
    train = with_folds(frame(tr), KEYS, 5, SEED, stratify=None if task == "regression" else "label", hashed=HASH) \
        .drop(HASH).cache()
    test = frame(te).drop(HASH).cache()
    _CACHE[key] = (train, test, feats, pm)
    return _CACHE[key]
