"""Repeatable splits and folds (M1, M2, M22/M23 fold columns).

Rows are ordered by a 60-bit integer taken from md5(seed || key): the same order a
SQL engine gets from ``ORDER BY md5(...)``.  An exact "first k rows in that order"
needs the k-th smallest hash, which we find without a global sort or a single-task
window: a histogram of the top bits locates the bucket that holds the k-th value, and
each further scan cuts that bucket's interval into 4096 parts (``quantiles.select_ranks``),
for all classes and cuts at once.  Only the thresholds reach the driver.  A null class is a
class of its own.  Rows whose hash equals a threshold (repeated keys) stay on one side.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators._small import collect_bounded
from assay.operators.quantiles import select_ranks

BUCKET_BITS = 12
HASH_BITS = 60


def hash60(key: Column, seed: int = 42) -> Column:
    """First 15 hex digits of md5(seed || key) as a non-negative long."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(str(seed)), key.cast("string"))), 1, 15), 16, 10).cast("long")


def key_string(cols) -> Column:
    return F.concat_ws("-", *[F.col(c).cast("string") for c in cols])


def kth_smallest(df: DataFrame, h: str, ks: dict, group: str | None = None) -> dict:
    """For each target t -> (group value, k), the k-th smallest value of the long column
    ``h`` within the group (1-based).  ``ks`` maps a target id to k (ungrouped) or to
    (group value, k).  Returns {target: threshold}; k <= 0 gives None.  All targets share
    each scan of a joint selection on the executors; only thresholds come back."""
    tg = {t: (v if isinstance(v, tuple) else ("", v)) for t, v in ks.items()}
    live = {t: gv for t, gv in tg.items() if gv[1] > 0}
    result = dict.fromkeys(tg)
    if live:
        gcol = F.col(group).cast("string") if group else F.lit("")
        ranks = df.sparkSession.createDataFrame(sorted({(g, k - 1) for g, k in live.values()}), "_g string, r long")
        data = df.select(gcol.alias("_g"), F.col(h).alias("_v"))
        rows = select_ranks(data, ["_g"], ranks, F.shiftright("_v", HASH_BITS - BUCKET_BITS), _part).collect()
        at = {(r["_g"], r["r"]): r["x"] for r in rows}
        result.update({t: at.get((g, k - 1)) for t, (g, k) in live.items()})
    return result


def _part(v: Column, lo: Column, hi: Column, buckets: int) -> Column:
    """Which of at most ``buckets`` equal parts of the integers lo..hi holds v."""
    return F.floor((v - lo) / (F.floor((hi - lo) / buckets) + 1))


def class_text(c: str) -> Column:
    """A class as text; a null class is a class of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))


def _hashed(df: DataFrame, key_cols, seed: int, hashed: str | None) -> DataFrame:
    return df.withColumn("_h", F.col(hashed) if hashed else hash60(key_string(key_cols), seed))


def with_split(df: DataFrame, key_cols, test_fraction: float = 0.2, seed: int = 42,
               stratify: str | None = None, out: str = "split", hashed: str | None = None) -> DataFrame:
    """M1 / M2: ``split`` = 'test' for the first ceil(f * n) rows (per class when stratified)
    in md5(seed || key) order, 'train' otherwise.  ``hashed`` names a column that holds these
    hashes already."""
    d = _hashed(df, key_cols, seed, hashed)
    if stratify:
        d = d.withColumn("_g", class_text(stratify))
        n = {r[0]: r[1] for r in collect_bounded(d.groupBy("_g").count())}
        ks = {g: math.ceil(test_fraction * c) for g, c in n.items()}
        th = kth_smallest(d, "_h", {g: (g, k) for g, k in ks.items()}, "_g")
        cut = _lookup_threshold(th, F.col("_g"))
        d = d.withColumn(out, F.when(F.col("_h") <= cut, "test").otherwise("train")).drop("_g")
    else:
        n = d.count()
        th = kth_smallest(d, "_h", {"": ("", math.ceil(test_fraction * n))})[""]
        d = d.withColumn(out, F.when(F.lit(th).isNotNull() & (F.col("_h") <= F.lit(th)), "test")
                         .otherwise("train"))
    return d.drop("_h")


def _lookup_threshold(th: dict, g: Column) -> Column:
    kv = []
    for k, v in th.items():
        if v is not None:
            kv += [F.lit(k), F.lit(v)]
    if not kv:
        return F.lit(None).cast("long")
    return F.element_at(F.create_map(*kv), g)


def fold_sizes(n: int, k: int) -> list[int]:
    """Shuffled K-fold chunk sizes: the first n % k folds hold one extra row."""
    return [n // k + (1 if i < n % k else 0) for i in range(k)]


def with_folds(df: DataFrame, key_cols, k: int = 5, seed: int = 42, stratify: str | None = None,
               out: str = "fold", hashed: str | None = None) -> DataFrame:
    """M22 / M23 fold column: consecutive chunks of the md5 order (per class when stratified),
    located by k-1 exact cut points per class; ``hashed`` as in ``with_split``."""
    d = _hashed(df, key_cols, seed, hashed)
    d = d.withColumn("_g", class_text(stratify) if stratify else F.lit(""))
    n = {r[0]: r[1] for r in collect_bounded(d.groupBy("_g").count())}
    targets = {(grp, i): (grp, sum(fold_sizes(c, k)[:i])) for grp, c in n.items() for i in range(1, k)}
    th = kth_smallest(d, "_h", targets, "_g" if stratify else None)
    fold = F.lit(0)
    for i in range(1, k):
        cut = _lookup_threshold({grp: th[(grp, i)] for grp in n}, F.col("_g"))
        fold = fold + F.when(cut.isNotNull() & (F.col("_h") > cut), 1).otherwise(0)
    return d.withColumn(out, fold.cast("int")).drop("_h", "_g")
