"""Sorts, top-k, base rows, repeatable samples, set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_k_per_group(df: DataFrame, group, order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """O1: the first k rows of each group by ``order`` (row_number; ties broken by ``order``'s
    later keys).  The input is a small per-group table (scores), so the window is cheap."""
    group = [group] if isinstance(group, str) else list(group)
    w = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= k)


def rank_by_abs_corr(corr: DataFrame, target: str, segment: str = "segment") -> DataFrame:
    """O3: features ranked by |r| with the target, the target itself excluded (quirk Q8)."""
    t = corr.where((F.col("feature_b") == target) & (F.col("feature_a") != target))
    w = Window.partitionBy(segment).orderBy(F.desc(F.abs("r")), F.asc("feature_a"))
    return t.select(segment, F.col("feature_a").alias("feature"), "r", F.row_number().over(w).alias("rank"))


def best_by(df: DataFrame, metric: str, lower_is_better: bool, order_col: str = "ordinal",
            group=()) -> DataFrame:
    """Best row per group; the first (smallest ordinal) wins ties."""
    m = F.col(metric)
    w = Window.partitionBy(*group).orderBy(m.asc_nulls_last() if lower_is_better else m.desc_nulls_last(),
                                           F.col(order_col))
    return df.withColumn("is_best", F.row_number().over(w) == 1)


def base_rows(df: DataFrame, keys, segment: str | None = None) -> DataFrame:
    """The first row by key (per segment) as a base row: ``min_by`` over a struct, a
    partial aggregate that never gathers a segment's rows in one task."""
    keys = list(keys)
    cols = [c for c in df.columns if c != segment]
    order = F.struct(*[F.col(k) for k in keys])
    g = [segment] if segment else []
    rec = F.min_by(F.struct(*cols), order).alias("_r")
    out = df.groupBy(*g).agg(rec) if g else df.agg(rec)
    return out.select(*g, "_r.*")


def seeded_sample(df: DataFrame, key: Column, n: int, seed: int = 42) -> DataFrame:
    """A repeatable sample of at most n rows: the n smallest md5(seed || key).
    ``orderBy().limit()`` plans as a distributed top-k (TakeOrderedAndProject)."""
    h = F.md5(F.concat(F.lit(str(seed)), key.cast("string")))
    return df.withColumn("_h", h).orderBy("_h").limit(n).drop("_h")


def union_tagged(frames: dict, tag: str = "source") -> DataFrame:
    """P1 + O7: tag each table with its name and union by column name."""
    out = None
    for name, df in frames.items():
        t = df.withColumn(tag, F.lit(name))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def column_diff(spark: SparkSession, expected, actual) -> DataFrame:
    """Expected vs actual column names (schema only) as 'missing' / 'extra' rows."""
    e = spark.createDataFrame([(c,) for c in expected], "name string")
    a = spark.createDataFrame([(c,) for c in actual], "name string")
    return (e.exceptAll(a).withColumn("status", F.lit("missing"))
            .unionByName(a.exceptAll(e).withColumn("status", F.lit("extra"))))
