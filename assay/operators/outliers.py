"""Outlier rules applied per segment and for the union in one scan (F1-F3 over A18).

Each row is emitted under its segment label and under 'all'; bounds are fitted per
label (grouping by label = the reference's separate per-table fits) and joined back
through a size-checked broadcast, then the clip or filter is a column expression.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.operators._small import settled, small_enough
from assay.operators.profile import ALL, long_form, quantile_frame
from assay.operators.quantiles import interpolated, order_statistics
from assay.operators.stages import clip


def labelled_long(df: DataFrame, features, segment: str | None, ids=()) -> DataFrame:
    lf = long_form(df, features, ids=list(ids) + ([segment] if segment else []))
    labels = F.array(F.col(segment).cast("string"), F.lit(ALL)) if segment else F.array(F.lit(ALL))
    return lf.select(*ids, F.explode(labels).alias("segment"), "feature", "value")


def fitted_bounds(ul: DataFrame, method: str = "clip", factor: float = 1.5,
                  quantile_method: str = "exact") -> DataFrame:
    probs = [0.05, 0.95] if method == "winsorize" else [0.25, 0.75]
    q = quantile_frame(ul, ["segment", "feature"], probs, quantile_method)
    a, b = F.col("_q")[0], F.col("_q")[1]
    if method == "winsorize":
        return q.select("segment", "feature", a.alias("lo"), b.alias("hi"))
    return q.select("segment", "feature", (a - factor * (b - a)).alias("lo"), (b + factor * (b - a)).alias("hi"))


def clip_describe(df: DataFrame, features, segment: str | None, method: str = "clip",
                  factor: float = 1.5) -> DataFrame:
    """F1/F3 + A5 per label in few passes: one exact selection on the raw values gives the
    order statistics for the bounds *and* for the clipped quartiles (clipping is monotone,
    so clipped order statistics are the clipped raw ones); count/mean/std/min/max of the
    clipped values are one more aggregate with the bounds joined by size-checked broadcast."""
    ul = labelled_long(df, features, segment)
    fit_p = [0.05, 0.95] if method == "winsorize" else [0.25, 0.75]
    desc_p = [0.25, 0.5, 0.75]
    probs = sorted(set(fit_p + desc_p))
    keys = ["segment", "feature"]
    os_ = order_statistics(ul, keys, "value", probs)
    at = {p: F.col("_os")[i] for i, p in enumerate(probs)}
    a, b = interpolated(at[fit_p[0]]), interpolated(at[fit_p[1]])
    spread = F.lit(factor) * (b - a)
    fitted = os_.withColumn("lo", a if method == "winsorize" else a - spread) \
        .withColumn("hi", b if method == "winsorize" else b + spread)
    q = F.array(*[interpolated(at[p], lambda v: clip(v, F.col("lo"), F.col("hi"))) for p in desc_p])
    fitted = settled(fitted.select(*keys, "lo", "hi", q.alias("_q")))
    bounds = fitted.select(*keys, "lo", "hi")
    clipped = ul.join(F.broadcast(bounds) if small_enough(bounds) else bounds, keys, "left") \
        .select(*keys, clip(F.col("value"), F.col("lo"), F.col("hi")).alias("value"))
    agg = (clipped.groupBy(*keys)
           .agg(F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"),
                F.min("value").alias("min"), F.max("value").alias("max")))
    out = agg.join(fitted, keys, "left")
    return out.select(*keys, "count", "mean", "std", "min", F.col("_q")[0].alias("q25"),
                      F.col("_q")[1].alias("q50"), F.col("_q")[2].alias("q75"), "max")
