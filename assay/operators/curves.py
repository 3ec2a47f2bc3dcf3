"""Window operators over per-feature curves.

A curve is (group..., grid_ix, x, y[, p]) with ~50 points per group, so every window
below is partitioned by the curve's group: bounded, tiny partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def gradient(curve: DataFrame, group, x: str = "x", y: str = "y", out: str = "rate") -> DataFrame:
    """Numeric gradient dy/dx along grid_ix: second-order central differences for
    uneven spacing inside, one-sided differences at both ends (NumPy ``gradient``)."""
    w = Window.partitionBy(*group).orderBy("grid_ix")
    x0, x2 = F.lag(x).over(w), F.lead(x).over(w)
    y0, y2 = F.lag(y).over(w), F.lead(y).over(w)
    dx1, dx2 = F.col(x) - x0, x2 - F.col(x)
    a = -dx2 / (dx1 * (dx1 + dx2))
    b = (dx2 - dx1) / (dx1 * dx2)
    c = dx1 / (dx2 * (dx1 + dx2))
    inner = a * y0 + b * F.col(y) + c * y2
    first = (y2 - F.col(y)) / dx2
    last = (F.col(y) - y0) / dx1
    g = F.when(x0.isNull(), first).when(x2.isNull(), last).otherwise(inner)
    return curve.withColumn(out, g)


def peaks(curve: DataFrame, group, rate: str = "rate", out: str = "is_peak") -> DataFrame:
    """|rate| above twice the curve's mean |rate| and strictly above both neighbours;
    the two ends never count."""
    w = Window.partitionBy(*group).orderBy("grid_ix")
    wall = Window.partitionBy(*group)
    r = F.abs(F.col(rate))
    prev, nxt = F.lag(r).over(w), F.lead(r).over(w)
    cond = prev.isNotNull() & nxt.isNotNull() & (r > 2 * F.avg(r).over(wall)) & (r > prev) & (r > nxt)
    return curve.withColumn(out, F.coalesce(cond, F.lit(False)))


def crossings(curve: DataFrame, group, p: str = "p", level: float = 0.5, out: str = "is_crossing") -> DataFrame:
    """The later point of each crossing of ``level`` in either direction."""
    w = Window.partitionBy(*group).orderBy("grid_ix")
    prev = F.lag(p).over(w)
    cond = prev.isNotNull() & ((prev < level) != (F.col(p) < level))
    return curve.withColumn(out, F.coalesce(cond, F.lit(False)))


def thresholds(curve: DataFrame, group, x: str = "x", y: str = "y", p: str = "p") -> DataFrame:
    """Per curve, the x values at gradient peaks and at probability crossings, in grid order."""
    c = peaks(gradient(curve, group, x, y), group)
    c = crossings(c, group, p)
    pick = lambda flag: F.transform(
        F.array_sort(F.collect_list(F.when(F.col(flag), F.struct("grid_ix", F.col(x).alias("v"))))),
        lambda s: s["v"])
    return c.groupBy(*group).agg(pick("is_peak").alias("detected_thresholds"),
                                 pick("is_crossing").alias("binary_thresholds"))


def nearest(candidates, domain):
    """The candidate nearest to the domain value (first in list order on ties)."""
    scored = F.transform(candidates, lambda t, i: F.struct(F.abs(t - domain).alias("d"), i.alias("i"), t.alias("t")))
    return F.when(domain.isNull() | (F.size(candidates) == 0), F.lit(None).cast("double")) \
            .otherwise(F.array_min(scored)["t"])
