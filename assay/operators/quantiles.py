"""Exact order statistics and linear-interpolation quantiles by distributed selection
(pandas / DuckDB ``quantile_cont``).

Spark's exact ``percentile`` keeps every distinct value of a group in one aggregation
buffer, which does not survive a group holding a third of 100 TB.  Here the needed ranks of
all groups are narrowed together, one scan per level:

1. a histogram over magnitude buckets (a quarter of an octave each, the infinities and
   zero by themselves) gives count, min and max per (group, bucket); a window over each
   group's few buckets finds the one that holds each rank, and its min and max become the
   rank's interval;
2. each further level cuts the open intervals of all ranks into ``buckets`` equal parts
   and looks again at the rows inside them only.

A rank is settled when its interval is one value.  An interval's two ends never fall into
one part, so every level narrows; as a magnitude bucket spans less than 2^52 steps, about
``52 / log2(buckets)`` levels settle any data, whatever its size.  There is no size at which
the method changes, nothing but one count per level reaches the driver, and a window sees at
most one row per bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

from assay.operators._small import settled

BUCKETS = 4096
BROADCAST_RANKS = 100_000   # open ranks (three numbers and a key each) up to which their intervals are broadcast
INFINITE = 100_000      # magnitude bucket of an infinity


def magnitude_bucket(v: Column) -> Column:
    """Monotone bucket of any double: quarter octaves of its magnitude, signed."""
    size = F.floor(F.log2(F.abs(v)) * 4) + 5000
    return F.when(v == 0, 0).when(F.abs(v) == float("inf"), F.signum(v) * INFINITE) \
        .otherwise(F.signum(v) * size).cast("long")


def part_of(v: Column, lo: Column, hi: Column, buckets: int) -> Column:
    """Which of ``buckets`` equal parts of [lo, hi] holds v; the ends are in the first and
    the last.  Halved first, so that the width of a finite interval is finite."""
    share = (v / 2 - lo / 2) / (hi / 2 - lo / 2)
    return F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("long")


def select_ranks(data: DataFrame, keys: list[str], ranks: DataFrame, first: Column, part, buckets: int = BUCKETS) -> DataFrame:
    """``(keys..., r, x)``: the r-th smallest ``_v`` (from 0) of each group.

    ``data`` has the keys and ``_v``; ``ranks`` the keys and ``r`` (0 <= r < group size);
    ``first`` buckets a value monotonically on the first level, ``part(v, lo, hi, buckets)``
    inside an interval."""
    hist = data.groupBy(*keys, first.alias("_b"))
    open_ = ranks.distinct().withColumn("_at", F.lit(0).cast("long")).withColumn("_left", F.col("r").cast("long"))
    done = None
    while True:
        hist = hist.agg(F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
        if "_at" not in hist.columns:
            hist = hist.withColumn("_at", F.lit(0).cast("long"))
        before = Window.partitionBy(*keys, "_at").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
        hist = hist.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
        hit = open_.join(hist, [*keys, "_at"]).where("_left >= _before and _left < _before + _n")
        # An interval is named by the smallest of the ranks it holds: unique in its group.
        name = F.min("r").over(Window.partitionBy(*keys, "_at", "_b"))
        hit = settled(hit.select(*keys, "r", name.cast("long").alias("_to"), "_lo", "_hi",
                                 (F.col("_left") - F.col("_before")).alias("_left")).withColumnRenamed("_to", "_at"))
        found = hit.where("_lo = _hi").select(*keys, "r", F.col("_lo").alias("x"))
        done = found if done is None else done.unionByName(found)
        open_ = hit.where("_lo < _hi")
        n = open_.count()
        if n == 0:
            return done
        # A group's intervals are disjoint: a row meets one of them at most.
        cells = open_.select(*[F.col(k).alias(f"_c{i}") for i, k in enumerate(keys)], "_at", "_lo", "_hi").distinct()
        meets = (F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))
        for i, k in enumerate(keys):
            meets = meets & (F.col(k) == F.col(f"_c{i}"))
        rows = data.join(F.broadcast(cells) if n <= BROADCAST_RANKS else cells, meets)
        hist = rows.groupBy(*keys, "_at", part(F.col("_v"), F.col("_lo"), F.col("_hi"), buckets).alias("_b"))
        open_ = open_.select(*keys, "r", "_at", "_left")


def order_statistics(lf: DataFrame, keys, value: str, probs, buckets: int = BUCKETS) -> DataFrame:
    """``(keys..., _os)``: per prob a struct (p, share, low, high), the two order statistics
    around the interpolation position and how far it lies between them.  A monotone transform
    of the data (a clip) maps them to the transformed data's, so one selection serves both.
    Nulls and NaN do not count; groups without values are absent."""
    keys = list(keys)
    v = F.col(value).cast("double")
    kn = [f"_g{i}" for i in range(len(keys) or 1)]
    # Joins drop null keys, so each key travels as a string that tells null from a value.
    told = [F.coalesce(F.concat(F.lit("="), F.col(k).cast("string")), F.lit("")).alias(n) for k, n in zip(keys, kn)] \
        or [F.lit("").alias(kn[0])]
    data = lf.where(v.isNotNull() & ~F.isnan(v)).select(*told, F.when(v == 0, F.lit(0.0)).otherwise(v).alias("_v"))
    size = settled(lf.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
                   .select(*told, *keys, "_n").where("_n > 0"))
    at = [F.lit(float(p)) * (F.col("_n") - 1) for p in probs]
    wanted = size.select(*kn, F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"), (q - F.floor(q)).alias("share"), F.floor(q).alias("a"),
                 F.least(F.floor(q) + 1, F.col("_n") - 1).alias("b")) for i, (p, q) in enumerate(zip(probs, at))])).alias("t")) \
        .select(*kn, "t.*")
    ranks = wanted.select(*kn, F.explode(F.array(F.col("a").cast("long"), F.col("b").cast("long"))).alias("r"))
    got = settled(select_ranks(data, kn, ranks, magnitude_bucket(F.col("_v")), part_of, buckets))
    both = wanted.join(got.withColumnRenamed("r", "a").withColumnRenamed("x", "low"), [*kn, "a"]) \
        .join(got.withColumnRenamed("r", "b").withColumnRenamed("x", "high"), [*kn, "b"])
    out = both.groupBy(*kn).agg(F.sort_array(F.collect_list(F.struct("i", "p", "share", "low", "high"))).alias("_os"))
    return size.join(out, kn).select(*keys, "_os")


def interpolated(stat: Column, change=lambda v: v) -> Column:
    """The quantile of one entry of ``_os``, of values changed by a monotone function."""
    low, high = change(stat["low"]), change(stat["high"])
    return F.when((low == high) | (stat["share"] == 0), low).otherwise(low + stat["share"] * (high - low))


def exact_quantiles(lf: DataFrame, keys, value: str, probs, buckets: int = BUCKETS) -> DataFrame:
    """(keys..., _q array<double>) with one entry per prob; groups without values are absent."""
    out = order_statistics(lf, keys, value, probs, buckets)
    return out.select(*list(keys), F.transform("_os", lambda s: interpolated(s)).alias("_q"))
