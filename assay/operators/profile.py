"""Profiling aggregates.

Every statistic is one declarative aggregate.  Per-feature statistics are computed
on a long form (``segment, feature, value``) so that one ``groupBy`` handles any
number of columns with map-side partial aggregation; the shuffle carries one
partial buffer per (task, segment, feature), never rows.

A18 (same statistic per segment and for the union) is a grouping set
``((segment, feature), (feature))``: the table is scanned once and the union row is
labelled ``'all'``.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from assay.operators._small import attach, settled, small_enough

ALL = "all"


# --------------------------------------------------------------------------- helpers

def clean(c: Column) -> Column:
    """NaN counts as missing, as in pandas."""
    c = c.cast("double")
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def long_form(df: DataFrame, features, ids=(), value: str = "value",
              name: str = "feature") -> DataFrame:
    """Unpivot ``features`` into (ids..., feature, value double)."""
    cols = [F.col(i) for i in ids]
    pairs = F.array(*[F.struct(F.lit(f).alias(name), clean(F.col(f)).alias(value))
                      for f in features])
    return (df.select(*cols, F.inline(pairs)))


def grouped_agg(df: DataFrame, segment: str | None, keys, aggs, label: str = "segment") -> DataFrame:
    """Aggregate by ``keys`` per segment and for all rows (grouping sets, A18)."""
    keys = list(keys)
    if segment is None:
        return df.groupBy(*keys).agg(*aggs)
    out = (df.groupingSets([[segment, *keys], keys], segment, *keys)
           .agg(F.grouping(segment).alias("_g"), *aggs))
    seg = F.when(F.col("_g") == 1, F.lit(ALL)).otherwise(F.col(segment).cast("string"))
    rest = [c for c in out.columns if c not in (segment, "_g")]
    return out.select(seg.alias(label), *rest)


def _seg_ids(segment):
    return [segment] if segment else []


def percentile_expr(c: Column, p, method: str = "percentile", accuracy: int = 10000) -> Column:
    """In-aggregate quantile: ``percentile`` (Spark's exact buffer of a group's distinct
    values) or ``approx`` (Greenwald-Khanna sketch).  The default ``exact`` method of
    the operators below is ``quantile_frame``, a bounded-memory selection."""
    if method == "approx":
        return F.percentile_approx(c, p, accuracy)
    return F.percentile(c, p)


def quantile_frame(lf: DataFrame, keys, probs, method: str = "exact", value: str = "value") -> DataFrame:
    """(keys..., _q array<double>): linear-interpolation quantiles per group.
    ``exact``: distributed selection (operators/quantiles.py), exact and bounded;
    ``percentile`` / ``approx``: one aggregate with Spark's functions."""
    keys = list(keys)
    if method == "exact":
        from assay.operators.quantiles import exact_quantiles
        return exact_quantiles(lf, keys, value, list(probs))
    return lf.groupBy(*keys).agg(percentile_expr(F.col(value), list(probs), method).alias("_q"))


def seg_quantiles(df: DataFrame, features, segment: str | None, probs, method: str = "exact") -> DataFrame:
    """Quantiles per (segment, feature) and for 'all' (or per feature without a segment)."""
    if segment is None:
        return quantile_frame(long_form(df, features), ["feature"], probs, method)
    return quantile_frame(_union_long(df, features, segment), ["segment", "feature"], probs, method)


def _with_q(out: DataFrame, q: DataFrame, keys) -> DataFrame:
    """Attach the (small) quantile frame to the (small) per-group aggregate."""
    return out.join(q, list(keys), "left")


# --------------------------------------------------------------------------- A1-A4

def counts(df: DataFrame) -> DataFrame:
    """A1: row count and column count."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(df.columns)).alias("n_cols"))


def null_counts(df: DataFrame, columns=None) -> DataFrame:
    """A2: null (or NaN) count per column, one pass, long output."""
    columns = list(columns or df.columns)
    numeric = {f.name for f in df.schema.fields
               if f.dataType.typeName() in ("double", "float")}

    def missing(c):
        m = F.col(c).isNull()
        return m | F.isnan(F.col(c)) if c in numeric else m
    wide = df.agg(*[F.sum(missing(c).cast("long")).alias(c) for c in columns])
    return long_form_exact(wide, columns, "column", "n_null")


def long_form_exact(df: DataFrame, columns, name: str, value: str) -> DataFrame:
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("long").alias(value))
                      for c in columns])
    return df.select(F.inline(pairs))


def duplicate_count(df: DataFrame, columns=None) -> DataFrame:
    """A3: rows that repeat an earlier row (nulls compare equal), as pandas ``duplicated``."""
    columns = list(columns or df.columns)
    return (df.groupBy(*columns).count()
            .agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).cast("long").alias("n_duplicates")))


def frequency(df: DataFrame, column: str, segment: str | None = None) -> DataFrame:
    """A4: ordered frequency table (per segment and overall with ``segment``)."""
    out = grouped_agg(df, segment, [column], [F.count(F.lit(1)).alias("n")])
    order = (["segment"] if segment else []) + [column]
    return out.orderBy(*order)


# --------------------------------------------------------------------------- A5-A8

def describe(df: DataFrame, features, segment: str | None = None,
             method: str = "exact") -> DataFrame:
    """A5: count, mean, sample std, min, quartiles, max per feature (and segment)."""
    lf = long_form(df, features, ids=_seg_ids(segment))
    v = F.col("value")
    out = grouped_agg(lf, segment, ["feature"], [
        F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.min(v).alias("min"), F.max(v).alias("max")])
    keys = ["segment", "feature"] if segment else ["feature"]
    out = _with_q(out, seg_quantiles(df, features, segment, [0.25, 0.5, 0.75], method), keys)
    return (out.withColumn("q25", F.col("_q")[0]).withColumn("q50", F.col("_q")[1])
            .withColumn("q75", F.col("_q")[2]).drop("_q"))


def quantiles(df: DataFrame, features, probs=(0.05, 0.25, 0.75, 0.95),
              segment: str | None = None, method: str = "exact") -> DataFrame:
    """Quantiles by linear interpolation, one row per (segment, feature)."""
    out = seg_quantiles(df, features, segment, list(probs), method)
    return out.select(*[c for c in out.columns if c != "_q"],
                      *[F.col("_q")[i].alias(_qname(p)) for i, p in enumerate(probs)])


def _qname(p: float) -> str:
    return "q" + f"{p * 100:g}".replace(".", "_")


def skew_expr(v: Column) -> Column:
    """Bias-corrected sample skewness (pandas ``skew``): G1 = g1 * sqrt(n(n-1)) / (n-2)."""
    n = F.count(v).cast("double")
    return F.try_divide(F.skewness(v) * F.sqrt(n * (n - 1)), n - 2)


def skewness(df: DataFrame, features, segment: str | None = None) -> DataFrame:
    """A7."""
    lf = long_form(df, features, ids=_seg_ids(segment))
    return grouped_agg(lf, segment, ["feature"], [skew_expr(F.col("value")).alias("skew")])


def min_max(df: DataFrame, features, segment: str | None = None) -> DataFrame:
    """A8."""
    lf = long_form(df, features, ids=_seg_ids(segment))
    v = F.col("value")
    return grouped_agg(lf, segment, ["feature"], [F.min(v).alias("min"), F.max(v).alias("max")])


# --------------------------------------------------------------------------- A9-A11

def pivot_counts(df: DataFrame, row: str, column: str, values) -> DataFrame:
    """Count by (row, column) with one output column per listed value (0 when absent)."""
    values = list(values)
    out = df.groupBy(row).pivot(column, values).count()
    return out.select(row, *[F.coalesce(F.col(str(v)), F.lit(0)).cast("long").alias(str(v))
                             for v in values])


def feature_stats(df: DataFrame, features, segment: str | None = None,
                  method: str = "exact") -> DataFrame:
    """n, min, max, quartiles and sample std per (segment, feature): shared by A10/A14."""
    lf = long_form(df, features, ids=_seg_ids(segment))
    v = F.col("value")
    out = grouped_agg(lf, segment, ["feature"], [
        F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"),
        F.stddev_samp(v).alias("std")])
    keys = ["segment", "feature"] if segment else ["feature"]
    out = _with_q(out, seg_quantiles(df, features, segment, [0.25, 0.75], method), keys)
    return (out.withColumn("q25", F.col("_q")[0]).withColumn("q75", F.col("_q")[1]).drop("_q"))


def _union_long(df: DataFrame, features, segment: str | None) -> DataFrame:
    """Long form where every row appears under its segment and under 'all'."""
    lf = long_form(df, features, ids=_seg_ids(segment))
    if segment is None:
        return lf.withColumn("segment", F.lit(ALL))
    return lf.select(F.explode(F.array(F.col(segment).cast("string"), F.lit(ALL))).alias("segment"),
                     "feature", "value")


def histogram(df: DataFrame, features, segment: str | None = None) -> DataFrame:
    """A10: density histogram with the 'auto' bin rule (min of Sturges and Freedman-Diaconis widths).

    Bins are equal-width over [min, max]; index = floor((x - min) * k / range), the
    maximum falls into the last bin; density = count / (n * width).
    """
    st = feature_stats(df, features, segment)
    rng = F.col("max") - F.col("min")
    sturges = rng / (F.log2(F.col("n")) + 1)
    fd = 2 * (F.col("q75") - F.col("q25")) * F.pow(F.col("n"), -1.0 / 3)
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    k = F.when(rng > 0, F.ceil(rng / width)).otherwise(F.lit(1)).cast("long")
    st = st.select("segment", "feature", "n", "min", k.alias("k"), rng.alias("rng"),
                   F.when(rng > 0, rng / k).otherwise(F.lit(1.0)).alias("w"))
    lf = _union_long(df, features, segment).where(F.col("value").isNotNull())
    j = attach(lf, st, ["segment", "feature"])
    idx = F.when(F.col("rng") > 0, F.least(F.floor((F.col("value") - F.col("min")) * F.col("k")
                                                    / F.col("rng")), F.col("k") - 1)).otherwise(0)
    return (j.groupBy("segment", "feature", idx.cast("long").alias("bin"))
            .agg(F.count(F.lit(1)).alias("count"), F.first("n").alias("n"),
                 F.first("min").alias("min"), F.first("w").alias("w"))
            .select("segment", "feature", "bin",
                    (F.col("min") + F.col("bin") * F.col("w")).alias("lo"),
                    (F.col("min") + (F.col("bin") + 1) * F.col("w")).alias("hi"),
                    "count", (F.col("count") / (F.col("n") * F.col("w"))).alias("density")))


#: Hermite terms of the Gauss transform: 1.09 * sum over n >= 20 of 0.5^n / sqrt(n!) < 1e-15 per row.
GAUSS_TERMS = 20
#: Bandwidths beyond which a box adds less than exp(-45) per row.
GAUSS_REACH = 10.0


def kde(df: DataFrame, features, segment: str | None = None, gridsize: int = 200,
        cut: float = 3.0) -> DataFrame:
    """Gaussian kernel density on a grid, Scott bandwidth h = std * n^(-1/5).

    Grid spans [min - cut*h, max + cut*h] in ``gridsize`` points.  A fast Gauss transform
    (Greengard & Strain 1991): rows fall into boxes at most one bandwidth wide, and one
    partial aggregate keeps the first ``GAUSS_TERMS`` powers of their places in the box.
    The width is the smaller one of the segment's and the union's bandwidths, so the same
    moments serve both curves and every row counts once.  Grid values are Hermite sums over
    the boxes within reach, at most 1e-15 a row from the kernels themselves.  Groups without
    spread (or with one value) have no density and give no rows.
    """
    keys = ["segment", "feature"]
    v = F.col("value")
    st = grouped_agg(long_form(df, features, ids=_seg_ids(segment)), segment, ["feature"], [
        F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.stddev_samp(v).alias("std")])
    st = st if segment else st.withColumn("segment", F.lit(ALL))
    h = F.col("std") * F.pow(F.col("n"), -0.2)
    st = settled(st.select(*keys, "n", "min", h.alias("h"), (F.col("min") - cut * h).alias("g0"),
                           ((F.col("max") - F.col("min") + 2 * cut * h) / (gridsize - 1)).alias("gs")))
    spread = st.where(F.col("h") > 0)
    union = st.where(F.col("segment") == ALL).select("feature", F.col("h").alias("h_all"), F.col("min").alias("base"))
    seg = st.where(F.col("segment") != ALL).select(F.col("segment").alias("_seg"), "feature", F.col("h").alias("h_seg"))
    lf = long_form(df, features, ids=_seg_ids(segment)).where(F.col("value").isNotNull())
    lf = lf.select((F.col(segment).cast("string") if segment else F.lit(None).cast("string")).alias("_seg"), "feature", "value")
    lf = attach(lf, union, ["feature"])
    lf = attach(lf, seg, ["_seg", "feature"], "left") if segment else lf.withColumn("h_seg", F.lit(None).cast("double"))
    width = F.least(F.when(F.col("h_all") > 0, F.col("h_all")), F.when(F.col("h_seg") > 0, F.col("h_seg")))
    at = (F.col("value") - F.col("base")) / F.col("w")
    placed = lf.withColumn("w", width).where(F.col("w") > 0).withColumn("box", F.floor(at)) \
        .select("_seg", "feature", "box", "w", "base", (at - F.col("box") - 0.5).alias("u"))
    moments = placed.groupBy("_seg", "feature", "box", "w", "base").agg(
        F.count(F.lit(1)).cast("double").alias("m0"), *[F.sum(F.pow("u", F.lit(float(i)))).alias(f"m{i}") for i in range(1, GAUSS_TERMS)])
    moments = moments.select("_seg", "feature", "w", (F.col("base") + (F.col("box") + 0.5) * F.col("w")).alias("c"),
                             F.array(*[F.col(f"m{i}") for i in range(GAUSS_TERMS)]).alias("m"))
    target = F.explode(F.array_distinct(F.array(F.coalesce("_seg", F.lit(ALL)), F.lit(ALL)))).alias("segment")
    boxes = attach(moments.select(target, "feature", "w", "c", "m"), spread, keys)
    lo = F.ceil((F.col("c") - GAUSS_REACH * F.col("h") - F.col("g0")) / F.col("gs"))
    hi = F.floor((F.col("c") + GAUSS_REACH * F.col("h") - F.col("g0")) / F.col("gs"))
    lo, hi = F.greatest(lo, F.lit(0)).cast("int"), F.least(hi, F.lit(gridsize - 1)).cast("int")
    near = boxes.where(lo <= hi).select(*keys, "m", "h", "w", "c", "g0", "gs", F.explode(F.sequence(lo, hi)).alias("grid_ix"))
    delta = F.col("h") * math.sqrt(2.0)
    near = near.select(*keys, "grid_ix", "m", (F.col("w") / delta).alias("r"),
                       ((F.col("g0") + F.col("grid_ix") * F.col("gs") - F.col("c")) / delta).alias("t"))
    # H(n+1) = 2 t H(n) - 2 n H(n-1); ``f`` is r^n / n!
    start = F.struct(F.exp(-F.col("t") * F.col("t")).alias("now"), F.lit(0.0).alias("before"), F.lit(1.0).alias("f"),
                     F.lit(0.0).alias("s"), F.lit(0.0).alias("i"))

    def term(a, m):
        return F.struct((2 * F.col("t") * a["now"] - 2 * a["i"] * a["before"]).alias("now"), a["now"].alias("before"),
                        (a["f"] * F.col("r") / (a["i"] + 1)).alias("f"), (a["s"] + a["f"] * m * a["now"]).alias("s"),
                        (a["i"] + 1).alias("i"))

    sums = near.select(*keys, "grid_ix", F.aggregate("m", start, term, lambda a: a["s"]).alias("s")) \
        .groupBy(*keys, "grid_ix").agg(F.sum("s").alias("s"))
    grid = spread.select("*", F.explode(F.sequence(F.lit(0), F.lit(gridsize - 1))).alias("grid_ix"))
    # Far from every row the sum is zero; a truncated one may fall below it.
    total = F.greatest(F.coalesce("s", F.lit(0.0)), F.lit(0.0))
    return grid.join(sums, [*keys, "grid_ix"], "left").select(
        *keys, "grid_ix", (F.col("g0") + F.col("grid_ix") * F.col("gs")).alias("x"),
        (total / (F.col("n") * F.col("h") * math.sqrt(2 * math.pi))).alias("density"))


# --------------------------------------------------------------------------- A12-A17

def correlation(df: DataFrame, features, segment: str | None = None) -> DataFrame:
    """Pearson correlation of every feature pair, all pairs in one aggregate."""
    features = list(features)
    aggs, pairs = [], []
    for i, a in enumerate(features):
        for b in features[i:]:
            nm = f"c{len(pairs)}"
            aggs.append(F.corr(clean(F.col(a)), clean(F.col(b))).alias(nm))
            pairs.append((a, b, nm))
    wide = grouped_agg(df, segment, [], aggs) if segment else df.agg(*aggs).withColumn("segment", F.lit(ALL))
    cells = []
    for a, b, nm in pairs:
        cells.append(F.struct(F.lit(a).alias("feature_a"), F.lit(b).alias("feature_b"), F.col(nm).alias("r")))
        if a != b:
            cells.append(F.struct(F.lit(b).alias("feature_a"), F.lit(a).alias("feature_b"), F.col(nm).alias("r")))
    return wide.select("segment", F.inline(F.array(*cells)))


def trend(df: DataFrame, features, target: str, segment: str | None = None) -> DataFrame:
    """Least-squares line of ``target`` on each feature."""
    lf = long_form(df, features, ids=_seg_ids(segment) + [target])
    y, x = F.col(target).cast("double"), F.col("value")
    return grouped_agg(lf, segment, ["feature"], [
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n")])


def box_stats(df: DataFrame, features, by, method: str = "exact") -> DataFrame:
    """Box statistics per group: quartiles, whiskers at 1.5 IQR clipped to the data,
    outlier count.  Quartiles are one grouped aggregate; whiskers a second pass over
    rows joined to the (size-checked) quartile table."""
    by = [by] if isinstance(by, str) else list(by)
    lf = long_form(df, features, ids=by).where(F.col("value").isNotNull())
    q = (quantile_frame(lf, [*by, "feature"], [0.25, 0.5, 0.75], method)
         .select(*by, "feature", F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("median"),
                 F.col("_q")[2].alias("q3")))
    q = q.withColumn("lo_fence", F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * (F.col("q3") - F.col("q1")))
    j = attach(lf, q, [*by, "feature"])
    v = F.col("value")
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    return (j.groupBy(*by, "feature")
            .agg(F.first("q1").alias("q1"), F.first("median").alias("median"), F.first("q3").alias("q3"),
                 F.min(F.when(inside, v)).alias("whisker_lo"), F.max(F.when(inside, v)).alias("whisker_hi"),
                 F.count_if(~inside).cast("long").alias("n_outliers"), F.count(v).alias("n")))


def pair_bins(df: DataFrame, fx: str, fy: str, cls: str, bins: int = 10) -> DataFrame:
    """2-D equal-width binned counts of a feature pair per class (bounded output).

    The four range ends are fitted state (one row); they are inlined as literals.
    """
    r = df.agg(F.min(fx).alias("x0"), F.max(fx).alias("x1"),
               F.min(fy).alias("y0"), F.max(fy).alias("y1")).first()

    def b(c, lo, hi):
        if lo is None or hi is None or hi <= lo:
            return F.lit(0)
        return F.least(F.floor((F.col(c).cast("double") - F.lit(lo)) * bins / F.lit(hi - lo)),
                       F.lit(bins - 1))
    return (df.where(F.col(fx).isNotNull() & F.col(fy).isNotNull())
            .groupBy(F.col(cls), b(fx, r["x0"], r["x1"]).cast("int").alias("bin_x"),
                     b(fy, r["y0"], r["y1"]).cast("int").alias("bin_y"))
            .agg(F.count(F.lit(1)).alias("n")))


def all_pair_bins(df: DataFrame, features, cls: str, bins: int = 10) -> DataFrame:
    """A15 for every pair of ``features``: one pass for the ranges, one for the counts (a row
    gives one cell per pair with both values, counted before the shuffle)."""
    features = sorted(features)
    ends = df.agg(*[f(c).alias(f"{c}_{n}") for c in features for f, n in ((F.min, "lo"), (F.max, "hi"))]).first()

    def bin_of(c):
        lo, hi = ends[f"{c}_lo"], ends[f"{c}_hi"]
        if lo is None or hi <= lo:
            return F.when(F.col(c).isNotNull(), F.lit(0))
        return F.least(F.floor((F.col(c).cast("double") - F.lit(lo)) * bins / F.lit(hi - lo)), F.lit(bins - 1)).cast("int")

    cells = [F.struct(F.lit(a).alias("feature_x"), F.lit(b).alias("feature_y"), bin_of(a).alias("bin_x"), bin_of(b).alias("bin_y"))
             for i, a in enumerate(features) for b in features[i + 1:]]
    return df.select(F.col(cls), F.inline(F.array(*cells))).where("bin_x is not null and bin_y is not null") \
        .groupBy("feature_x", "feature_y", cls, "bin_x", "bin_y").agg(F.count(F.lit(1)).alias("n"))


def mean_abs(df: DataFrame, columns, segment: str | None = None) -> DataFrame:
    """Mean absolute value per column."""
    lf = long_form(df, columns, ids=_seg_ids(segment))
    return grouped_agg(lf, segment, ["feature"], [F.avg(F.abs(F.col("value"))).alias("mean_abs")])


def distinct_classes(df: DataFrame, label: str, segment: str | None = None,
                     min_classes: int = 2) -> DataFrame:
    """Distinct class count and a too-few-classes flag."""
    out = grouped_agg(df, segment, [], [F.countDistinct(label).alias("n_classes")]) if segment \
        else df.agg(F.countDistinct(label).alias("n_classes")).withColumn("segment", F.lit(ALL))
    return out.select("segment", "n_classes", (F.col("n_classes") < min_classes).alias("too_few"))


def percent_of_segment(df: DataFrame, segment: str, column: str) -> DataFrame:
    """Count by (segment, value) as a percent of the segment total."""
    c = df.groupBy(segment, column).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(segment)
    return c.withColumn("pct", F.col("n") * 100.0 / F.sum("n").over(w))
