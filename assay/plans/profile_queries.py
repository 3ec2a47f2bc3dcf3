"""Profiling queries (A1-A18, W1) on binding B1 (lineitem) with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.operators import profile as P
from assay.plans.bindings import B1, M_SQL, measurements
from assay.plans.catalog import query, rounded, seg_label, sql_long

FEATS = list(B1.features)
SEG = B1.segment
LONG = f"WITH {M_SQL},\nlf AS ({sql_long('m', FEATS, ids=[SEG])})\n"
R6 = "ROUND({x}, 6) AS {a}"


def r6(x, a=None):
    return R6.format(x=x, a=a or x)


def _m(spark, sf):
    return measurements(spark, sf)


@query("a1_counts", f"WITH {M_SQL} SELECT COUNT(*) AS n_rows, 10 AS n_cols FROM m")
def a1_counts(spark, sf):
    return P.counts(_m(spark, sf))


# Nulls are made with nullif on both sides: the driver tables hold none.
_NULLED = """nl AS (SELECT l_orderkey, l_returnflag, NULLIF(l_discount, 0.0) AS l_discount,
       NULLIF(l_tax, 0.0) AS l_tax, CASE WHEN score = 0 THEN NULL ELSE score END AS score FROM m)"""


def _nulled(spark, sf):
    m = _m(spark, sf)
    return m.select("l_orderkey", "l_returnflag", F.nullif("l_discount", F.lit(0.0)).alias("l_discount"),
                    F.nullif("l_tax", F.lit(0.0)).alias("l_tax"),
                    F.when(F.col("score") != 0, F.col("score")).alias("score"))


@query("a2_null_counts", f"""WITH {M_SQL}, {_NULLED}
SELECT 'l_orderkey' AS "column", CAST(COUNT(*) - COUNT(l_orderkey) AS BIGINT) AS n_null FROM nl
UNION ALL SELECT 'l_returnflag', CAST(COUNT(*) - COUNT(l_returnflag) AS BIGINT) FROM nl
UNION ALL SELECT 'l_discount', CAST(SUM(CASE WHEN l_discount IS NULL OR isnan(l_discount) THEN 1 ELSE 0 END) AS BIGINT) FROM nl
UNION ALL SELECT 'l_tax', CAST(SUM(CASE WHEN l_tax IS NULL OR isnan(l_tax) THEN 1 ELSE 0 END) AS BIGINT) FROM nl
UNION ALL SELECT 'score', CAST(COUNT(*) - COUNT(score) AS BIGINT) FROM nl""")
def a2_null_counts(spark, sf):
    return P.null_counts(_nulled(spark, sf))


@query("a3_duplicates", f"""WITH {M_SQL}
SELECT CAST(COUNT(*) - (SELECT COUNT(*) FROM (SELECT DISTINCT l_returnflag, l_discount, l_tax, score FROM m)) AS BIGINT)
  AS n_duplicates FROM m""")
def a3_duplicates(spark, sf):
    return P.duplicate_count(_m(spark, sf), ["l_returnflag", "l_discount", "l_tax", "score"])


@query("a4_frequency", f"""WITH {M_SQL}
SELECT {seg_label(SEG)}, score, COUNT(*) AS n FROM m GROUP BY GROUPING SETS (({SEG}, score), (score))""")
def a4_frequency(spark, sf):
    return P.frequency(_m(spark, sf), "score", SEG)


@query("a5_describe", LONG + f"""SELECT {seg_label(SEG)}, feature, COUNT(value) AS count,
  {r6('AVG(value)', 'mean')}, {r6('STDDEV_SAMP(value)', 'std')}, {r6('MIN(value)', 'min')},
  {r6('MAX(value)', 'max')}, {r6('QUANTILE_CONT(value, 0.25)', 'q25')},
  {r6('QUANTILE_CONT(value, 0.5)', 'q50')}, {r6('QUANTILE_CONT(value, 0.75)', 'q75')}
FROM lf GROUP BY GROUPING SETS (({SEG}, feature), (feature))""")
def a5_describe(spark, sf):
    return rounded(P.describe(_m(spark, sf), FEATS, SEG))


@query("a6_quantiles", LONG + f"""SELECT {seg_label(SEG)}, feature,
  {r6('QUANTILE_CONT(value, 0.05)', 'q5')}, {r6('QUANTILE_CONT(value, 0.25)', 'q25')},
  {r6('QUANTILE_CONT(value, 0.75)', 'q75')}, {r6('QUANTILE_CONT(value, 0.95)', 'q95')}
FROM lf GROUP BY GROUPING SETS (({SEG}, feature), (feature))""")
def a6_quantiles(spark, sf):
    return rounded(P.quantiles(_m(spark, sf), FEATS, segment=SEG))


@query("a7_skewness", LONG + f"""SELECT {seg_label(SEG)}, feature, {r6('SKEWNESS(value)', 'skew')}
FROM lf GROUP BY GROUPING SETS (({SEG}, feature), (feature))""")
def a7_skewness(spark, sf):
    return rounded(P.skewness(_m(spark, sf), FEATS, SEG))


@query("a8_min_max", LONG + f"""SELECT {seg_label(SEG)}, feature, MIN(value) AS min, MAX(value) AS max
FROM lf GROUP BY GROUPING SETS (({SEG}, feature), (feature))""")
def a8_min_max(spark, sf):
    return P.min_max(_m(spark, sf), FEATS, SEG)


@query("a9_pivot_counts", f"""WITH {M_SQL}
SELECT score, COUNT(*) FILTER (WHERE l_returnflag = 'A') AS "A",
  COUNT(*) FILTER (WHERE l_returnflag = 'N') AS "N", COUNT(*) FILTER (WHERE l_returnflag = 'R') AS "R"
FROM m GROUP BY score""")
def a9_pivot_counts(spark, sf):
    return P.pivot_counts(_m(spark, sf), "score", SEG, ["A", "N", "R"])


_STATS = f"""st AS (SELECT {seg_label(SEG)}, feature, COUNT(value) AS n, MIN(value) AS mn, MAX(value) AS mx,
  STDDEV_SAMP(value) AS sd, QUANTILE_CONT(value, 0.25) AS q25, QUANTILE_CONT(value, 0.75) AS q75
  FROM lf GROUP BY GROUPING SETS (({SEG}, feature), (feature))),
ul AS (SELECT CAST({SEG} AS VARCHAR) AS segment, feature, value FROM lf WHERE value IS NOT NULL
  UNION ALL SELECT 'all', feature, value FROM lf WHERE value IS NOT NULL)"""

_HIST = LONG.rstrip() + ",\n" + _STATS + """,
bw AS (SELECT segment, feature, n, mn, mx - mn AS rng,
  CASE WHEN 2 * (q75 - q25) * POW(n, -1.0 / 3) > 0
       THEN LEAST(2 * (q75 - q25) * POW(n, -1.0 / 3), (mx - mn) / (LOG2(n) + 1))
       ELSE (mx - mn) / (LOG2(n) + 1) END AS width FROM st),
kk AS (SELECT segment, feature, n, mn, rng,
  CASE WHEN rng > 0 THEN CAST(CEIL(rng / width) AS BIGINT) ELSE 1 END AS k FROM bw),
kw AS (SELECT *, CASE WHEN rng > 0 THEN rng / k ELSE 1.0 END AS w FROM kk),
b AS (SELECT ul.segment, ul.feature, kw.n, kw.mn, kw.w,
  CAST(CASE WHEN kw.rng > 0 THEN LEAST(FLOOR((ul.value - kw.mn) * kw.k / kw.rng), kw.k - 1) ELSE 0 END AS BIGINT) AS bin
  FROM ul JOIN kw ON ul.segment = kw.segment AND ul.feature = kw.feature)
SELECT segment, feature, bin, ROUND(ANY_VALUE(mn) + bin * ANY_VALUE(w), 6) AS lo,
  ROUND(ANY_VALUE(mn) + (bin + 1) * ANY_VALUE(w), 6) AS hi, COUNT(*) AS count,
  ROUND(COUNT(*) / (ANY_VALUE(n) * ANY_VALUE(w)), 6) AS density
FROM b GROUP BY segment, feature, bin"""


@query("a10_histogram", _HIST)
def a10_histogram(spark, sf):
    return rounded(P.histogram(_m(spark, sf), FEATS, SEG))


_KDE = LONG.rstrip() + ",\n" + _STATS + """,
g AS (SELECT segment, feature, n, sd * POW(n, -0.2) AS h, mn - 3 * sd * POW(n, -0.2) AS g0,
  (mx - mn + 6 * sd * POW(n, -0.2)) / 199 AS gs FROM st),
pts AS (SELECT g.*, i AS grid_ix FROM g, range(0, 200) t(i) WHERE h > 0)
SELECT pts.segment, pts.feature, CAST(pts.grid_ix AS INTEGER) AS grid_ix, ROUND(ANY_VALUE(pts.g0 + pts.grid_ix * pts.gs), 6) AS x,
  ROUND(SUM(EXP(-0.5 * POW((pts.g0 + pts.grid_ix * pts.gs - ul.value) / pts.h, 2)) / (pts.n * pts.h * SQRT(2 * PI()))), 6) AS density
FROM pts JOIN ul ON pts.segment = ul.segment AND pts.feature = ul.feature
GROUP BY pts.segment, pts.feature, pts.grid_ix"""


@query("a11_kde", _KDE)
def a11_kde(spark, sf):
    return rounded(P.kde(_m(spark, sf), FEATS, SEG))


def _corr_sql():
    cells = []
    for a in FEATS:
        for b in FEATS:
            cells.append(f"SELECT {seg_label(SEG)}, '{a}' AS feature_a, '{b}' AS feature_b, "
                         f"ROUND(CORR({a}, {b}), 6) AS r FROM m GROUP BY GROUPING SETS (({SEG}), ())")
    return f"WITH {M_SQL}\n" + "\nUNION ALL ".join(cells)


@query("a12_correlation", _corr_sql())
def a12_correlation(spark, sf):
    return rounded(P.correlation(_m(spark, sf), FEATS, SEG))


_TREND = (f"WITH {M_SQL},\nlf AS ({sql_long('m', FEATS, ids=[SEG, 'score'])})\n"
          f"""SELECT {seg_label(SEG)}, feature, {r6('REGR_SLOPE(score, value)', 'slope')},
  {r6('REGR_INTERCEPT(score, value)', 'intercept')}, {r6('REGR_R2(score, value)', 'r2')},
  REGR_COUNT(score, value) AS n
FROM lf GROUP BY GROUPING SETS (({SEG}, feature), (feature))""")


@query("a13_trend", _TREND)
def a13_trend(spark, sf):
    return rounded(P.trend(_m(spark, sf), FEATS, "score", SEG))


_BOX = (f"WITH {M_SQL},\nlf AS ({sql_long('m', FEATS, ids=['score', SEG])}),\n"
        """q AS (SELECT score, l_returnflag, feature, QUANTILE_CONT(value, 0.25) AS q1,
  QUANTILE_CONT(value, 0.5) AS median, QUANTILE_CONT(value, 0.75) AS q3 FROM lf WHERE value IS NOT NULL
  GROUP BY score, l_returnflag, feature),
j AS (SELECT lf.*, q.q1, q.median, q.q3, q.q1 - 1.5 * (q.q3 - q.q1) AS lo, q.q3 + 1.5 * (q.q3 - q.q1) AS hi
  FROM lf JOIN q USING (score, l_returnflag, feature) WHERE value IS NOT NULL)
SELECT score, l_returnflag, feature, ROUND(ANY_VALUE(q1), 6) AS q1, ROUND(ANY_VALUE(median), 6) AS median,
  ROUND(ANY_VALUE(q3), 6) AS q3,
  ROUND(MIN(CASE WHEN value >= lo AND value <= hi THEN value END), 6) AS whisker_lo,
  ROUND(MAX(CASE WHEN value >= lo AND value <= hi THEN value END), 6) AS whisker_hi,
  CAST(SUM(CASE WHEN value >= lo AND value <= hi THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers,
  COUNT(value) AS n
FROM j GROUP BY score, l_returnflag, feature""")


@query("a14_box_stats", _BOX)
def a14_box_stats(spark, sf):
    return rounded(P.box_stats(_m(spark, sf), FEATS, ["score", SEG]))


_PAIR = f"""WITH {M_SQL},
mm AS (SELECT MIN(l_extendedprice) AS x0, MAX(l_extendedprice) AS x1, MIN(unit_price) AS y0, MAX(unit_price) AS y1 FROM m)
SELECT score, CAST(LEAST(FLOOR((l_extendedprice - x0) * 10 / (x1 - x0)), 9) AS INTEGER) AS bin_x,
  CAST(LEAST(FLOOR((unit_price - y0) * 10 / (y1 - y0)), 9) AS INTEGER) AS bin_y, COUNT(*) AS n
FROM m, mm GROUP BY ALL"""


@query("a15_pair_bins", _PAIR)
def a15_pair_bins(spark, sf):
    return P.pair_bins(_m(spark, sf), "l_extendedprice", "unit_price", "score")


_MABS_SRC = f"""WITH {M_SQL},
c AS (SELECT l_returnflag, l_extendedprice - 38000 AS price_centered, l_discount - 0.05 AS discount_centered FROM m),
lf AS ({sql_long('c', ['price_centered', 'discount_centered'], ids=[SEG])})
SELECT {seg_label(SEG)}, feature, ROUND(AVG(ABS(value)), 6) AS mean_abs
FROM lf GROUP BY GROUPING SETS (({SEG}, feature), (feature))"""


@query("a16_mean_abs", _MABS_SRC)
def a16_mean_abs(spark, sf):
    m = _m(spark, sf).select(SEG, (F.col("l_extendedprice") - 38000).alias("price_centered"),
                             (F.col("l_discount") - 0.05).alias("discount_centered"))
    return rounded(P.mean_abs(m, ["price_centered", "discount_centered"], SEG))


@query("a17_distinct_classes", f"""WITH {M_SQL}
SELECT {seg_label(SEG)}, COUNT(DISTINCT score) AS n_classes, COUNT(DISTINCT score) < 2 AS too_few
FROM m GROUP BY GROUPING SETS (({SEG}), ())""")
def a17_distinct_classes(spark, sf):
    return P.distinct_classes(_m(spark, sf), "score", SEG)


@query("a18_grouping_sets", LONG + f"""SELECT {seg_label(SEG)}, feature, COUNT(value) AS n,
  {r6('AVG(value)', 'mean')}, {r6('STDDEV_POP(value)', 'std_pop')}
FROM lf GROUP BY GROUPING SETS (({SEG}, feature), (feature))""")
def a18_grouping_sets(spark, sf):
    lf = P.long_form(_m(spark, sf), FEATS, ids=[SEG])
    v = F.col("value")
    return rounded(P.grouped_agg(lf, SEG, ["feature"], [
        F.count(v).alias("n"), F.avg(v).alias("mean"), F.stddev_pop(v).alias("std_pop")]))


@query("w1_percent_of_segment", f"""WITH {M_SQL}
SELECT l_returnflag, score, COUNT(*) AS n,
  ROUND(COUNT(*) * 100.0 / SUM(COUNT(*)) OVER (PARTITION BY l_returnflag), 6) AS pct
FROM m GROUP BY l_returnflag, score""")
def w1_percent_of_segment(spark, sf):
    return rounded(P.percent_of_segment(_m(spark, sf), SEG, "score"))


_ORDERS = """ol AS (SELECT o.o_orderkey, o.o_orderpriority, CAST(COUNT(*) AS DOUBLE) AS n_lines, AVG(l.l_discount) AS avg_discount,
  AVG(l.l_tax) AS avg_tax, SUM(l.l_quantity) AS sum_quantity, ANY_VALUE(o.o_totalprice) AS o_totalprice
  FROM orders o JOIN lineitem l ON l.l_orderkey = o.o_orderkey GROUP BY o.o_orderkey, o.o_orderpriority)"""


@query("a13_trend_orders", f"""WITH {_ORDERS},
lf AS ({sql_long('ol', ['n_lines', 'sum_quantity'], ids=['o_orderpriority', 'o_totalprice'])})
SELECT {seg_label('o_orderpriority')}, feature, {r6('REGR_SLOPE(o_totalprice, value)', 'slope')},
  {r6('REGR_INTERCEPT(o_totalprice, value)', 'intercept')}, {r6('REGR_R2(o_totalprice, value)', 'r2')},
  REGR_COUNT(o_totalprice, value) AS n
FROM lf GROUP BY GROUPING SETS ((o_orderpriority, feature), (feature))""")
def a13_trend_orders(spark, sf):
    """A13 on binding B5: order total price against its line aggregates, per priority and all."""
    from assay.plans.bindings import order_lines
    return rounded(P.trend(order_lines(spark, sf), ["n_lines", "sum_quantity"], "o_totalprice", "o_orderpriority"))
