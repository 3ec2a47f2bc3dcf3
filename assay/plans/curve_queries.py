"""Curve, threshold and report queries (W2-W5, X3, X4, P19, P20, S7) with oracles.

The curves come from the J3 sweep (each segment's base row, one feature stepped from
its min to its max in 50 steps) scored by a fixed formula that SQL can restate: a
smooth ramp for the score and a clipped line for the probability, centred per feature.
Trained-model curves use the same operators (explain_queries.py).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.functions import scalar as S
from assay.operators import curves as C
from assay.plans.catalog import query, rounded
from assay.plans.order_queries import (DOMAIN, GRID_SQL, _base_and_stats, domain_sql, domain_table,
                                       lookup_domain, sweep_grid)

GROUP = ["segment", "feature"]
# The formula scorer's centre (in units of the feature's range) per feature.
CENTRES = {"l_extendedprice": 0.5, "l_discount": 0.3, "l_tax": 0.7, "unit_price": 0.4}


def formula_curve(spark, sf):
    base, stats = _base_and_stats(spark, sf)
    g = sweep_grid(base, stats, list(CENTRES))
    c = F.element_at(F.create_map(*[x for k, v in CENTRES.items() for x in (F.lit(k), F.lit(v))]), F.col("feature"))
    t = (F.col("x") - F.col("min")) / (F.col("max") - F.col("min"))
    u = F.least(F.greatest((t - c) * 2 + 0.5, F.lit(0.0)), F.lit(1.0))
    y = 5 + 4 * (u * u * (3 - 2 * u))
    p = F.least(F.greatest(0.5 + (t - c) * 1.5, F.lit(0.0)), F.lit(1.0))
    return g.select("segment", "feature", "grid_ix", "x", y.alias("y"), p.alias("p"))


CURVE_SQL = f"""WITH {GRID_SQL},
centres(feature, centre) AS (VALUES {', '.join(f"('{k}', CAST({v} AS DOUBLE))" for k, v in CENTRES.items())}),
cur AS (SELECT segment, feature, grid_ix, x, (x - mn) / (mx - mn) AS t, centre FROM grid JOIN centres USING (feature)),
sc AS (SELECT *, LEAST(GREATEST((t - centre) * 2 + 0.5, 0.0), 1.0) AS u FROM cur),
curve AS (SELECT segment, feature, grid_ix, x, 5 + 4 * (u * u * (3 - 2 * u)) AS y,
  LEAST(GREATEST(0.5 + (t - centre) * 1.5, 0.0), 1.0) AS p FROM sc),
g AS (SELECT *, LAG(x) OVER w AS x0, LEAD(x) OVER w AS x2, LAG(y) OVER w AS y0, LEAD(y) OVER w AS y2, LAG(p) OVER w AS p0
  FROM curve WINDOW w AS (PARTITION BY segment, feature ORDER BY grid_ix)),
r AS (SELECT *, CASE WHEN x0 IS NULL THEN (y2 - y) / (x2 - x) WHEN x2 IS NULL THEN (y - y0) / (x - x0)
  ELSE (-(x2 - x) / ((x - x0) * ((x - x0) + (x2 - x)))) * y0 + (((x2 - x) - (x - x0)) / ((x - x0) * (x2 - x))) * y
     + ((x - x0) / ((x2 - x) * ((x - x0) + (x2 - x)))) * y2 END AS rate FROM g),
pk AS (SELECT *, ABS(rate) AS ar, LAG(ABS(rate)) OVER w AS pr, LEAD(ABS(rate)) OVER w AS nr,
  AVG(ABS(rate)) OVER (PARTITION BY segment, feature) AS mr FROM r WINDOW w AS (PARTITION BY segment, feature ORDER BY grid_ix)),
fl AS (SELECT *, COALESCE(pr IS NOT NULL AND nr IS NOT NULL AND ar > 2 * mr AND ar > pr AND ar > nr, FALSE) AS is_peak,
  COALESCE(p0 IS NOT NULL AND ((p0 < 0.5) <> (p < 0.5)), FALSE) AS is_crossing FROM pk)"""


def _flags(spark, sf):
    c = C.gradient(formula_curve(spark, sf), GROUP)
    return C.crossings(C.peaks(c, GROUP), GROUP)


@query("w2_gradient", CURVE_SQL + "\nSELECT segment, feature, grid_ix, ROUND(y, 6) AS y, ROUND(rate, 6) AS rate FROM fl")
def w2_gradient(spark, sf):
    return rounded(C.gradient(formula_curve(spark, sf), GROUP).select(*GROUP, "grid_ix", "y", "rate"))


@query("w3_peaks", CURVE_SQL + "\nSELECT segment, feature, grid_ix FROM fl WHERE is_peak")
def w3_peaks(spark, sf):
    return _flags(spark, sf).where("is_peak").select(*GROUP, "grid_ix")


@query("w4_crossings", CURVE_SQL + "\nSELECT segment, feature, grid_ix FROM fl WHERE is_crossing")
def w4_crossings(spark, sf):
    return _flags(spark, sf).where("is_crossing").select(*GROUP, "grid_ix")


LISTS_SQL = """,
lists AS (SELECT segment, feature,
  COALESCE(string_agg(CASE WHEN is_peak THEN printf('%.2f', x) END, ', ' ORDER BY grid_ix), 'None') AS detected,
  COALESCE(string_agg(CASE WHEN is_crossing THEN printf('%.2f', x) END, ', ' ORDER BY grid_ix), 'None') AS crossings,
  CAST(COUNT(*) FILTER (WHERE is_peak) AS INTEGER) AS n_detected,
  CAST(COUNT(*) FILTER (WHERE is_crossing) AS INTEGER) AS n_binary FROM fl GROUP BY segment, feature)"""


@query("x3_thresholds", CURVE_SQL + LISTS_SQL + "\nSELECT * FROM lists")
def x3_thresholds(spark, sf):
    t = C.thresholds(formula_curve(spark, sf), GROUP)
    return t.select(*GROUP, S.format_list(F.col("detected_thresholds")).alias("detected"),
                    S.format_list(F.col("binary_thresholds")).alias("crossings"),
                    F.size("detected_thresholds").alias("n_detected"), F.size("binary_thresholds").alias("n_binary"))


def threshold_report(t, spark):
    """X4 (+ J1, W5, P18-P20): one report row per (segment, feature)."""
    j = lookup_domain(t, domain_table(spark))
    cands = F.concat(F.col("detected_thresholds"), F.col("binary_thresholds"))
    dom = F.col("critical_threshold")
    near = C.nearest(cands, dom)
    pct, verdict = S.verdict(near, dom, F.size(cands) > 0)
    return j.select(*GROUP, F.col("name").alias("feature_name"),
                    S.format_list(F.col("detected_thresholds")).alias("detected"),
                    S.format_list(F.col("binary_thresholds")).alias("crossings"),
                    F.when(dom.isNotNull(), F.format_string("%.2f", dom)).otherwise(F.lit("Unknown")).alias("domain"),
                    "expected_effect", "typical_range", near.alias("nearest"), pct.alias("pct_diff"),
                    verdict.alias("verdict"), S.recommendation(F.col("expected_effect")).alias("recommendation"))


def _rec_sql(col):
    from assay.functions.scalar import RECOMMENDATION, RECOMMENDATION_OTHER
    whens = " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in RECOMMENDATION.items())
    return f"CASE {whens} ELSE '{RECOMMENDATION_OTHER}' END"


REPORT_SQL = CURVE_SQL.replace("WITH ", f"WITH {domain_sql()},\n", 1) + LISTS_SQL + f""",
cand AS (SELECT segment, feature, 0 AS src, grid_ix, x FROM fl WHERE is_peak
  UNION ALL SELECT segment, feature, 1, grid_ix, x FROM fl WHERE is_crossing),
n AS (SELECT DISTINCT feature, name, expected_effect FROM dom),
j AS (SELECT l.*, COALESCE(n.name, l.feature) AS feature_name, COALESCE(n.expected_effect, 'unknown') AS expected_effect,
  COALESCE(d.typical_range, 'unknown') AS typical_range, d.critical_threshold AS dv
  FROM lists l LEFT JOIN n ON n.feature = l.feature LEFT JOIN dom d ON d.feature = l.feature AND d.segment = l.segment),
near AS (SELECT j.segment, j.feature, arg_min(c.x, (ABS(c.x - j.dv), c.src, c.grid_ix)) AS nearest
  FROM j JOIN cand c ON c.segment = j.segment AND c.feature = j.feature WHERE j.dv IS NOT NULL GROUP BY ALL),
rep AS (SELECT j.*, near.nearest, ABS(ABS(near.nearest - j.dv) / NULLIF(j.dv, 0) * 100) AS pct_diff,
  j.n_detected + j.n_binary > 0 AS has FROM j LEFT JOIN near USING (segment, feature))
SELECT segment, feature, feature_name, detected, crossings,
  COALESCE(printf('%.2f', dv), 'Unknown') AS domain, expected_effect, typical_range,
  ROUND(nearest, 6) AS nearest, ROUND(pct_diff, 6) AS pct_diff,
  CASE WHEN dv IS NULL THEN CASE WHEN has THEN 'no reference' ELSE 'nothing detected' END
       WHEN NOT has THEN 'none detected' WHEN pct_diff < 15 THEN 'match' ELSE 'differs' END AS verdict,
  {_rec_sql('expected_effect')} AS recommendation FROM rep"""


@query("x4_threshold_report", REPORT_SQL)
def x4_threshold_report(spark, sf):
    return rounded(threshold_report(C.thresholds(formula_curve(spark, sf), GROUP), spark))


@query("s7_report_text")
def s7_report_text(spark, sf):
    """The threshold report written as markdown table lines (text sink) and read back."""
    from assay.session import scratch_path
    rep = x4_threshold_report(spark, sf)
    line = F.concat_ws(" | ", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in rep.columns])
    path = scratch_path(spark, "s7-report")
    rep.select(F.concat(F.lit("| "), line, F.lit(" |")).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path)


@query("w5_nearest_threshold", f"SELECT segment, feature, nearest FROM ({REPORT_SQL})")
def w5_nearest_threshold(spark, sf):
    """The detected threshold nearest to the domain value (first in list order on ties)."""
    return x4_threshold_report(spark, sf).select("segment", "feature", "nearest")


@query("p19_recommendation", f"SELECT segment, feature, expected_effect, recommendation FROM ({REPORT_SQL})")
def p19_recommendation(spark, sf):
    return x4_threshold_report(spark, sf).select("segment", "feature", "expected_effect", "recommendation")


@query("p20_verdict", f"SELECT segment, feature, domain, pct_diff, verdict FROM ({REPORT_SQL})")
def p20_verdict(spark, sf):
    return x4_threshold_report(spark, sf).select("segment", "feature", "domain", "pct_diff", "verdict")
