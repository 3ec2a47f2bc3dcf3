"""Feature-stage queries (F1-F11, P-rows over stages) on binding B1 with oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.functions import scalar as S
from assay.operators import outliers as O
from assay.operators import stages as ST
from assay.operators._small import attach
from assay.operators.profile import long_form
from assay.plans.bindings import B1, M_SQL, measurements
from assay.plans.catalog import query, rounded, sql_long

FEATS = list(B1.features)
SEG = B1.segment
KEYS = list(B1.key)
ROLES = dict(a="l_discount", b="l_tax", s="l_tax", f="l_discount", t="l_tax", h="unit_price", d="l_discount")
DERIVED = list(S.DERIVED_NAMES)

UL = (f"WITH {M_SQL},\nlf AS ({sql_long('m', FEATS, ids=[SEG])}),\n"
      "ul AS (SELECT CAST(l_returnflag AS VARCHAR) AS segment, feature, value FROM lf "
      "UNION ALL SELECT 'all', feature, value FROM lf)")

DESCRIBE_SQL = """SELECT segment, feature, COUNT(value) AS count, ROUND(AVG(value), 6) AS mean,
  ROUND(STDDEV_SAMP(value), 6) AS std, ROUND(MIN(value), 6) AS min, ROUND(QUANTILE_CONT(value, 0.25), 6) AS q25,
  ROUND(QUANTILE_CONT(value, 0.5), 6) AS q50, ROUND(QUANTILE_CONT(value, 0.75), 6) AS q75,
  ROUND(MAX(value), 6) AS max FROM c GROUP BY segment, feature"""


def _clip_sql(lo_p, hi_p, iqr: bool):
    lo = "q1 - 1.5 * (q3 - q1)" if iqr else "q1"
    hi = "q3 + 1.5 * (q3 - q1)" if iqr else "q3"
    return (UL + f""",
b AS (SELECT segment, feature, QUANTILE_CONT(value, {lo_p}) AS q1, QUANTILE_CONT(value, {hi_p}) AS q3 FROM ul
  GROUP BY segment, feature),
c AS (SELECT ul.segment, ul.feature, CASE WHEN value < {lo} THEN {lo} WHEN value > {hi} THEN {hi}
  ELSE value END AS value FROM ul JOIN b USING (segment, feature))
""" + DESCRIBE_SQL)


@query("f1_iqr_clip_describe", _clip_sql(0.25, 0.75, True))
def f1_iqr_clip_describe(spark, sf):
    """Flagship: IQR clip fitted per segment and for all rows, then describe."""
    return rounded(O.clip_describe(measurements(spark, sf), FEATS, SEG, "clip"))


@query("f3_winsorize_describe", _clip_sql(0.05, 0.95, False))
def f3_winsorize_describe(spark, sf):
    return rounded(O.clip_describe(measurements(spark, sf), FEATS, SEG, "winsorize"))


_REMOVE = UL + """,
b AS (SELECT segment, feature, QUANTILE_CONT(value, 0.25) AS q1, QUANTILE_CONT(value, 0.75) AS q3 FROM ul
  GROUP BY segment, feature),
rows AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag AS segment, l_extendedprice, l_discount, l_tax, unit_price FROM m
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, 'all', l_extendedprice, l_discount, l_tax, unit_price FROM m),
ok AS (SELECT r.segment FROM rows r
  JOIN b b1 ON b1.segment = r.segment AND b1.feature = 'l_extendedprice'
  JOIN b b2 ON b2.segment = r.segment AND b2.feature = 'l_discount'
  JOIN b b3 ON b3.segment = r.segment AND b3.feature = 'l_tax'
  JOIN b b4 ON b4.segment = r.segment AND b4.feature = 'unit_price'
  WHERE r.l_extendedprice BETWEEN b1.q1 - 1.5 * (b1.q3 - b1.q1) AND b1.q3 + 1.5 * (b1.q3 - b1.q1)
    AND r.l_discount BETWEEN b2.q1 - 1.5 * (b2.q3 - b2.q1) AND b2.q3 + 1.5 * (b2.q3 - b2.q1)
    AND r.l_tax BETWEEN b3.q1 - 1.5 * (b3.q3 - b3.q1) AND b3.q3 + 1.5 * (b3.q3 - b3.q1)
    AND r.unit_price BETWEEN b4.q1 - 1.5 * (b4.q3 - b4.q1) AND b4.q3 + 1.5 * (b4.q3 - b4.q1))
SELECT segment, COUNT(*) AS n_kept FROM ok GROUP BY segment"""


def remove_by_segment(df, features, segment, ids=()):
    """F2 (joint mode) per label: rows outside any feature's IQR fences are dropped.
    Bounds are pivoted wide (one row per label) so the filter is one row-wise predicate."""
    ul = O.labelled_long(df, features, segment)
    b = O.fitted_bounds(ul, "remove")
    wide = b.groupBy("segment").pivot("feature", list(features)).agg(F.first("lo").alias("lo"),
                                                                     F.first("hi").alias("hi"))
    rows = df.select(*ids, *features, F.explode(F.array(F.col(segment).cast("string"), F.lit("all"))).alias("segment"))
    j = attach(rows, wide, ["segment"])
    cond = F.lit(True)
    for f in features:
        x = F.col(f).cast("double")
        cond = cond & x.isNotNull() & ~F.isnan(x) & (x >= F.col(f"{f}_lo")) & (x <= F.col(f"{f}_hi"))
    return j.where(cond).select(*ids, "segment", *features)


@query("f2_iqr_remove", _REMOVE)
def f2_iqr_remove(spark, sf):
    kept = remove_by_segment(measurements(spark, sf), FEATS, SEG, KEYS)
    return kept.groupBy("segment").agg(F.count(F.lit(1)).alias("n_kept"))


@query("f2_iqr_remove_rows", _REMOVE.replace("ok AS (SELECT r.segment FROM", "ok AS (SELECT r.* FROM")
       .replace("SELECT segment, COUNT(*) AS n_kept FROM ok GROUP BY segment",
                "SELECT segment, l_orderkey, l_linenumber, l_partkey, l_suppkey FROM ok"))
def f2_iqr_remove_rows(spark, sf):
    """the keys of the rows that stay, per segment and for all."""
    return remove_by_segment(measurements(spark, sf), FEATS, SEG, KEYS).select("segment", *KEYS)


_DERIVED_SQL = """total_acidity AS (SELECT *, l_discount + l_tax AS ta FROM m),
d AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, score, l_extendedprice, l_discount, l_tax, unit_price,
  ta AS total_acidity, ta / (l_tax + 1) AS acidity_to_sugar, l_discount / (l_tax + 1) AS free_to_total_so2_ratio,
  unit_price / (ta + 1) AS alcohol_to_acidity, l_tax / (unit_price + 1) AS sugar_to_alcohol,
  unit_price / NULLIF(ta * LN(1 + l_tax), 0) AS balance_score, unit_price * (1 - (l_discount - 0.9)) AS body_score
  FROM total_acidity)"""


def derived(spark, sf):
    return measurements(spark, sf).withColumns(S.derived_ratios(**ROLES))


@query("p2_derived_ratios", f"""WITH {M_SQL}, {_DERIVED_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {', '.join(f'ROUND({c}, 6) AS {c}' for c in DERIVED)} FROM d""")
def p2_derived_ratios(spark, sf):
    return rounded(derived(spark, sf).select(*KEYS, *DERIVED))


SKEW_COLS = FEATS + DERIVED


@query("f4_skew_transform", f"""WITH {M_SQL}, {_DERIVED_SQL},
lf AS ({sql_long('d', SKEW_COLS)}),
s AS (SELECT feature, SKEWNESS(value) AS skew FROM lf GROUP BY feature)
SELECT feature, ROUND(skew, 6) AS skew,
  CASE WHEN skew > 0.5 THEN feature || '_log' WHEN skew > 0.3 THEN feature || '_sqrt' END AS added
FROM s""")
def f4_skew_transform(spark, sf):
    model = ST.SkewTransformer(inputCols=SKEW_COLS).fit(derived(spark, sf))
    st = model.fitted()
    rows = [(c, st["skew"][c], f"{c}_log" if c in st["log"] else f"{c}_sqrt" if c in st["sqrt"] else None)
            for c in SKEW_COLS]
    return rounded(spark.createDataFrame(rows, "feature string, skew double, added string"))


@query("f4_skew_apply", f"""WITH {M_SQL}, {_DERIVED_SQL},
lf AS ({sql_long('d', SKEW_COLS)}),
s AS (SELECT feature, SKEWNESS(value) AS skew FROM lf GROUP BY feature)
SELECT feature || CASE WHEN skew > 0.5 THEN '_log' ELSE '_sqrt' END AS feature,
  ROUND(SUM(CASE WHEN skew > 0.5 THEN LN(1 + value) ELSE SQRT(value) END), 6) AS total
FROM lf JOIN s USING (feature) WHERE skew > 0.3 GROUP BY ALL""")
def f4_skew_apply(spark, sf):
    """F4 applied: the sum of every added column (checks the transform, not only the choice)."""
    d = derived(spark, sf)
    model = ST.SkewTransformer(inputCols=SKEW_COLS).fit(d)
    out = model.transform(d)
    new = model.outputCols()
    lf = long_form(out, new)
    return rounded(lf.groupBy("feature").agg(F.sum("value").alias("total")))


def _scaled_sql(kind):
    parts = []
    for c in FEATS:
        if kind == "standard":
            e = (f"({c} - AVG({c}) OVER w) / CASE WHEN STDDEV_POP({c}) OVER w = 0 THEN 1 "
                 f"ELSE STDDEV_POP({c}) OVER w END")
        else:
            e = (f"CASE WHEN MAX({c}) OVER w - MIN({c}) OVER w = 0 THEN 0 ELSE "
                 f"({c} - MIN({c}) OVER w) / (MAX({c}) OVER w - MIN({c}) OVER w) END")
        parts.append(f"ROUND({e}, 6) AS {c}")
    return (f"WITH {M_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, {', '.join(parts)} "
            f"FROM m WINDOW w AS (PARTITION BY l_returnflag)")


@query("f5_standard_scale", _scaled_sql("standard"))
def f5_standard_scale(spark, sf):
    m = measurements(spark, sf).select(*KEYS, SEG, *FEATS)
    model = ST.ColumnScaler(inputCols=FEATS, kind="standard", segmentCol=SEG).fit(m)
    return rounded(model.transform(m))


@query("f6_minmax_scale", _scaled_sql("minmax"))
def f6_minmax_scale(spark, sf):
    m = measurements(spark, sf).select(*KEYS, SEG, *FEATS)
    model = ST.ColumnScaler(inputCols=FEATS, kind="minmax", segmentCol=SEG).fit(m)
    return rounded(model.transform(m))


@query("f8_f_regression", f"""WITH {M_SQL}, {_DERIVED_SQL},
lf AS ({sql_long('d', FEATS + DERIVED, ids=['score'])})
SELECT feature, ROUND(TRY_CAST(POW(CORR(value, score), 2) * (COUNT(*) - 2) / NULLIF(1 - POW(CORR(value, score), 2), 0) AS DOUBLE), 6) AS score
FROM lf WHERE value IS NOT NULL GROUP BY feature""")
def f8_f_regression(spark, sf):
    return rounded(ST.f_regression_scores(derived(spark, sf), FEATS + DERIVED, "score"))


def _kept_sql(scores: str, k: int) -> str:
    """Names of the k best features of a score query."""
    return f"SELECT feature FROM ({scores}) ORDER BY score DESC NULLS LAST, feature LIMIT {k}"


def _kept(spark, sf, method: str, k: int):
    """The feature columns that a fitted select-k stage leaves in its output."""
    d = derived(spark, sf)
    out = ST.KBestSelector(inputCols=FEATS + DERIVED, labelCol="score", method=method, k=k).fit(d).transform(d)
    return spark.createDataFrame([(c,) for c in FEATS + DERIVED if c in out.columns], "feature string")


_F8_SQL = f"""WITH {M_SQL}, {_DERIVED_SQL},
lf AS ({sql_long('d', FEATS + DERIVED, ids=['score'])})
SELECT feature, TRY_CAST(POW(CORR(value, score), 2) * (COUNT(*) - 2) / NULLIF(1 - POW(CORR(value, score), 2), 0) AS DOUBLE) AS score
FROM lf WHERE value IS NOT NULL GROUP BY feature"""


@query("f8_select_k", _kept_sql(_F8_SQL, 5))
def f8_select_k(spark, sf):
    """F8: select the five best features as a fitted stage."""
    return _kept(spark, sf, "f_regression", 5)


def _mi_sql():
    probs = ", ".join(str(i / 10) for i in range(1, 10))
    return f"""WITH {M_SQL}, {_DERIVED_SQL},
lf AS ({sql_long('d', FEATS + DERIVED, ids=['score'])}),
e AS (SELECT feature, QUANTILE_CONT(value, [{probs}]) AS edges FROM lf GROUP BY feature),
j AS (SELECT lf.feature, len(list_filter(e.edges, lambda x: lf.value > x)) AS bx, lf.score AS y
  FROM lf JOIN e USING (feature) WHERE lf.value IS NOT NULL AND lf.score IS NOT NULL),
c AS (SELECT feature, bx, y, COUNT(*) AS nxy FROM j GROUP BY ALL),
t AS (SELECT *, SUM(nxy) OVER (PARTITION BY feature) AS n, SUM(nxy) OVER (PARTITION BY feature, bx) AS nx,
  SUM(nxy) OVER (PARTITION BY feature, y) AS ny FROM c)
SELECT feature, ROUND(SUM(nxy / n * LN(nxy * n / (nx * ny))), 6) AS score FROM t GROUP BY feature"""


@query("f9_mutual_info", _mi_sql())
def f9_mutual_info(spark, sf):
    return rounded(ST.mutual_info_scores(derived(spark, sf), FEATS + DERIVED, "score"))


@query("f9_select_k", _kept_sql(_mi_sql(), 5))
def f9_select_k(spark, sf):
    """select the five features with the most mutual information as a fitted stage."""
    return _kept(spark, sf, "mutual_info", 5)


@query("f10_pca")
def f10_pca(spark, sf):
    """standardized PCA keeping over 95 % of the variance; PC columns of every row, a
    null ratio (zero denominator) counting as 0 as in the model path (rows-only check)."""
    cols = FEATS + DERIVED
    d = derived(spark, sf).fillna(0.0, subset=cols)
    pm, k, cum = ST.pca_components(d, cols, 0.95)
    return ST.pca_project(pm, d, k, keep=KEYS + [SEG, "score"]).withColumn("explained", F.lit(cum))


@query("f11_feature_pipeline")
def f11_feature_pipeline(spark, sf):
    """clip -> derive -> recode -> skew transforms -> scale -> class targets, fitted per
    segment where the stage allows, as one Pipeline (rows-only check; tested in tests/)."""
    from assay.operators.pipeline import feature_pipeline
    m = measurements(spark, sf)
    pm = feature_pipeline(FEATS, SEG, ROLES).fit(m)
    return pm.transform(m)


@query("f4_skew_transform_events", """WITH e AS (SELECT event_type, value FROM events)
SELECT ROUND(SKEWNESS(value), 6) AS skew, ROUND(SUM(LN(1 + value)), 6) AS value_log_total,
  CASE WHEN SKEWNESS(value) > 0.5 THEN 'value_log' WHEN SKEWNESS(value) > 0.3 THEN 'value_sqrt' END AS added FROM e""")
def f4_skew_transform_events(spark, sf):
    """F4 on binding B2 (events.value, strongly right-skewed): the decision and the sum of
    the added column."""
    from assay.plans.bindings import events
    ev = events(spark, sf)
    m = ST.SkewTransformer(inputCols=["value"]).fit(ev)
    added = (m.outputCols() or [None])[0]
    out = m.transform(ev)
    total = F.sum("value_log") if "value_log" in out.columns else F.lit(None).cast("double")
    return rounded(out.agg(F.lit(m.fitted()["skew"]["value"]).alias("skew"), total.alias("value_log_total"),
                           F.lit(added).cast("string").alias("added")))
