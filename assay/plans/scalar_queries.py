"""Scalar-function queries (P1, P3-P18, P22-P24) with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.functions import scalar as S
from assay.plans.bindings import B1, M_SQL, measurements
from assay.plans.catalog import query, rounded
from assay.sources.tables import table

KEYS = list(B1.key)
SEG = B1.segment
FEATS = list(B1.features)


def _m(spark, sf):
    return measurements(spark, sf)


@query("p1_tag", """SELECT c_custkey, c_acctbal, 'customer' AS source FROM customer""")
def p1_tag(spark, sf):
    return S.tag(table(spark, sf, "customer").select("c_custkey", "c_acctbal"), "source", "customer")


@query("p3_recode", f"""WITH {M_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag,
  CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 END AS segment_numeric FROM m""")
def p3_recode(spark, sf):
    m = _m(spark, sf)
    return m.select(*KEYS, SEG, S.recode(F.col(SEG), {"A": 0, "N": 1}).alias("segment_numeric"))


@query("p4_numeric_columns", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def p4_numeric_columns(spark, sf):
    li = table(spark, sf, "lineitem")
    cols = S.numeric_columns(li, exclude=["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    return li.select(*cols)


@query("p5_prepare", f"""WITH {M_SQL} SELECT l_extendedprice, l_discount, l_tax, unit_price,
  CAST(score >= 6 AS INTEGER) AS quality_binary FROM m""")
def p5_prepare(spark, sf):
    m = _m(spark, sf).withColumns({"quality_binary": S.binary_class(F.col("score")),
                                   "quality_multiclass": S.multiclass(F.col("score"))})
    out, _, _ = S.prepare(m, "binary", drop=KEYS + ["absent_column"])
    return out


@query("p6_segment_filter", f"""WITH {M_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, score FROM m WHERE l_returnflag = 'R'""")
def p6_segment_filter(spark, sf):
    return _m(spark, sf).where(F.col(SEG) == "R").select(*KEYS, "score")


@query("p7_range_keep", f"""WITH {M_SQL}
SELECT l_returnflag, COUNT(*) AS n FROM m
WHERE NULLIF(l_discount, 0.05) >= 0.02 AND NULLIF(l_discount, 0.05) <= 0.08 GROUP BY l_returnflag""")
def p7_range_keep(spark, sf):
    m = _m(spark, sf).withColumn("d", F.nullif(F.col("l_discount"), F.lit(0.05)))
    return m.where(S.in_range(F.col("d"), 0.02, 0.08)).groupBy(SEG).agg(F.count(F.lit(1)).alias("n"))


@query("p8_clip", f"""WITH {M_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CASE WHEN l_extendedprice < 10000 THEN 10000.0 WHEN l_extendedprice > 90000 THEN 90000.0
  ELSE l_extendedprice END AS l_extendedprice FROM m""")
def p8_clip(spark, sf):
    from assay.operators.stages import clip
    m = _m(spark, sf)
    return m.select(*KEYS, clip(F.col("l_extendedprice"), F.lit(10000.0), F.lit(90000.0)).alias("l_extendedprice"))


_CLASSES = f"""WITH {M_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, score,
  CAST(score >= 6 AS INTEGER) AS quality_binary,
  CAST(CASE WHEN score BETWEEN 0 AND 4 THEN 0 WHEN score > 4 AND score <= 6 THEN 1
            WHEN score > 6 AND score <= 10 THEN 2 END AS INTEGER) AS quality_multiclass FROM m"""


@query("p9_p10_class_targets", _CLASSES)
def p9_p10_class_targets(spark, sf):
    m = _m(spark, sf)
    return m.select(*KEYS, "score", S.binary_class(F.col("score")).alias("quality_binary"),
                    S.multiclass(F.col("score")).alias("quality_multiclass"))


@query("p11_serving_transforms", f"""WITH {M_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  ROUND(LN(1 + (l_discount + 1e-5)), 6) AS l_discount_log, ROUND(SQRT(l_discount + 1e-5), 6) AS l_discount_sqrt,
  ROUND(LN(1 + (l_tax + 1e-5)), 6) AS l_tax_log, ROUND(SQRT(l_tax + 1e-5), 6) AS l_tax_sqrt FROM m""")
def p11_serving_transforms(spark, sf):
    m = _m(spark, sf)
    return rounded(m.select(*KEYS, *[v.alias(k) for k, v in S.serving_transforms(["l_discount", "l_tax"]).items()]))


@query("p12_round_half", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity / 4 AS x,
  ROUND_EVEN(l_quantity / 4 * 2, 0) / 2 AS rounded FROM lineitem""")
def p12_round_half(spark, sf):
    li = table(spark, sf, "lineitem")
    x = F.col("l_quantity") / 4
    return li.select(*KEYS, x.alias("x"), S.round_half(x).alias("rounded"))


@query("p13_decode", f"""WITH {M_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  ['Bad', 'Average', 'Good'][CASE WHEN score BETWEEN 0 AND 4 THEN 0 WHEN score <= 6 THEN 1 ELSE 2 END + 1] AS label3,
  ['Bad', 'Good'][CAST(score >= 6 AS INTEGER) + 1] AS label2 FROM m""")
def p13_decode(spark, sf):
    m = _m(spark, sf)
    return m.select(*KEYS, S.decode(S.multiclass(F.col("score")), S.LABELS_3).alias("label3"),
                    S.decode(S.binary_class(F.col("score")), S.LABELS_2).alias("label2"))


@query("p14_p21_probabilities", f"""WITH {M_SQL}, v AS (SELECT *, (l_discount + 1) + (l_tax + 2) + (score + 1) AS total FROM m)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ROUND((l_discount + 1) / total, 6) AS probability_bad,
  ROUND((l_tax + 2) / total, 6) AS probability_average, ROUND((score + 1) / total, 6) AS probability_good,
  ROUND(greatest((l_discount + 1) / total, (l_tax + 2) / total, (score + 1) / total), 6) AS confidence FROM v""")
def p14_p21_probabilities(spark, sf):
    """P14 + P21 on a probability vector that is known per row: the named columns of its
    entries and the largest of them."""
    from pyspark.ml.functions import array_to_vector
    parts = [F.col("l_discount") + 1, F.col("l_tax") + 2, F.col("score") + 1]
    total = parts[0] + parts[1] + parts[2]
    m = _m(spark, sf).withColumn("p", array_to_vector(F.array(*[(x / total).cast("double") for x in parts])))
    named = S.probability_columns(F.col("p"), ["probability_bad", "probability_average", "probability_good"])
    return rounded(m.select(*KEYS, *[c.alias(n) for n, c in named.items()], S.confidence(F.col("p")).alias("confidence")))


EXPECTED = ["l_tax", "l_discount", "missing_feature", "l_extendedprice"]


@query("p15_conform", f"""WITH {M_SQL} SELECT l_tax, l_discount, 0.0 AS missing_feature, l_extendedprice FROM m""")
def p15_conform(spark, sf):
    out, _missing, _extra = S.conform(_m(spark, sf), EXPECTED)
    return out


@query("p16_cast_string", f"""WITH {M_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(score AS VARCHAR) AS score_text FROM m""")
def p16_cast_string(spark, sf):
    return _m(spark, sf).select(*KEYS, S.as_string(F.col("score")).alias("score_text"))


_RANGE = r"'(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)'"


@query("p17_parse_range", f"""SELECT doc_id,
  CASE WHEN regexp_extract(text, {_RANGE}, 1) <> '' THEN TRY_CAST(regexp_extract(text, {_RANGE}, 1) AS DOUBLE) END AS range_lo,
  CASE WHEN regexp_extract(text, {_RANGE}, 2) <> '' THEN TRY_CAST(regexp_extract(text, {_RANGE}, 2) AS DOUBLE) END AS range_hi
FROM documents""")
def p17_parse_range(spark, sf):
    d = table(spark, sf, "documents")
    lo, hi = S.parse_range(F.col("text"))
    return d.select("doc_id", lo.alias("range_lo"), hi.alias("range_hi"))


@query("p18_format_list", """SELECT l_orderkey,
  COALESCE(string_agg(printf('%.2f', l_discount), ', ' ORDER BY l_discount), 'None') AS discounts,
  COALESCE(string_agg(CASE WHEN l_discount >= 0.09 THEN printf('%.2f', l_discount) END, ', ' ORDER BY l_discount), 'None') AS high_discounts
FROM lineitem GROUP BY l_orderkey""")
def p18_format_list(spark, sf):
    li = table(spark, sf, "lineitem")
    g = li.groupBy("l_orderkey").agg(
        F.array_sort(F.collect_list("l_discount")).alias("a"),
        F.array_sort(F.collect_list(F.when(F.col("l_discount") >= 0.09, F.col("l_discount")))).alias("b"))
    return g.select("l_orderkey", S.format_list(F.col("a")).alias("discounts"),
                    S.format_list(F.col("b")).alias("high_discounts"))


# Valid range per feature and segment ('default' applies to other segments).
RANGES = [
    ("l_extendedprice", "A", 1000.0, 100000.0), ("l_extendedprice", "default", 900.0, 105000.0),
    ("l_discount", "A", 0.0, 0.08), ("l_discount", "R", 0.01, 0.1), ("l_discount", "default", 0.0, 0.1),
    ("l_tax", "default", 0.0, 0.06),
]


def range_table(spark):
    return spark.createDataFrame(RANGES, "feature string, segment string, lo double, hi double")


def _ranges_sql():
    rows = ", ".join(f"('{f}', '{s}', CAST({lo} AS DOUBLE), CAST({hi} AS DOUBLE))" for f, s, lo, hi in RANGES)
    return f"rt(feature, segment, lo, hi) AS (VALUES {rows})"


@query("p22_range_check", f"""WITH {M_SQL}, {_ranges_sql()},
lf AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, 'l_extendedprice' AS feature, l_extendedprice AS value FROM m
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, 'l_discount', l_discount FROM m
  UNION ALL SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, 'l_tax', l_tax FROM m),
j AS (SELECT lf.*, COALESCE(s.lo, d.lo) AS lo, COALESCE(s.hi, d.hi) AS hi FROM lf
  LEFT JOIN rt s ON s.feature = lf.feature AND s.segment = lf.l_returnflag
  LEFT JOIN rt d ON d.feature = lf.feature AND d.segment = 'default')
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, feature, value IS NOT NULL AND value >= lo AND value <= hi AS inside,
  LEAST(GREATEST(value, lo), hi) AS clamped FROM j""")
def p22_range_check(spark, sf):
    from assay.operators.profile import long_form
    lf = long_form(_m(spark, sf), ["l_extendedprice", "l_discount", "l_tax"], ids=KEYS + [SEG])
    rt = range_table(spark)  # a fixed table of a few rows: broadcast is bounded by construction
    seg_r = rt.select("feature", F.col("segment").alias(SEG), F.col("lo").alias("s_lo"), F.col("hi").alias("s_hi"))
    def_r = rt.where(F.col("segment") == "default").select("feature", F.col("lo").alias("d_lo"), F.col("hi").alias("d_hi"))
    j = lf.join(F.broadcast(seg_r), ["feature", SEG], "left").join(F.broadcast(def_r), ["feature"], "left")
    lo, hi = F.coalesce("s_lo", "d_lo"), F.coalesce("s_hi", "d_hi")
    inside, clamped = S.range_flags(F.col("value"), lo, hi)
    return j.select(*KEYS, "feature", inside.alias("inside"), clamped.alias("clamped"))


# Per-segment default for absent values.
DEFAULTS = [("A", 0.05), ("N", 0.04), ("R", 0.06)]


@query("p23_default_fill", f"""WITH {M_SQL},
dv(segment, dflt) AS (VALUES {', '.join(f"('{s}', CAST({v} AS DOUBLE))" for s, v in DEFAULTS)})
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, COALESCE(NULLIF(l_discount, 0.0), dv.dflt) AS l_discount
FROM m LEFT JOIN dv ON dv.segment = m.l_returnflag""")
def p23_default_fill(spark, sf):
    dv = spark.createDataFrame(DEFAULTS, f"{SEG} string, dflt double")
    m = _m(spark, sf).withColumn("l_discount", F.nullif("l_discount", F.lit(0.0)))
    return (m.join(F.broadcast(dv), SEG, "left")
            .select(*KEYS, F.coalesce("l_discount", "dflt").alias("l_discount")))


@query("p24_jitter")
def p24_jitter(spark, sf):
    """P24 (rows-only): score jittered with N(0, 0.1) for scatter views."""
    return _m(spark, sf).select(*KEYS, "score", S.jitter(F.col("score")).alias("score_jitter"))
