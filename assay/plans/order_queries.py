"""Ordering, set, lookup and I/O queries (O1-O9, J1-J3, S1, S3) with their oracles."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.operators import ordering as OR
from assay.operators import profile as P
from assay.operators._small import attach
from assay.plans.bindings import B1, M_SQL, measurements
from assay.plans.catalog import query, rounded, seg_label, sql_long
from assay.session import scratch_path
from assay.sources import tables as IO

KEYS = list(B1.key)
SEG = B1.segment
FEATS = list(B1.features)


def _m(spark, sf):
    return measurements(spark, sf)


_CORR_TARGET = f"""WITH {M_SQL},
lf AS ({sql_long('m', FEATS, ids=[SEG, 'score'])}),
c AS (SELECT {seg_label(SEG)}, feature, CORR(value, score) AS r FROM lf
  GROUP BY GROUPING SETS (({SEG}, feature), (feature)))"""


def _corr_target(spark, sf):
    m = _m(spark, sf)
    return P.correlation(m, FEATS + ["score"], SEG)


@query("o1_top_k", _CORR_TARGET + """,
rk AS (SELECT segment, feature, r, ROW_NUMBER() OVER (PARTITION BY segment ORDER BY r DESC, feature) AS rank FROM c)
SELECT segment, feature, ROUND(r, 6) AS r, rank FROM rk WHERE rank <= 2""")
def o1_top_k(spark, sf):
    c = _corr_target(spark, sf).where((F.col("feature_b") == "score") & (F.col("feature_a") != "score"))
    c = c.select("segment", F.col("feature_a").alias("feature"), "r")
    return rounded(OR.top_k_per_group(c, "segment", [F.desc("r"), F.asc("feature")], 2))


@query("o2_sort", f"""WITH {M_SQL} SELECT score, COUNT(*) AS n FROM m GROUP BY score ORDER BY n DESC, score""")
def o2_sort(spark, sf):
    return _m(spark, sf).groupBy("score").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "score")


@query("o3_rank_by_corr", _CORR_TARGET + """
SELECT segment, feature, ROUND(r, 6) AS r,
  ROW_NUMBER() OVER (PARTITION BY segment ORDER BY ABS(r) DESC, feature) AS rank FROM c""")
def o3_rank_by_corr(spark, sf):
    return rounded(OR.rank_by_abs_corr(_corr_target(spark, sf), "score"))


@query("a15_top_pair_bins", _CORR_TARGET + f""",
top AS (SELECT DISTINCT feature FROM (SELECT feature, ROW_NUMBER() OVER (PARTITION BY segment ORDER BY ABS(r) DESC, feature) AS rank
  FROM c) WHERE rank <= 5),
n AS (SELECT ROW_NUMBER() OVER () AS rid, * FROM m),
pl AS ({sql_long('n', FEATS, ids=['rid', 'score'])}),
e AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi FROM pl GROUP BY feature),
x AS (SELECT rid, score, feature, CAST(LEAST(FLOOR((value - lo) * 10 / (hi - lo)), 9) AS INTEGER) AS bin
  FROM pl JOIN e USING (feature) JOIN top USING (feature) WHERE value IS NOT NULL)
SELECT a.feature AS feature_x, b.feature AS feature_y, a.score, a.bin AS bin_x, b.bin AS bin_y, COUNT(*) AS n
FROM x a JOIN x b ON a.rid = b.rid AND a.feature < b.feature GROUP BY ALL""")
def a15_top_pair_bins(spark, sf):
    """A15 over the union of each segment's five features that correlate most with the score."""
    ranked = OR.rank_by_abs_corr(_corr_target(spark, sf), "score")
    top = [r["feature"] for r in ranked.where("rank <= 5").select("feature").distinct().collect()]
    return P.all_pair_bins(_m(spark, sf), top, "score")


_MODELS = ["global_mean", "segment_mean"] + [f"trend_{f}" for f in FEATS]


def _leaderboard_sql():
    parts = ["SELECT 1 AS ordinal, 'global_mean' AS model, SQRT(AVG(POW(score - g.mu, 2))) AS rmse FROM m, g",
             "SELECT 2, 'segment_mean', SQRT(AVG(POW(score - s.mu, 2))) FROM m JOIN s USING (l_returnflag)"]
    for i, f in enumerate(FEATS):
        parts.append(f"SELECT {i + 3}, 'trend_{f}', SQRT(AVG(POW(score - (t.a_{f} + t.b_{f} * {f}), 2))) FROM m, t")
    trend = ", ".join(f"REGR_SLOPE(score, {f}) AS b_{f}, REGR_INTERCEPT(score, {f}) AS a_{f}" for f in FEATS)
    return f"""WITH {M_SQL}, g AS (SELECT AVG(score) AS mu FROM m),
s AS (SELECT l_returnflag, AVG(score) AS mu FROM m GROUP BY l_returnflag),
t AS (SELECT {trend} FROM m),
lb AS ({' UNION ALL '.join(parts)})
SELECT ordinal, model, ROUND(rmse, 6) AS rmse, ROW_NUMBER() OVER (ORDER BY rmse, ordinal) = 1 AS is_best FROM lb"""


def baseline_leaderboard(spark, sf):
    """Baseline scorers fitted by aggregates; every model's error in one pass (M18 + O4)."""
    m = _m(spark, sf)
    y = F.col("score").cast("double")
    fit = m.agg(F.avg(y).alias("mu"), *[F.regr_slope(y, F.col(f)).alias(f"b_{f}") for f in FEATS],
                *[F.regr_intercept(y, F.col(f)).alias(f"a_{f}") for f in FEATS]).first()
    seg_mu = m.groupBy(SEG).agg(F.avg(y).alias("seg_mu"))
    j = attach(m, seg_mu, [SEG])
    preds = {"global_mean": F.lit(fit["mu"]), "segment_mean": F.col("seg_mu")}
    for f in FEATS:
        preds[f"trend_{f}"] = F.lit(fit[f"a_{f}"]) + F.lit(fit[f"b_{f}"]) * F.col(f)
    errs = j.agg(*[F.sqrt(F.avg(F.pow(y - p, 2))).alias(k) for k, p in preds.items()])
    cells = F.array(*[F.struct(F.lit(i + 1).alias("ordinal"), F.lit(k).alias("model"), F.col(k).alias("rmse"))
                      for i, k in enumerate(preds)])
    return errs.select(F.inline(cells))


@query("o4_best_model", _leaderboard_sql())
def o4_best_model(spark, sf):
    lb = OR.best_by(baseline_leaderboard(spark, sf), "rmse", lower_is_better=True)
    return rounded(lb)


@query("o5_first_row", f"""WITH {M_SQL}
SELECT l_returnflag, arg_min(l_orderkey, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS l_orderkey,
  arg_min(l_linenumber, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS l_linenumber,
  arg_min(l_partkey, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS l_partkey,
  arg_min(l_suppkey, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS l_suppkey,
  arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS l_extendedprice,
  arg_min(score, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS score FROM m GROUP BY l_returnflag""")
def o5_first_row(spark, sf):
    m = _m(spark, sf).select(*KEYS, SEG, "l_extendedprice", "score")
    return OR.base_rows(m, KEYS, SEG)


@query("o6_seeded_sample", """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem
ORDER BY md5('42' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) || '-' ||
  CAST(l_partkey AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR)) LIMIT 500""")
def o6_seeded_sample(spark, sf):
    li = IO.table(spark, sf, "lineitem").select(*KEYS)
    key = F.concat_ws("-", *[F.col(k).cast("string") for k in KEYS])
    return OR.seeded_sample(li, key, 500, seed=42)


@query("o7_union_tagged", """SELECT c_custkey AS id, c_nationkey AS nationkey, c_acctbal AS acctbal, 'customer' AS source FROM customer
UNION ALL SELECT s_suppkey, s_nationkey, s_acctbal, 'supplier' FROM supplier""")
def o7_union_tagged(spark, sf):
    c = IO.table(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nationkey"),
                                               F.col("c_acctbal").alias("acctbal"))
    s = IO.table(spark, sf, "supplier").select(F.col("s_acctbal").alias("acctbal"), F.col("s_suppkey").alias("id"),
                                               F.col("s_nationkey").alias("nationkey"))
    return OR.union_tagged({"customer": c, "supplier": s})


@query("o8_distinct_union", _CORR_TARGET + """,
rk AS (SELECT segment, feature, ROW_NUMBER() OVER (PARTITION BY segment ORDER BY ABS(r) DESC, feature) AS rank FROM c)
SELECT feature FROM rk WHERE segment = 'A' AND rank <= 2
UNION SELECT feature FROM rk WHERE segment = 'R' AND rank <= 2""")
def o8_distinct_union(spark, sf):
    rk = OR.rank_by_abs_corr(_corr_target(spark, sf), "score")
    a = rk.where((F.col("segment") == "A") & (F.col("rank") <= 2)).select("feature")
    r = rk.where((F.col("segment") == "R") & (F.col("rank") <= 2)).select("feature")
    return a.union(r).distinct()


EXPECTED_COLUMNS = ["l_orderkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_comment", "l_weight"]


@query("o9_column_diff", f"""WITH e(name) AS (VALUES {', '.join(f"('{c}')" for c in EXPECTED_COLUMNS)}),
a AS (SELECT column_name AS name FROM information_schema.columns WHERE table_name = 'lineitem')
SELECT name, 'missing' AS status FROM e WHERE name NOT IN (SELECT name FROM a)
UNION ALL SELECT name, 'extra' FROM a WHERE name NOT IN (SELECT name FROM e)""")
def o9_column_diff(spark, sf):
    li = IO.table(spark, sf, "lineitem")
    return OR.column_diff(spark, EXPECTED_COLUMNS, li.columns)


# Domain reference for binding B1 (name, expected effect, and per segment
# the typical range text and critical threshold).  Absent features get a default record.
DOMAIN = [
    ("l_extendedprice", "Extended price", "positive", "A", "900-105000", 50000.0),
    ("l_extendedprice", "Extended price", "positive", "R", "900-105000", 52000.0),
    ("l_discount", "Discount", "negative", "A", "0.00-0.10", 0.05),
    ("l_discount", "Discount", "negative", "N", "0.00-0.10", 0.06),
    ("unit_price", "Unit price", "optimal range", "A", "900-2100", 1500.0),
    ("unit_price", "Unit price", "optimal range", "N", "900-2100", 1450.0),
    ("unit_price", "Unit price", "optimal range", "R", "900-2100", 1550.0),
]
DOMAIN_SCHEMA = ("feature string, name string, expected_effect string, segment string, "
                 "typical_range string, critical_threshold double")


def domain_table(spark):
    return spark.createDataFrame(DOMAIN, DOMAIN_SCHEMA)


def domain_sql() -> str:
    rows = ", ".join(f"('{a}', '{b}', '{c}', '{d}', '{e}', CAST({f} AS DOUBLE))" for a, b, c, d, e, f in DOMAIN)
    return f"dom(feature, name, expected_effect, segment, typical_range, critical_threshold) AS (VALUES {rows})"


def lookup_domain(facts, ref, segment="segment"):
    """Left lookup on (feature, segment) with a default record.  ``ref`` is a fixed
    table of a few rows, so the broadcast is bounded by construction."""
    names = ref.select("feature", F.col("name").alias("_n"), F.col("expected_effect").alias("_e")).distinct()
    per_seg = ref.select("feature", F.col("segment").alias(segment), "typical_range", "critical_threshold")
    j = facts.join(F.broadcast(names), "feature", "left").join(F.broadcast(per_seg), ["feature", segment], "left")
    return j.select(*facts.columns, F.coalesce("_n", "feature").alias("name"),
                    F.coalesce("_e", F.lit("unknown")).alias("expected_effect"),
                    F.coalesce("typical_range", F.lit("unknown")).alias("typical_range"),
                    F.col("critical_threshold"))


@query("j1_domain_lookup", f"""WITH {M_SQL}, {domain_sql()},
lf AS ({sql_long('m', FEATS, ids=[SEG])}),
f AS (SELECT l_returnflag AS segment, feature, SKEWNESS(value) AS skew FROM lf GROUP BY ALL),
n AS (SELECT DISTINCT feature, name, expected_effect FROM dom)
SELECT f.segment, f.feature, ROUND(f.skew, 6) AS skew, COALESCE(n.name, f.feature) AS name,
  COALESCE(n.expected_effect, 'unknown') AS expected_effect, COALESCE(d.typical_range, 'unknown') AS typical_range,
  d.critical_threshold FROM f LEFT JOIN n ON n.feature = f.feature
  LEFT JOIN dom d ON d.feature = f.feature AND d.segment = f.segment""")
def j1_domain_lookup(spark, sf):
    lf = P.long_form(_m(spark, sf), FEATS, ids=[SEG])
    facts = lf.groupBy(F.col(SEG).alias("segment"), "feature").agg(P.skew_expr(F.col("value")).alias("skew"))
    return rounded(lookup_domain(facts, domain_table(spark)))


@query("j2_attach_by_key", f"""WITH {M_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, ROUND((unit_price - AVG(unit_price) OVER ()) / STDDEV_POP(unit_price) OVER (), 6) AS unit_price_z,
  score, l_returnflag FROM m""")
def j2_attach_by_key(spark, sf):
    from assay.operators.stages import ColumnScaler
    m = _m(spark, sf)
    key = KEYS + ["l_extendedprice"]   # the four key columns repeat once at sf0.001; with the price they never do
    x = m.select(*key, "unit_price")
    z = ColumnScaler(inputCols=["unit_price"]).fit(x).transform(x).withColumnRenamed("unit_price", "unit_price_z")
    targets = m.select(*key, "score", SEG)
    return rounded(z.join(targets, key, "inner").drop("l_extendedprice"))


GRID = 50


def sweep_grid(base, stats, features, n: int = GRID):
    """Each base row repeated over an n-point grid of one feature (min + i*step,
    step = (max-min)/n, max excluded) -- a generator on the base rows joined to their
    segment's min/max by equi-join, never a cross join."""
    j = base.join(stats, "segment")
    j = j.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("grid_ix"))
    x = F.col("min") + F.col("grid_ix") * ((F.col("max") - F.col("min")) / n)
    return j.withColumn("x", x)


def _base_and_stats(spark, sf):
    m = _m(spark, sf)
    base = OR.base_rows(m.select(*KEYS, SEG, *FEATS), KEYS, SEG).withColumnRenamed(SEG, "segment")
    lf = P.long_form(m, FEATS, ids=[SEG])
    stats = lf.groupBy(F.col(SEG).alias("segment"), "feature").agg(F.min("value").alias("min"),
                                                                     F.max("value").alias("max"))
    return base, stats


GRID_SQL = f"""{M_SQL},
base AS (SELECT l_returnflag AS segment, {', '.join(f"arg_min({f}, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS {f}" for f in FEATS)}
  FROM m GROUP BY l_returnflag),
lf AS ({sql_long('m', FEATS, ids=[SEG])}),
st AS (SELECT l_returnflag AS segment, feature, MIN(value) AS mn, MAX(value) AS mx FROM lf GROUP BY ALL),
grid AS (SELECT base.*, st.feature, st.mn, st.mx, CAST(i AS INTEGER) AS grid_ix, st.mn + i * ((st.mx - st.mn) / {GRID}) AS x
  FROM base JOIN st USING (segment), range(0, {GRID}) t(i))"""


@query("j3_grid_expand", f"""WITH {GRID_SQL}
SELECT segment, feature, grid_ix, ROUND(x, 6) AS x FROM grid""")
def j3_grid_expand(spark, sf):
    base, stats = _base_and_stats(spark, sf)
    g = sweep_grid(base, stats, FEATS)
    return rounded(g.select("segment", "feature", "grid_ix", "x"))


_SCHEMA = T.StructType([T.StructField("l_orderkey", T.LongType()), T.StructField("l_linenumber", T.IntegerType()),
                        T.StructField("l_partkey", T.LongType()), T.StructField("l_suppkey", T.LongType()),
                        T.StructField("l_returnflag", T.StringType()), T.StructField("l_extendedprice", T.DoubleType()),
                        T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType()),
                        T.StructField("unit_price", T.DoubleType()), T.StructField("score", T.IntegerType())])


@query("s1_read_delimited", f"WITH {M_SQL} SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_returnflag, score FROM m")
def s1_read_delimited(spark, sf):
    """The measurement table written as ';'-separated text with a header, read back
    with a declared schema (no inference)."""
    path = scratch_path(spark, "s1-delimited")
    _m(spark, sf).write.mode("overwrite").option("sep", ";").option("header", True).csv(path)
    back = IO.read_delimited(spark, path, _SCHEMA, sep=";", mode="FAILFAST")
    return back.select(*KEYS, "l_returnflag", "score")


@query("s3_write_partitioned", f"""WITH {M_SQL}
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, score, l_returnflag FROM m WHERE l_returnflag = 'N'""")
def s3_write_partitioned(spark, sf):
    """S3: result table written partitioned by segment; reading one segment prunes the rest."""
    path = scratch_path(spark, "s3-partitioned")
    IO.write_table(_m(spark, sf), path, partition_by=SEG)
    back = IO.read_table(spark, path)
    return back.where(F.col(SEG) == "N").select(*KEYS, "score", SEG)


@query("s2_records_batch", f"""WITH {M_SQL}
SELECT l_returnflag, arg_min(l_extendedprice, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS l_extendedprice,
  arg_min(l_discount, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS l_discount,
  arg_min(l_tax, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS l_tax FROM m GROUP BY l_returnflag""")
def s2_records_batch(spark, sf):
    """A scoring batch given as in-memory records (here each segment's base row, one per
    segment, handed over as Python tuples) becomes a table with a declared schema."""
    base = OR.base_rows(_m(spark, sf).select(*KEYS, SEG, "l_extendedprice", "l_discount", "l_tax"), KEYS, SEG)
    records = [(r[SEG], r["l_extendedprice"], r["l_discount"], r["l_tax"]) for r in base.collect()]
    schema = T.StructType([T.StructField(SEG, T.StringType()), T.StructField("l_extendedprice", T.DoubleType()),
                           T.StructField("l_discount", T.DoubleType()), T.StructField("l_tax", T.DoubleType())])
    return IO.from_records(spark, records, schema)
