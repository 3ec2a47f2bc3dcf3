"""Fitted feature stages (F1-F6, F8-F10) as Spark ML Estimators/Models.

Each ``fit`` is one aggregate over the data (all columns in one pass); the fitted
state is a handful of numbers per column (and per segment when ``segmentCol`` is
set), kept as JSON params so ``Pipeline``/``PipelineModel`` save and load them.
Each ``transform`` emits plain column expressions (or one filter) that stay inside
whole-stage codegen: no joins, no Python on executors.
"""

from __future__ import annotations

import json
import math

from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.operators._small import collect_bounded
from assay.operators.profile import clean, long_form, quantile_frame, skew_expr

MAX_SEGMENTS = 10_000
CASES = 8               # segments up to which a fitted number is looked up by comparison


class _Base(Params):
    inputCols = Param(Params._dummy(), "inputCols", "feature columns", TypeConverters.toListString)
    segmentCol = Param(Params._dummy(), "segmentCol", "fit per segment when set", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "fitted state as JSON", TypeConverters.toString)

    def _kw(self, kwargs):
        return self._set(**{k: v for k, v in kwargs.items() if v is not None})

    def cols(self):
        return self.getOrDefault(self.inputCols)

    def seg(self):
        return self.getOrDefault(self.segmentCol) if self.isSet(self.segmentCol) else None

    def fitted(self):
        return json.loads(self.getOrDefault(self.state))


def _stats_by_segment(df: DataFrame, cols, segment, aggs_for) -> dict:
    """Run one aggregate (per segment when given) and return {segment_or_None: {col: tuple}}."""
    lf = long_form(df, cols, ids=[segment] if segment else [])
    keys = ([segment] if segment else []) + ["feature"]
    parts = aggs_for(F.col("value"))
    out = lf.groupBy(*keys).agg(*[p.alias(f"s{i}") for i, p in enumerate(parts)])
    res: dict = {}
    for r in collect_bounded(out, MAX_SEGMENTS * max(1, len(cols))):
        s = r[segment] if segment else None
        res.setdefault("" if s is None else str(s), {})[r["feature"]] = [r[f"s{i}"] for i in range(len(parts))]
    return res


def _lookup(state: dict, segment: str | None, col: str, i: int) -> Column:
    """Fitted number for ``col`` as a literal, or by segment: cases for a few, a literal map
    for more."""
    if segment is None:
        v = state.get("", {}).get(col)
        return F.lit(None if v is None else v[i]).cast("double")
    known = [(F.lit(s), F.lit(float(d[col][i]))) for s, d in state.items() if col in d and d[col][i] is not None]
    if not known:
        return F.lit(None).cast("double")
    seg = F.col(segment).cast("string")
    if len(known) > CASES:
        return F.element_at(F.create_map(*[x for kv in known for x in kv]), seg)
    case = F
    for s, v in known:
        case = case.when(seg == s, v)
    return case


# --------------------------------------------------------------------------- F1-F3

class OutlierHandler(Estimator, _Base, DefaultParamsReadable, DefaultParamsWritable):
    """F1 clip at Q1-1.5 IQR / Q3+1.5 IQR, F2 remove rows outside, F3 winsorize at 5/95 %.

    ``mode='sequential'`` (F2 only) re-fits each column's quartiles on the rows the
    previous columns kept, as the reference does; ``'joint'`` fits all on the input.
    """
    method = Param(Params._dummy(), "method", "clip | remove | winsorize", TypeConverters.toString)
    mode = Param(Params._dummy(), "mode", "joint | sequential", TypeConverters.toString)
    factor = Param(Params._dummy(), "factor", "IQR multiplier", TypeConverters.toFloat)
    quantileMethod = Param(Params._dummy(), "quantileMethod", "exact | approx", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, method="clip", mode="joint", factor=1.5,
                 segmentCol=None, quantileMethod="exact"):
        super().__init__()
        self._setDefault(method="clip", mode="joint", factor=1.5, quantileMethod="exact")
        self._kw(self._input_kwargs)

    def _fit(self, df: DataFrame):
        method, seg = self.getOrDefault(self.method), self.seg()
        k, qm = self.getOrDefault(self.factor), self.getOrDefault(self.quantileMethod)
        probs = [0.05, 0.95] if method == "winsorize" else [0.25, 0.75]

        def bounds(stats):
            out = {}
            for s, d in stats.items():
                out[s] = {}
                for c, q in d.items():
                    lo, hi = q[0] if q[0] else (None, None)
                    if lo is not None and method != "winsorize":
                        lo, hi = lo - k * (hi - lo), hi + k * (hi - lo)
                    out[s][c] = [lo, hi]
            return out

        def quant(frame, cols):
            lf = long_form(frame, cols, ids=[seg] if seg else [])
            keys = ([seg] if seg else []) + ["feature"]
            rows = collect_bounded(quantile_frame(lf, keys, probs, qm), MAX_SEGMENTS * max(1, len(cols)))
            res: dict = {}
            for r in rows:
                s = r[seg] if seg else None
                res.setdefault("" if s is None else str(s), {})[r["feature"]] = [r["_q"]]
            return res
        if method == "remove" and self.getOrDefault(self.mode) == "sequential":
            state: dict = {}
            cur = df
            for c in self.cols():
                st = bounds(quant(cur, [c]))
                for s, d in st.items():
                    state.setdefault(s, {}).update(d)
                part = OutlierModel(inputCols=[c], method=method, segmentCol=seg, state=json.dumps(st))
                cur = part.transform(cur)
        else:
            state = bounds(quant(df, self.cols()))
        return OutlierModel(inputCols=self.cols(), method=method, segmentCol=seg, state=json.dumps(state))


class OutlierModel(Model, _Base, DefaultParamsReadable, DefaultParamsWritable):
    method = Param(Params._dummy(), "method", "clip | remove | winsorize", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, method="clip", segmentCol=None, state=None):
        super().__init__()
        self._kw(self._input_kwargs)

    def bounds(self):
        return self.fitted()

    def _transform(self, df: DataFrame) -> DataFrame:
        st, seg = self.fitted(), self.seg()
        if self.getOrDefault(self.method) == "remove":
            cond = F.lit(True)
            for c in self.cols():
                x = F.col(c).cast("double")
                lo, hi = _lookup(st, seg, c, 0), _lookup(st, seg, c, 1)
                cond = cond & x.isNotNull() & ~F.isnan(x) & (x >= lo) & (x <= hi)
            return df.where(cond)
        return df.withColumns({c: clip(F.col(c), _lookup(st, seg, c, 0), _lookup(st, seg, c, 1))
                               for c in self.cols()})


def clip(x: Column, lo: Column, hi: Column) -> Column:
    """Clip to [lo, hi]; null and NaN stay as they are; a null bound does not clip.
    Each bound stands once in the expression: the stages' code stays small enough for the
    JVM to compile (methods over 8000 bytes are interpreted)."""
    x = x.cast("double")
    return F.when(x.isNull() | F.isnan(x), x).otherwise(F.least(F.greatest(x, lo), hi))


# --------------------------------------------------------------------------- F4

class SkewTransformer(Estimator, _Base, DefaultParamsReadable, DefaultParamsWritable):
    """bias-corrected skew > 0.5 adds ``<c>_log`` = log1p(c); else > 0.3 adds ``<c>_sqrt``.
    Originals are kept.  The chosen columns are the fitted state (the output schema)."""
    logThreshold = Param(Params._dummy(), "logThreshold", "", TypeConverters.toFloat)
    sqrtThreshold = Param(Params._dummy(), "sqrtThreshold", "", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols=None, logThreshold=0.5, sqrtThreshold=0.3):
        super().__init__()
        self._setDefault(logThreshold=0.5, sqrtThreshold=0.3)
        self._kw(self._input_kwargs)

    def _fit(self, df: DataFrame):
        row = df.agg(*[skew_expr(clean(F.col(c))).alias(c) for c in self.cols()]).first()
        lt, stt = self.getOrDefault(self.logThreshold), self.getOrDefault(self.sqrtThreshold)
        logs = [c for c in self.cols() if row[c] is not None and row[c] > lt]
        sqrts = [c for c in self.cols() if row[c] is not None and lt >= row[c] > stt]
        state = {"skew": {c: row[c] for c in self.cols()}, "log": logs, "sqrt": sqrts}
        return SkewModel(inputCols=self.cols(), state=json.dumps(state))


class SkewModel(Model, _Base, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, state=None):
        super().__init__()
        self._kw(self._input_kwargs)

    def outputCols(self):
        st = self.fitted()
        return [f"{c}_log" for c in st["log"]] + [f"{c}_sqrt" for c in st["sqrt"]]

    def _transform(self, df):
        st = self.fitted()
        new = {f"{c}_log": F.log1p(F.col(c).cast("double")) for c in st["log"]}
        new.update({f"{c}_sqrt": F.sqrt(F.col(c).cast("double")) for c in st["sqrt"]})
        return df.withColumns(new) if new else df


# --------------------------------------------------------------------------- F5, F6

class ColumnScaler(Estimator, _Base, DefaultParamsReadable, DefaultParamsWritable):
    """F5 ``standard``: (x - mean) / population std, constant columns divide by 1.
    F6 ``minmax``: (x - min) / (max - min), constant columns give 0.  In place."""
    kind = Param(Params._dummy(), "kind", "standard | minmax", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, kind="standard", segmentCol=None):
        super().__init__()
        self._setDefault(kind="standard")
        self._kw(self._input_kwargs)

    def _fit(self, df):
        if self.getOrDefault(self.kind) == "standard":
            def agg(v):
                return [F.avg(v), F.stddev_pop(v)]
        else:
            def agg(v):
                return [F.min(v), F.max(v)]
        st = _stats_by_segment(df, self.cols(), self.seg(), agg)
        return ScalerModel(inputCols=self.cols(), kind=self.getOrDefault(self.kind),
                           segmentCol=self.seg(), state=json.dumps(st))


class ScalerModel(Model, _Base, DefaultParamsReadable, DefaultParamsWritable):
    kind = Param(Params._dummy(), "kind", "standard | minmax", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, kind="standard", segmentCol=None, state=None):
        super().__init__()
        self._kw(self._input_kwargs)

    def _transform(self, df):
        st, seg = self.fitted(), self.seg()
        out = {}
        for c in self.cols():
            a, b = _lookup(st, seg, c, 0), _lookup(st, seg, c, 1)
            x = F.col(c).cast("double")
            if self.getOrDefault(self.kind) == "standard":
                out[c] = (x - a) / F.when(b == 0, F.lit(1.0)).otherwise(b)
            else:
                out[c] = F.when(b - a == 0, F.lit(0.0)).otherwise((x - a) / (b - a))
        return df.withColumns(out)


# --------------------------------------------------------------------------- P2, P3, P9, P10 as stages

class DerivedRatios(Transformer, _Base, DefaultParamsReadable, DefaultParamsWritable):
    """P2 as a stage; ``roles`` maps a, b, s, f, t, h, d to column names."""
    roles = Param(Params._dummy(), "roles", "JSON role -> column", TypeConverters.toString)

    @keyword_only
    def __init__(self, roles=None):
        super().__init__()
        if isinstance(self._input_kwargs.get("roles"), dict):
            self._input_kwargs["roles"] = json.dumps(self._input_kwargs["roles"])
        self._kw(self._input_kwargs)

    def _transform(self, df):
        from assay.functions.scalar import derived_ratios
        return df.withColumns(derived_ratios(**json.loads(self.getOrDefault(self.roles))))


class ScoreClasses(Transformer, _Base, DefaultParamsReadable, DefaultParamsWritable):
    """P9/P10 as a stage: ``<score>_binary`` and ``<score>_multiclass`` (two columns, quirk Q1)."""
    scoreCol = Param(Params._dummy(), "scoreCol", "", TypeConverters.toString)

    @keyword_only
    def __init__(self, scoreCol="score"):
        super().__init__()
        self._setDefault(scoreCol="score")
        self._kw(self._input_kwargs)

    def _transform(self, df):
        from assay.functions.scalar import binary_class, multiclass
        s = self.getOrDefault(self.scoreCol)
        return df.withColumns({"quality_binary": binary_class(F.col(s)),
                               "quality_multiclass": multiclass(F.col(s))})


class SegmentRecode(Transformer, _Base, DefaultParamsReadable, DefaultParamsWritable):
    """P3 as a stage: dictionary recode, unmapped -> null."""
    mapping = Param(Params._dummy(), "mapping", "JSON value -> code", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "", TypeConverters.toString)

    @keyword_only
    def __init__(self, segmentCol=None, mapping=None, outputCol="segment_numeric"):
        super().__init__()
        if isinstance(self._input_kwargs.get("mapping"), dict):
            self._input_kwargs["mapping"] = json.dumps(self._input_kwargs["mapping"])
        self._setDefault(outputCol="segment_numeric")
        self._kw(self._input_kwargs)

    def _transform(self, df):
        from assay.functions.scalar import recode
        return df.withColumn(self.getOrDefault(self.outputCol),
                             recode(F.col(self.seg()), json.loads(self.getOrDefault(self.mapping))))


class FillNulls(Transformer, _Base, DefaultParamsReadable, DefaultParamsWritable):
    """Null features score as ``value`` (the zero-denominator ratios), as in training."""
    value = Param(Params._dummy(), "value", "", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, inputCols=None, value=0.0):
        super().__init__()
        self._setDefault(value=0.0)
        self._kw(self._input_kwargs)

    def _transform(self, df):
        return df.fillna(self.getOrDefault(self.value), subset=self.cols())


# --------------------------------------------------------------------------- F8, F9 scores

def f_regression_scores(df: DataFrame, features, target: str) -> DataFrame:
    """F8: univariate F statistic F = r^2 / (1 - r^2) * (n - 2), all features in one pass."""
    y = F.col(target).cast("double")
    lf = long_form(df, features, ids=[target]).where(F.col("value").isNotNull() & y.isNotNull())
    r = F.corr(F.col("value"), y)
    n = F.count(F.lit(1))
    return (lf.groupBy("feature").agg(r.alias("r"), n.alias("n"))
            .select("feature", F.try_divide(F.col("r") * F.col("r") * (F.col("n") - 2),
                                            1 - F.col("r") * F.col("r")).alias("score")))


def mutual_info_scores(df: DataFrame, features, target: str, bins: int = 10) -> DataFrame:
    """F9 (re-aimed): MI between equal-frequency bins of each feature and the target class,
    in nats, from joint counts.  The bin edges are fitted quantiles (exact by default)."""
    probs = [i / bins for i in range(1, bins)]
    edges = collect_bounded(quantile_frame(long_form(df, features), ["feature"], probs), 10_000)
    edge_map = {r["feature"]: r["_q"] for r in edges}
    lf = long_form(df, features, ids=[target]).where(F.col("value").isNotNull() & F.col(target).isNotNull())
    bin_expr = F.lit(0)
    for f in features:
        e = sorted(set(edge_map.get(f) or []))
        b = sum((F.col("value") > F.lit(x)).cast("int") for x in e) if e else F.lit(0)
        bin_expr = F.when(F.col("feature") == f, b).otherwise(bin_expr)
    j = lf.select("feature", bin_expr.alias("bx"), F.col(target).alias("y"))
    joint = j.groupBy("feature", "bx", "y").agg(F.count(F.lit(1)).alias("nxy"))
    from pyspark.sql.window import Window
    wf = Window.partitionBy("feature")
    joint = (joint.withColumn("n", F.sum("nxy").over(wf))
             .withColumn("nx", F.sum("nxy").over(Window.partitionBy("feature", "bx")))
             .withColumn("ny", F.sum("nxy").over(Window.partitionBy("feature", "y"))))
    term = F.col("nxy") / F.col("n") * F.log(F.col("nxy") * F.col("n") / (F.col("nx") * F.col("ny")))
    return joint.groupBy("feature").agg(F.sum(term).alias("score"))


def top_k(scores: DataFrame, k: int, score: str = "score", name: str = "feature") -> DataFrame:
    """O1 over a score table; ties broken by name; k capped at the number of rows."""
    return scores.orderBy(F.desc_nulls_last(score), F.asc(name)).limit(k)


class KBestSelector(Estimator, _Base, DefaultParamsReadable, DefaultParamsWritable):
    """F7/F8/F9 as a stage: keeps the k best features by ``method``; stores names + scores."""
    method = Param(Params._dummy(), "method", "f_regression | mutual_info | random_forest",
                   TypeConverters.toString)
    k = Param(Params._dummy(), "k", "", TypeConverters.toInt)
    labelCol = Param(Params._dummy(), "labelCol", "", TypeConverters.toString)

    @keyword_only
    def __init__(self, inputCols=None, labelCol=None, method="f_regression", k=10):
        super().__init__()
        self._setDefault(method="f_regression", k=10)
        self._kw(self._input_kwargs)

    def _fit(self, df):
        m, label = self.getOrDefault(self.method), self.getOrDefault(self.labelCol)
        if m == "f_regression":
            sc = f_regression_scores(df, self.cols(), label)
        elif m == "mutual_info":
            sc = mutual_info_scores(df, self.cols(), label)
        elif m == "random_forest":
            from assay.operators.learners import forest_importances
            sc = forest_importances(df, self.cols(), label)
        else:
            raise ValueError(f"unknown selection method {m}")
        rows = top_k(sc, min(self.getOrDefault(self.k), len(self.cols()))).collect()
        state = {"selected": [r["feature"] for r in rows], "scores": {r["feature"]: r["score"] for r in rows}}
        return KBestModel(inputCols=self.cols(), state=json.dumps(state))


class KBestModel(Model, _Base, DefaultParamsReadable, DefaultParamsWritable):
    @keyword_only
    def __init__(self, inputCols=None, state=None):
        super().__init__()
        self._kw(self._input_kwargs)

    def selected(self):
        return self.fitted()["selected"]

    def _transform(self, df):
        keep = set(self.selected())
        return df.drop(*[c for c in self.cols() if c not in keep])


# --------------------------------------------------------------------------- F10

def pca_components(df: DataFrame, features, variance: float = 0.95, k: int | None = None):
    """standardize (population std), PCA on all components, keep the least k whose
    cumulative explained-variance ratio exceeds ``variance``.  Returns (fitted scaler+PCA
    pipeline, k, cumulative ratio).  The covariance is one distributed aggregate (d x d)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import PCA, VectorAssembler

    features = list(features)
    scaler = ColumnScaler(inputCols=features, kind="standard")
    asm = VectorAssembler(inputCols=features, outputCol="_x", handleInvalid="keep")
    full = PCA(k=len(features), inputCol="_x", outputCol="_pc_all")
    pm = Pipeline(stages=[scaler, asm, full]).fit(df)
    ev = list(pm.stages[-1].explainedVariance)
    cum, kk = 0.0, 0
    for v in ev:
        cum += v
        kk += 1
        if k is None and cum > variance:
            break
    if k is not None:
        kk, cum = k, sum(ev[:k])
    return pm, kk, cum


def pca_project(pm, df: DataFrame, k: int, keep=()) -> DataFrame:
    """Project onto the first k components as columns PC1..PCk (signs: largest |loading| positive)."""
    from pyspark.ml.functions import vector_to_array
    pcs = pm.stages[-1].pc.toArray()
    signs = [1.0 if pcs[abs(pcs[:, j]).argmax(), j] >= 0 else -1.0 for j in range(pcs.shape[1])]
    out = pm.transform(df).withColumn("_arr", vector_to_array("_pc_all"))
    return out.select(*keep, *[(F.col("_arr")[j] * signs[j]).alias(f"PC{j + 1}") for j in range(k)])
