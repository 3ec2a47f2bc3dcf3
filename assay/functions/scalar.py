"""Scalar column functions (P1-P24).  All are JVM-side expressions (codegen), no UDFs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def tag(df: DataFrame, column: str, value) -> DataFrame:
    """Constant tag column."""
    return df.withColumn(column, F.lit(value))


DERIVED_NAMES = ["total_acidity", "acidity_to_sugar", "free_to_total_so2_ratio", "alcohol_to_acidity",
                 "sugar_to_alcohol", "balance_score", "body_score"]


def derived_ratios(a: str, b: str, s: str, f: str, t: str, h: str, d: str) -> dict[str, Column]:
    """The seven derived features from role columns.

    a, b: the two parts of the total (total_acidity = a + b); s: the sugar-like
    denominator; f / t: part and total of the free/total ratio; h: the numerator of
    the strength ratios; d: the density-like column.  Denominators carry +1 except
    balance_score, which can divide by zero (s = 0 or a + b = 0): that gives null.
    """
    A, B, S, Fr, Tt, H, D = (F.col(c).cast("double") for c in (a, b, s, f, t, h, d))
    total = A + B
    return {
        "total_acidity": total,
        "acidity_to_sugar": total / (S + 1),
        "free_to_total_so2_ratio": Fr / (Tt + 1),
        "alcohol_to_acidity": H / (total + 1),
        "sugar_to_alcohol": S / (H + 1),
        "balance_score": F.try_divide(H, total * F.log1p(S)),
        "body_score": H * (1 - (D - 0.9)),
    }


def recode(c: Column, mapping: dict) -> Column:
    """Dictionary recode, unmapped values give null."""
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.element_at(F.create_map(*kv), c.cast("string"))


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    """Numeric columns by type minus a name list (schema walk, no data read)."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, T.NumericType) and f.name not in set(exclude)]


TARGETS = {"regression": "score", "binary": "quality_binary", "multiclass": "quality_multiclass"}


def prepare(df: DataFrame, task: str, drop=(), targets: dict | None = None):
    """P5: features and target for a task; absent columns in ``drop`` are ignored;
    unknown task raises.  Returns (frame with features + target, feature names, target)."""
    targets = targets or TARGETS
    if task not in targets:
        raise ValueError(f"unknown task {task!r}; expected one of {sorted(targets)}")
    target = targets[task]
    gone = set(drop) | set(targets.values())
    feats = [c for c in numeric_columns(df) if c not in gone]
    return df.select(*feats, target), feats, target


def in_range(c: Column, lo, hi) -> Column:
    """Inside [lo, hi]; null or NaN is outside."""
    x = c.cast("double")
    return x.isNotNull() & ~F.isnan(x) & (x >= F.lit(lo)) & (x <= F.lit(hi))


def binary_class(score: Column, cut: int = 6) -> Column:
    """1 when score >= cut."""
    return (score >= cut).cast("int")


def multiclass(score: Column) -> Column:
    """P10: right-closed bins [0,4] -> 0, (4,6] -> 1, (6,10] -> 2; outside -> null."""
    return (F.when((score >= 0) & (score <= 4), 0).when((score > 4) & (score <= 6), 1)
            .when((score > 6) & (score <= 10), 2).cast("int"))


def serving_transforms(columns, eps: float = 1e-5) -> dict[str, Column]:
    """Unconditional ``_log`` = log1p(c + eps) and ``_sqrt`` = sqrt(c + eps)."""
    out = {}
    for c in columns:
        x = F.col(c).cast("double") + eps
        out[f"{c}_log"] = F.log1p(x)
        out[f"{c}_sqrt"] = F.sqrt(x)
    return out


def round_half(x: Column) -> Column:
    """Nearest 0.5, ties to even (5.25 -> 5.0, 5.75 -> 6.0)."""
    return F.bround(x.cast("double") * 2, 0) / 2


LABELS_2 = ["Bad", "Good"]
LABELS_3 = ["Bad", "Average", "Good"]


def decode(idx: Column, labels) -> Column:
    """Class index to label (null when out of range)."""
    return F.when((idx >= 0) & (idx < len(labels)),
                  F.array(*[F.lit(s) for s in labels])[idx.cast("int")])


def probability_columns(prob: Column, names) -> dict[str, Column]:
    """Split a probability vector into named columns."""
    from pyspark.ml.functions import vector_to_array
    arr = vector_to_array(prob)
    return {n: arr[i] for i, n in enumerate(names)}


def conform(df: DataFrame, expected, fill: float = 0.0):
    """Missing expected columns as ``fill``, extras dropped, expected order.
    Returns (frame, missing names, extra names); the name lists come from the schema."""
    have = set(df.columns)
    missing = [c for c in expected if c not in have]
    extra = [c for c in df.columns if c not in set(expected)]
    cols = [F.col(c).cast("double").alias(c) if c in have else F.lit(fill).cast("double").alias(c)
            for c in expected]
    return df.select(*cols), missing, extra


def as_string(c: Column) -> Column:
    """P16."""
    return c.cast("string")


RANGE_PATTERN = r"(\d+(?:\.\d+)?)\s*-\s*(\d+(?:\.\d+)?)"


def parse_range(text: Column) -> tuple[Column, Column]:
    """First 'lo-hi' numeric range in the text as two doubles; null on failure."""
    lo = F.regexp_extract(text, RANGE_PATTERN, 1)
    hi = F.regexp_extract(text, RANGE_PATTERN, 2)
    return (F.when(lo != "", lo.try_cast("double")), F.when(hi != "", hi.try_cast("double")))


def format_list(arr: Column, empty: str = "None") -> Column:
    """Numbers to 2 decimals joined by ', '; ``empty`` for an empty or null list."""
    s = F.array_join(F.transform(arr, lambda v: F.format_string("%.2f", v)), ", ")
    return F.when(F.coalesce(F.size(arr), F.lit(0)) > 0, s).otherwise(F.lit(empty))


#: Default recommendation texts by expected-effect category; callers pass their own domain's.
RECOMMENDATION = {
    "positive": "Raising this measurement tends to raise the score.",
    "negative": "Lowering this measurement tends to raise the score.",
    "optimal range": "Scores are best between two bounds of this measurement.",
}
RECOMMENDATION_OTHER = "The effect of this measurement depends on the others."


def recommendation(effect: Column, texts: dict[str, str] | None = None, other: str = RECOMMENDATION_OTHER) -> Column:
    """Recommendation text by effect category."""
    out = F.lit(other)
    for k, v in reversed(list((RECOMMENDATION if texts is None else texts).items())):
        out = F.when(effect == k, F.lit(v)).otherwise(out)
    return out


def verdict(nearest: Column, domain: Column, has_candidates: Column,
            tolerance_pct: float = 15.0) -> tuple[Column, Column]:
    """P20: percent difference of the nearest detected threshold from the domain value and
    the verdict: 'match' below ``tolerance_pct``, else 'differs'; 'none detected' when the
    model found nothing; 'no reference' / 'nothing detected' without a domain value."""
    pct = F.abs(F.try_divide(F.abs(nearest - domain), domain) * 100)
    v = (F.when(domain.isNull(), F.when(has_candidates, "no reference").otherwise("nothing detected"))
         .when(~has_candidates, "none detected")
         .when(pct < tolerance_pct, "match").otherwise("differs"))
    return pct, v


def confidence(prob: Column) -> Column:
    """Largest class probability."""
    from pyspark.ml.functions import vector_to_array
    return F.array_max(vector_to_array(prob))


def range_flags(x: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    """(inside valid range, value clamped into it)."""
    inside = x.isNotNull() & (x >= lo) & (x <= hi)
    clamped = F.when(x.isNull(), x).otherwise(F.least(F.greatest(x, lo), hi))
    return inside, clamped


def jitter(c: Column, seed: int = 42, scale: float = 0.1) -> Column:
    """Add N(0, scale) noise (seeded; repeatable for a fixed partitioning)."""
    return c.cast("double") + F.randn(seed) * scale
