"""Registry of named queries, each with its DuckDB oracle statement when SQL can state it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with optional oracle SQL."""
    def deco(fn):
        if name in QUERIES:
            raise KeyError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = expand_round(sql.strip())
        return fn
    return deco


SIG = 9  # significant digits kept on both sides of a T check
ROUNDING = True  # bench.py turns it off: rounding serves the comparison, not the query


def sig_round(c):
    """Round to ``SIG`` significant digits: exact decimal ties of short-decimal data sit
    far below the last kept digit, and the scale is a power of ten both engines compute
    exactly (the exponent is applied by multiplying or dividing, never negative)."""
    c = c.cast("double")
    e = F.lit(SIG - 1) - F.floor(F.log10(F.abs(c)))
    up = F.round(c * F.pow(F.lit(10.0), e), 0) / F.pow(F.lit(10.0), e)
    down = F.round(c / F.pow(F.lit(10.0), -e), 0) * F.pow(F.lit(10.0), -e)
    return F.when(c.isNull() | F.isnan(c) | (c == 0) | F.abs(c).isin(float("inf")), c) \
        .when(e >= 0, up).otherwise(down)


def rounded(df: DataFrame, absolute: dict | None = None) -> DataFrame:
    """Round every floating column (both sides of a T check round the same way).
    ``absolute`` maps columns that are differences near zero to a count of decimals."""
    if not ROUNDING:
        return df
    absolute = absolute or {}
    out = []
    for f in df.schema.fields:
        if f.name in absolute:
            out.append(F.round(F.col(f.name).cast("double"), absolute[f.name]).alias(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            out.append(sig_round(F.col(f.name)).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def sig_sql(x: str) -> str:
    """SQL twin of ``sig_round``."""
    e = f"({SIG - 1} - FLOOR(LOG10(ABS(CAST({x} AS DOUBLE)))))"
    return (f"(CASE WHEN ({x}) IS NULL OR ({x}) = 0 OR isnan({x}) OR isinf({x}) THEN CAST({x} AS DOUBLE) "
            f"WHEN {e} >= 0 THEN ROUND(CAST({x} AS DOUBLE) * POW(10.0, {e}), 0) / POW(10.0, {e}) "
            f"ELSE ROUND(CAST({x} AS DOUBLE) / POW(10.0, -{e}), 0) * POW(10.0, -{e}) END)")


def expand_round(sql: str) -> str:
    """Template helper: every ``ROUND(expr, 6)`` in an oracle text becomes ``sig_sql(expr)``."""
    out, i, key = [], 0, "ROUND("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k, comma = 1, j + len(key), -1
        while depth:
            ch = sql[k]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = k
            k += 1
        digits = sql[comma + 1:k - 1].strip() if comma > 0 else ""
        out.append(sql[i:j])
        if digits == "6":
            out.append(sig_sql(expand_round(sql[j + len(key):comma])))
        else:
            out.append(key + expand_round(sql[j + len(key):k]))
        i = k


def sql_long(src: str, features, ids=(), value_sql: str = "CAST({f} AS DOUBLE)") -> str:
    """SQL twin of ``profile.long_form``: UNION ALL of one select per feature (NaN -> NULL)."""
    parts = []
    for f in features:
        v = value_sql.format(f=f)
        idc = "".join(f"{i}, " for i in ids)
        parts.append(f"SELECT {idc}'{f}' AS feature, CASE WHEN isnan({v}) THEN NULL ELSE {v} END AS value FROM {src}")
    return "\nUNION ALL ".join(parts)


def seg_label(seg: str) -> str:
    return f"CASE WHEN GROUPING({seg}) = 1 THEN 'all' ELSE CAST({seg} AS VARCHAR) END AS segment"
