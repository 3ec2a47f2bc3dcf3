"""Vector helpers of the two embedding operators."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F


def usable(vector):
    """True for a vector that has a direction: not null, all components finite, one not
    zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(F.exists(vector, lambda x: x != 0) & ~bad, F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of an Arrow list column of equal lengths as a matrix of its own type."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length one; scaling by the largest component first keeps tiny and
    huge vectors in range."""
    x = x.astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def dots(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Dot products of rows a[i] and b[j] in double precision, one component after the
    other, so that equal pairs give equal values wherever they stand."""
    out = np.zeros(len(i))
    for d in range(a.shape[1]):
        out += a[i, d].astype(np.float64) * b[j, d].astype(np.float64)
    return out


def cosines(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Cosine of rows a[i] and b[j] of the original vectors, in double precision."""
    ones = np.arange(len(a)), np.arange(len(b))
    na, nb = np.sqrt(dots(a, ones[0], a, ones[0])), np.sqrt(dots(b, ones[1], b, ones[1]))
    out = dots(a, i, b, j) / (na[i] * nb[j])
    odd = ~np.isfinite(out) | (na[i] * nb[j] < 1e-200)
    if odd.any():       # squares left the range of doubles
        ua, ub = unit(a), unit(b)
        out[odd] = dots(ua, i[odd], ub, j[odd])
    return out
