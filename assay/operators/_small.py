"""Joining a small per-group table onto a large one, broadcast only when proven small."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.session import checkpoint_dir

#: Above this many bytes (as JSON text) a per-group side is joined by shuffle, not broadcast.
BROADCAST_BYTES = 16 * 1024 * 1024
COLLECT_ROWS = 100_000


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once, its lineage cut by a checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def small_enough(df: DataFrame, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Whether all rows together, written as JSON, stay below ``max_bytes``."""
    size = df.agg(F.sum(F.length(F.to_json(F.struct("*"))))).first()[0]
    return (size or 0) <= max_bytes


def attach(big: DataFrame, small: DataFrame, on, how: str = "inner", max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Join ``small`` (an aggregate over ``big``'s groups) onto ``big``.

    The small side is computed once and measured; it is broadcast only when its measured
    size proves it small.  Otherwise the planner (with AQE) picks a shuffle join.
    """
    small = settled(small)
    return big.join(F.broadcast(small) if small_enough(small, max_bytes) else small, on, how)


def collect_bounded(df: DataFrame, max_rows: int = COLLECT_ROWS):
    """Collect a result that must be small (fitted statistics); refuse otherwise."""
    rows = df.limit(max_rows + 1).collect()
    if len(rows) > max_rows:
        raise ValueError(f"expected at most {max_rows} rows of fitted state, got more")
    return rows
