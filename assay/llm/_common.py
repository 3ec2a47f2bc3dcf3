"""Helpers shared by the training-data operators: reading, column-appending Arrow maps,
lineage cuts in the shared folder and a Counter-like grouping of sorted runs."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.session import checkpoint_dir, scratch_path, ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` under ``name`` with optional oracle SQL."""
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def col(name: str):
    """Column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the reread table, so that later
    passes neither recompute it nor depend on one executor's disk."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_BYTES = 16 * 1024 * 1024


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, after lowering the session's Arrow batch size to ``BATCH_BYTES``: long texts
    reach a worker a few at a time, and the buffers on both sides stay small.  Also makes
    sure that the workers have this package."""
    ship_package(df.sparkSession)
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    now = conf.get(key, "64MB").upper()
    number = int("".join(c for c in now if c.isdigit()) or 0)
    unit = {"K": 1 << 10, "M": 1 << 20, "G": 1 << 30}.get("".join(c for c in now if c.isalpha())[:1], 1)
    if number * unit > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))
    return df


def append_columns(df: DataFrame, inputs: list[str], out: T.StructType,
                   factory: Callable[[], Callable], keep: list[str] | None = None) -> DataFrame:
    """Append computed columns with an Arrow map that streams batch by batch.

    ``factory()`` runs once per task and returns ``f(list of Arrow input arrays) ->
    list of Arrow output arrays``.  ``keep`` names the columns carried along (default:
    all).  A carried column whose name equals an output column (in any case) gives way
    to the output, as with ``withColumn``.
    """
    taken = {n.lower() for n in out.names}
    keep = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    src = df.select(*[col(c).alias(f"_k{i}") for i, c in enumerate(keep)],
                    *[col(c).alias(f"_x{i}") for i, c in enumerate(inputs)])
    schema = T.StructType([T.StructField(c, df.schema[c].dataType, True) for c in keep] + list(out.fields))
    n_keep, types = len(keep), [arrow_type(f.dataType) for f in out.fields]
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = factory()
        for b in batches:
            if b.num_rows == 0:
                continue
            res = f([b.column(i) for i in range(n_keep, b.num_columns)])
            res = [a if isinstance(a, pa.Array) and a.type == t else pa.array(a, type=t)
                   for a, t in zip(res, types)]
            yield pa.RecordBatch.from_arrays([b.column(i) for i in range(n_keep)] + res, names=names)

    return small_batches(src).mapInArrow(run, schema)


def decoded(column: pa.Array) -> list[str | None]:
    """Texts of an Arrow column; invalid UTF-8 reads as U+FFFD."""
    try:
        return column.to_pylist()
    except UnicodeDecodeError:
        return [None if b is None else b.decode("utf-8", "replace") for b in column.cast(pa.binary()).to_pylist()]


def arrow_type(t: T.DataType) -> pa.DataType:
    """Arrow type of a Spark type used in an operator's output."""
    if isinstance(t, T.ArrayType):
        return pa.list_(arrow_type(t.elementType))
    if isinstance(t, T.StructType):
        return pa.struct([(f.name, arrow_type(f.dataType)) for f in t.fields])
    return {T.LongType: pa.int64(), T.IntegerType: pa.int32(), T.DoubleType: pa.float64(),
            T.FloatType: pa.float32(), T.StringType: pa.string(), T.BinaryType: pa.binary(),
            T.BooleanType: pa.bool_()}[type(t)]


_HELD: dict = {}


def held(key, make: Callable):
    """A worker process's one large helper (tables, tokenizer): made once per key and kept
    between tasks; another key's takes its place, so that workers that serve several
    operators hold one at a time."""
    if key not in _HELD:
        release()
        _HELD[key] = make()
    return _HELD[key]


def release() -> None:
    """Drop the held helper; for operators that need none."""
    if _HELD:
        _HELD.clear()
        gc.collect()


class RecentWords:
    """Bytes made once per word while the word keeps coming up.

    Two generations of at most about ``limit`` words: a full young one becomes the old one,
    and words found there move to the new young one.  Words over ``longest`` characters are
    made each time, so memory is bounded whatever the texts hold.
    """

    def __init__(self, make: Callable[[str], bytes], limit: int, longest: int = 64):
        self.make, self.limit, self.longest = make, limit, longest
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def join(self, words: list[str]) -> bytes:
        young = self.young
        try:
            return b"".join(map(young.__getitem__, words))
        except KeyError:
            pass
        if len(young) > self.limit:
            self.old, self.young = young, {}
            young = self.young
        new = set(words).difference(young)
        for w in new:
            made = self.old.get(w)
            young[w] = self.make(w) if made is None else made
        out = b"".join(map(young.__getitem__, words))
        for w in new:
            if len(w) > self.longest:
                del young[w]
        return out


def tokenizer_path(file: str) -> str:
    """Place of an installed public vocabulary file (the same on every machine)."""
    import public_tokenizers
    return public_tokenizers.path(file)


__all__ = ["QUERIES", "ORACLE", "RecentWords", "register", "table", "col", "cut", "written", "append_columns",
           "arrow_type", "decoded", "held", "release", "small_batches", "tokenizer_path"]
