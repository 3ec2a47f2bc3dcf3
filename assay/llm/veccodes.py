"""Vector codes: each part of a vector becomes the index of its codebook's nearest entry.

Components x become the integers floor(scale * x); a vector is cut into consecutive parts
and each part position has a codebook, trained by rounds of assignment and integer means.
The nearest entry is found through a GNAT over the codebook (``gnat.Gnat``), exactly.

One round is one scan: every task assigns its rows and sends one row of count and sums per
entry it used, which Spark adds up; only the codebooks (entries x components numbers) reach
the driver and travel back to the tasks.  Vectors are never shuffled.

Edge cases: vectors that are null or hold a null or non-finite component are dropped; rows
with a null id are encoded but never start a codebook; repeated ids count as rows, in the
order of their vectors.  Vectors of different lengths have codebooks of their own, per
length; where the parts cannot be equal the first ones are longer by one, and a part
without components has code 0 and error 0.  Fewer rows than entries give a smaller
codebook.  Integers are held between -2^50 and 2^50; an error over 2^63 - 1 is given as
2^63 - 1.  An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm._common import append_columns, col, small_batches, written
from assay.llm.gnat import Gnat, exact_limit
from assay.operators._small import attach, collect_bounded

PARTS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
MOST = 1 << 50                  # integers beyond are held at it
LONG_MAX = (1 << 63) - 1
MAX_LENGTHS = 1_000             # different vector lengths; an error beyond
BATCH = 8_192

SUMS = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("part", T.IntegerType()),
                     T.StructField("entry", T.IntegerType()), T.StructField("n", T.LongType()),
                     T.StructField("sums", T.ArrayType(T.DecimalType(38, 0)))])


def integers(x: np.ndarray, scale: int) -> np.ndarray:
    """floor(scale * x), held between -MOST and MOST, as doubles (all are whole numbers)."""
    with np.errstate(over="ignore"):
        return np.clip(np.floor(x.astype(np.float64) * scale), -MOST, MOST)


def bounds(dim: int, parts: int) -> list[tuple[int, int]]:
    """First and last component (exclusive) of each part."""
    short, longer = divmod(dim, parts)
    at = [i * short + min(i, longer) for i in range(parts + 1)]
    return list(zip(at, at[1:]))


class Codebooks:
    """Codebooks per vector length: ``books[dim][part]`` is a matrix of integers (object)."""

    def __init__(self, books: dict[int, list[np.ndarray]], parts: int, scale: int):
        self.books, self.parts, self.scale = books, parts, scale

    def digest(self, dim: int) -> str:
        """SHA-256 of all components in decimal by part, entry and position, joined by commas."""
        numbers = (str(int(x)) for book in self.books[dim] for row in book for x in row)
        return hashlib.sha256(",".join(numbers).encode()).hexdigest()

    def coder(self):
        """``f(matrix of integers) -> (codes, errors)``, one tree per part and number form."""
        trees: dict[tuple, Gnat] = {}

        def code(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            dim = x.shape[1]
            codes = np.zeros((len(x), self.parts), dtype=np.int64)
            errors = np.zeros((len(x), self.parts), dtype=object)
            for p, (a, b) in enumerate(bounds(dim, self.parts)):
                if a == b:
                    continue
                part, book = x[:, a:b], self.books[dim][p]
                limit = exact_limit(b - a)
                plain = np.abs(part).max(1) <= limit
                if np.abs(book).max() > limit:
                    plain[:] = False
                for form, rows in ((np.float64, np.flatnonzero(plain)), (object, np.flatnonzero(~plain))):
                    if not len(rows):
                        continue
                    key = (dim, p, form)
                    if key not in trees:
                        trees[key] = Gnat(book.astype(form))
                    q = part[rows] if form is np.float64 else whole(part[rows])
                    found, d2 = trees[key].nearest(q)
                    codes[rows, p] = found
                    errors[rows, p] = d2.astype(np.int64).astype(object) if form is np.float64 else d2
            return codes, errors
        return code


def whole(x: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python integers."""
    return x.astype(np.int64).astype(object)


def by_length(column: pa.Array):
    """``(rows, matrix)`` per vector length of an Arrow list column without nulls, in
    bounded pieces."""
    sizes = column.value_lengths().to_numpy(zero_copy_only=False)
    for dim in np.unique(sizes):
        rows = np.flatnonzero(sizes == dim)
        for a in range(0, len(rows), BATCH):
            some = rows[a:a + BATCH]
            flat = column.take(pa.array(some)).flatten().to_numpy(zero_copy_only=False)
            yield some, flat.reshape(len(some), int(dim))


def finite(vector):
    """True for a vector that is not null and has finite components only (or none)."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad, F.lit(False))


def _sums(vectors: DataFrame, books: Codebooks) -> DataFrame:
    """Count and component sums of the parts assigned to every entry, per task."""
    types = pa.struct([("dim", pa.int32()), ("part", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()),
                       ("sums", pa.list_(pa.decimal128(38, 0)))])
    parts, scale = books.parts, books.scale

    def run(batches):
        code, counts, sums = books.coder(), {}, {}
        for batch in batches:
            for _, raw in by_length(batch.column(0)):
                x = integers(raw, scale)
                codes, _ = code(x)
                dim = x.shape[1]
                for p, (a, b) in enumerate(bounds(dim, parts)):
                    if a == b:
                        continue
                    order = np.argsort(codes[:, p], kind="stable")
                    used, first, n = np.unique(codes[order, p], return_index=True, return_counts=True)
                    added = np.add.reduceat(x[order, a:b].astype(np.int64), first, axis=0) \
                        if np.abs(x[:, a:b]).max() < 1 << 49 else np.add.reduceat(whole(x[order, a:b]), first, axis=0)
                    for e, k, s in zip(used.tolist(), n.tolist(), added.tolist()):
                        at = (dim, p, e)
                        counts[at] = counts.get(at, 0) + k
                        old = sums.get(at)
                        sums[at] = s if old is None else [u + v for u, v in zip(old, s)]
        rows = [{"dim": d, "part": p, "entry": e, "n": counts[d, p, e], "sums": [Decimal(v) for v in s]}
                for (d, p, e), s in sums.items()]
        if rows:
            yield pa.RecordBatch.from_struct_array(pa.array(rows, type=types))

    return small_batches(vectors.select("v")).mapInArrow(run, SUMS)


def train(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", parts: int = PARTS,
          entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> Codebooks:
    """Codebooks that start as the parts of the smallest ids' vectors; each round assigns
    every part to its nearest entry, then moves each used entry to floor(sum / count)."""
    rows = vectors.select(col(id_col).alias("id"), col(vector_col).alias("v")).where(finite(F.col("v")))
    dims = [r[0] for r in collect_bounded(rows.groupBy(F.size("v").alias("d")).count(), MAX_LENGTHS)]
    books = {}
    for dim in sorted(dims):
        first = rows.where((F.size("v") == dim) & F.col("id").isNotNull()).orderBy("id", "v").limit(entries).collect()
        x = integers(np.array([r["v"] for r in first], dtype=np.float64).reshape(len(first), dim), scale)
        if len(first):
            books[dim] = [whole(x[:, a:b]) for a, b in bounds(dim, parts)]
    out = Codebooks(books, parts, scale)
    known = rows.where(F.size("v").isin(list(books))) if books else rows.limit(0)
    for _ in range(rounds if any(books) else 0):
        moved = _sums(known, out).select("dim", "part", "entry", "n", F.posexplode("sums").alias("at", "s")) \
            .groupBy("dim", "part", "entry", "at").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        total = sum(d for d in books) * entries
        new = {d: [b.copy() for b in book] for d, book in books.items()}
        for r in collect_bounded(moved, max(1, total)):
            new[r["dim"]][r["part"]][r["entry"], r["at"]] = int(r["s"]) // r["n"]
        books = new
        out = Codebooks(books, parts, scale)
    return out


def encode(vectors: DataFrame, books: Codebooks, vector_col: str = "embedding") -> DataFrame:
    """``vectors`` without those that have no code, plus ``codes`` (entry index per part),
    ``error`` (squared distances summed over the parts) and ``dim``."""
    kept = vectors.where(finite(col(vector_col)) & F.size(col(vector_col)).isin(list(books.books))) \
        if books.books else vectors.limit(0)
    out = T.StructType([T.StructField("codes", T.ArrayType(T.IntegerType())), T.StructField("error", T.LongType()),
                        T.StructField("dim", T.IntegerType())])

    def factory():
        code = books.coder()

        def f(arrays):
            column = arrays[0]
            codes = np.zeros((len(column), books.parts), dtype=np.int32)
            error, dims = np.zeros(len(column), dtype=np.int64), np.zeros(len(column), dtype=np.int32)
            for rows, raw in by_length(column):
                c, e = code(integers(raw, books.scale))
                codes[rows], dims[rows] = c, raw.shape[1]
                error[rows] = [min(int(s), LONG_MAX) for s in e.sum(1)]
            ends = np.arange(0, codes.size + 1, books.parts, dtype=np.int32)
            return [pa.ListArray.from_arrays(ends, codes.ravel()), error, dims]
        return f

    keep = [c for c in vectors.columns if c != vector_col]
    return append_columns(kept, [vector_col], out, factory, keep=keep)


def with_label_error(coded: DataFrame, label_col: str = "label") -> DataFrame:
    """``coded``, computed once into the shared folder, plus ``label_error``: ``error`` summed
    over the rows of equal label, nulls together."""
    coded = written(coded, "vector-codes")
    per = coded.groupBy(col(label_col).alias("_label")).agg(
        F.least(F.sum(F.col("error").cast("decimal(38,0)")), F.lit(LONG_MAX).cast("decimal(38,0)")).cast("long")
        .alias("label_error"))
    rest = coded.drop("label_error") if "label_error" in coded.columns else coded
    return attach(rest, per, col(label_col).eqNullSafe(F.col("_label"))).drop("_label")
