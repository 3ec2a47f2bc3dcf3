"""Nearest neighbours by a block matrix join with quantised product tiles.

Queries and candidates are dealt into blocks by a hash of their id; each (query block,
candidate block) pair is one tile, a task of bounded memory.  A tile scales its vectors to
length one, rounds them to int8 with a scale per vector, and multiplies the int8 matrices
(in float32, where these integer sums are exact).  With the lengths e of the rounding
errors, a cosine differs from the scaled product by at most e_q + e_c + e_q e_c.  A pair
survives when its upper bound reaches the k-th best lower bound of its query; survivors are
recomputed in double precision on the original vectors, and each query's k best of a
product go to its heap of k.  Of equal candidates in a tile only those with the smallest
ids are compared (``first_of_copies``): the others cannot be among the k.  The heaps of a query's tiles are merged by a ranked window with a limit before the
shuffle.  Nothing is approximate in the result: a dropped pair provably is not among the k.

Edge cases: vectors that are null, zero or hold null or non-finite components, and rows
without an id, take no part; vectors of different lengths never meet; a query never meets
rows of its own id; a repeated query id searches once, with the smallest of its vectors;
repeated candidate rows count each; ties go to the smaller id.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm._common import col
from assay.llm.vectors import cosines, unit, usable

QUERY_BLOCK, CANDIDATE_BLOCK = 16_384, 32_768
STEP_QUERIES, STEP_CANDIDATES = 1024, 4096      # one product inside a tile


def quantise(u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 rows (held as float32 for the product), scale per row, and the length of what
    rounding changed."""
    scale = np.abs(u).max(axis=1) / 127
    q = np.rint(u / scale[:, None]).astype(np.int8)
    err = np.sqrt(((u - q * scale[:, None]) ** 2).sum(axis=1))
    return q.astype(np.float32), scale, err


class Heaps:
    """The k best (score, smaller id first) of each query."""

    def __init__(self, n: int, k: int):
        self.k, self.heaps = k, [[] for _ in range(n)]
        self.least = np.full(n, -np.inf)        # score of the k-th best, once there are k

    def add(self, query: int, score: float, vec_id: int) -> None:
        heap, item = self.heaps[query], (score, -vec_id)
        if len(heap) < self.k:
            heapq.heappush(heap, item)
        elif item > heap[0]:
            heapq.heapreplace(heap, item)
        if len(heap) == self.k:
            self.least[query] = heap[0][0]


def first_of_copies(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows of ``x`` that can be among any query's k best: of equal vectors, which all have
    the same cosine, those with the smallest ids.  An id repeats at most k times among them,
    so 2k rows hold k of other ids than the query's."""
    _, group = np.unique(np.ascontiguousarray(x).view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((ids, group))
    same = np.flatnonzero(np.r_[True, (np.diff(group[order]) != 0) | (np.diff(ids[order]) != 0)])
    order = order[np.arange(len(order)) - np.repeat(same, np.diff(np.r_[same, len(order)])) < k]
    start = np.searchsorted(group[order], group[order])
    return np.sort(order[np.arange(len(order)) - start < 2 * k])


def best_of_each(i: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int):
    """Each query's k best (largest score, then smallest id) of the pairs (i, score, ids)."""
    order = np.lexsort((ids, -score, i))
    i = i[order]
    keep = np.arange(len(i)) - np.searchsorted(i, i) < k
    return i[keep], score[order][keep], ids[order][keep]


def tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """(query id, candidate id, cosine) of each query's k best candidates in the tile."""
    heaps = Heaps(len(q), k)
    some = first_of_copies(c_ids, c, k)
    c_ids, c = c_ids[some], c[some]
    uq, uc = unit(q), unit(c)
    qq, qs, qe = quantise(uq)
    cq, cs, ce = quantise(uc)
    for a in range(0, len(q), STEP_QUERIES):
        rows = slice(a, a + STEP_QUERIES)
        for b in range(0, len(c), STEP_CANDIDATES):
            cols = slice(b, b + STEP_CANDIDATES)
            near = (qq[rows] @ cq[cols].T) * qs[rows, None] * cs[None, cols]
            slack = qe[rows, None] + ce[None, cols] + qe[rows, None] * ce[None, cols] + 1e-9
            own = q_ids[rows, None] == c_ids[None, cols]
            low = np.where(own, -np.inf, near - slack)
            width = low.shape[1]
            floor = heaps.least[rows]
            if width >= k:
                floor = np.maximum(floor, np.partition(low, width - k, axis=1)[:, width - k])
            i, j = np.nonzero((near + slack >= floor[:, None]) & ~own)
            score = cosines(q[rows], i, c[cols], j)
            good = score >= heaps.least[a + i]
            for x, s, y in zip(*(v.tolist() for v in best_of_each(i[good], score[good], c_ids[b + j[good]], k))):
                heaps.add(a + x, s, y)
    return [(int(q_ids[i]), -neg, s) for i, h in enumerate(heaps.heaps) for s, neg in h]


def nearest(vectors: DataFrame, is_query, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
            query_block: int = QUERY_BLOCK, candidate_block: int = CANDIDATE_BLOCK) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row where the condition ``is_query``
    holds, the k other rows with the largest cosine (all, if fewer)."""
    base = vectors.select(col(id_col).cast("long").alias("id"), col(vector_col).alias("v"),
                          F.coalesce(is_query, F.lit(False)).alias("asks")) \
        .where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))
    n, asked = base.agg(F.count(F.lit(1)), F.count_if("asks")).first()
    n_q, n_c = max(1, -(-asked // query_block)), max(1, -(-n // candidate_block))
    queries = base.where("asks").groupBy("id", "dim").agg(F.min("v").alias("v")) \
        .withColumn("qb", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(n_q))) \
        .withColumn("cb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))))
    candidates = base.withColumn("cb", F.pmod(F.xxhash64("id", F.lit(2)), F.lit(n_c))) \
        .withColumn("qb", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_q - 1).cast("long"))))
    keys = ["dim", "qb", "cb"]

    def join(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(qs) and len(cs):
            found = tile(qs["id"].to_numpy(), np.stack(qs["v"].to_numpy()), cs["id"].to_numpy(),
                         np.stack(cs["v"].to_numpy()), k)
        return pd.DataFrame(found, columns=["query_id", "vec_id", "score"])

    best = queries.select(*keys, "id", "v").groupBy(*keys).cogroup(candidates.select(*keys, "id", "v").groupBy(*keys)) \
        .applyInPandas(join, "query_id long, vec_id long, score double")
    from pyspark.sql import Window
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
