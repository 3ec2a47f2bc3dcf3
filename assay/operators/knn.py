"""k-nearest-neighbour join (J4) and the kNN learners.

Reference rows fall into cells (nearest of about sqrt(n) pivots, drawn by a seeded hash
order), and a cell is cut into blocks of bounded size by a hash of the key.  Queries visit
cells in two rounds:

1. the nearest cells that together hold k members: the k-th distance found there is an
   upper bound U of the true one;
2. every other cell that can hold a nearer member.  A member of cell c lies at least
   ``d_c - r_c`` from the query (r_c: the cell's radius), so cells beyond U are skipped,
   exactly, by the triangle inequality.

A visit meets each block of its cell; the visits of a block are cut into bounded parts as
well.  One (block, part) is a task: an Arrow-batched matrix product gives the distances, of
which each query keeps its k best, recomputed exactly.  A ranked window merges them.  With
``probes`` the second round is replaced by that many nearest cells (approximate; the tests
measure its recall).

Cross-validation is one such join of the rows with themselves, in which members of a query's
own fold do not count: cells, blocks and both rounds are made once for all folds.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.operators._small import collect_bounded, settled

MAX_PIVOTS = 1024
BLOCK_ROWS = 4096       # members of a block, and visits of a task
STEP = 512              # queries of one product


def as_double_array(c: Column, is_vector: bool) -> Column:
    if is_vector:
        from pyspark.ml.functions import vector_to_array
        return vector_to_array(c)
    return c.cast("array<double>")


def _squares(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    """Squared distances by one product; rounding can move them by ``_slack``."""
    return np.maximum((q * q).sum(1)[:, None] + (r * r).sum(1)[None] - 2 * q @ r.T, 0)


def _slack(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    return 1e-13 * q.shape[1] * ((q * q).sum(1)[:, None] + (r * r).sum(1).max(initial=0))


def best_in_block(q: np.ndarray, r: np.ndarray, order: np.ndarray, k: int, qgroup=None, rgroup=None):
    """(query row, member row, distance) of each query's k nearest members; equal
    distances by ``order``, the members' places in key order.  With groups, members of the
    query's own do not count."""
    out = []
    for a in range(0, len(q), STEP):
        part = q[a:a + STEP]
        near = _squares(part, r)
        if qgroup is not None:
            own = qgroup[a:a + STEP, None] == rgroup[None]
            near[own] = np.inf
        kth = np.partition(near, min(k, len(r)) - 1, axis=1)[:, min(k, len(r)) - 1]
        close = near <= kth[:, None] + 2 * _slack(part, r)
        i, j = np.nonzero(close if qgroup is None else close & ~own)
        dist = np.sqrt(((part[i] - r[j]) ** 2).sum(axis=1))
        at = np.lexsort((order[j], dist, i))
        i, j, dist = i[at], j[at], dist[at]
        first = np.searchsorted(i, i)           # place of each query's first row
        keep = np.arange(len(i)) - first < k
        out.append((i[keep] + a, j[keep], dist[keep]))
    return [np.concatenate(x) for x in zip(*out)]


def knn_join(queries: DataFrame, refs: DataFrame, qkey: str, rkey: str, qvec: str, rvec: str,
             k: int = 5, payload=(), num_pivots: int | None = None, block_rows: int = BLOCK_ROWS,
             seed: int = 42, probes: int | None = None, group: str | None = None) -> DataFrame:
    """k nearest references of every query: (qkey, rank, rkey, distance, payload...).
    Ties in distance go to the smaller reference key.  Vectors are double arrays; rows
    without a key or vector take no part.  No references: no rows.  With ``group``, a column of
    both sides with few values, references of a query's own group do not count."""
    payload = list(payload)
    r = refs.select(F.col(rkey).alias("_rk"), F.col(rvec).alias("_rv"), (F.col(group) if group else F.lit(0)).cast("int").alias("_rg"),
                    *payload).where("_rk is not null and _rv is not null")
    q = queries.select(F.col(qkey).alias("_qk"), F.col(qvec).alias("_qv"), (F.col(group) if group else F.lit(0)).cast("int").alias("_qg")) \
        .where("_qk is not null and _qv is not null")
    found = T.StructType([T.StructField("_qk", q.schema["_qk"].dataType), T.StructField("_rk", r.schema["_rk"].dataType),
                          T.StructField("distance", T.DoubleType()), *[r.schema[p] for p in payload]])
    n = r.count()
    p = num_pivots or min(MAX_PIVOTS, max(1, math.ceil(math.sqrt(n))))
    drawn = collect_bounded(r.select("_rv").orderBy(F.md5(F.concat(F.lit(str(seed)), F.col("_rk").cast("string")))).limit(p), p)
    if not drawn:
        none = q.sparkSession.createDataFrame([], found)
        return _ranked(none, qkey, rkey, k, payload)
    pivots = np.array([row[0] for row in drawn], dtype=np.float64)

    @F.pandas_udf("cell int, r double")
    def assign(v: pd.Series) -> pd.DataFrame:
        x = np.stack(v.to_numpy())
        cell = _squares(x, pivots).argmin(axis=1)
        return pd.DataFrame({"cell": cell.astype(np.int32), "r": np.sqrt(((x - pivots[cell]) ** 2).sum(axis=1))})

    r = settled(r.withColumn("_a", assign("_rv")).select("*", "_a.cell", "_a.r").drop("_a"))
    counts = collect_bounded(r.groupBy("cell", "_rg").agg(F.count(F.lit(1)).alias("n"), F.max("r").alias("rad")))
    ids = np.array(sorted({c["cell"] for c in counts}))
    groups = np.array(sorted({c["_rg"] for c in counts}))
    members, radii = np.zeros((len(groups) + 1, len(ids)), dtype=np.int64), np.zeros(len(ids))     # last: no group
    for c in counts:
        at = np.searchsorted(ids, c["cell"])
        members[np.searchsorted(groups, c["_rg"]), at] = c["n"]
        radii[at] = np.maximum(radii[at], c["rad"])
    # members that count for a query of each group
    sizes = members.sum(axis=0)[None] - (members if group else 0 * members)
    centres = pivots[ids]

    def distances(v: pd.Series) -> np.ndarray:
        x = np.stack(v.to_numpy())
        return np.sqrt(_squares(x, centres) + _slack(x, centres))

    def nearest_cells(d: np.ndarray, g: pd.Series) -> list[np.ndarray]:
        """Per query the nearest cells up to k members (or ``probes`` cells)."""
        order = np.argsort(d, axis=1, kind="stable")
        if probes:
            return [o[:probes] for o in order]
        at = np.searchsorted(groups, g.to_numpy())
        at[~np.isin(g.to_numpy(), groups)] = len(groups)
        upto = (np.cumsum(sizes[at[:, None], order], axis=1) < k).sum(axis=1) + 1
        return [o[:m] for o, m in zip(order, upto)]

    @F.pandas_udf("array<int>")
    def first_round(v: pd.Series, g: pd.Series) -> pd.Series:
        return pd.Series([ids[o].astype(np.int32) for o in nearest_cells(distances(v), g)])

    @F.pandas_udf("array<int>")
    def second_round(v: pd.Series, g: pd.Series, bound: pd.Series) -> pd.Series:
        d = distances(v)
        reach = d - radii[None] <= bound.fillna(np.inf).to_numpy()[:, None] * (1 + 1e-9) + 1e-12
        for row, done in zip(reach, nearest_cells(d, g)):
            row[done] = False
        return pd.Series([ids[row].astype(np.int32) for row in reach])

    q = settled(q)
    best = _visit(q.withColumn("cell", F.explode(first_round("_qv", "_qg"))), r, k, payload, block_rows, found, bool(group))
    if not probes:
        best = settled(best)
        bound = best.groupBy("_qk").agg(F.sort_array(F.collect_list("distance")).alias("d")) \
            .select("_qk", F.get("d", F.lit(k - 1)).alias("_u"))
        more = q.join(bound, "_qk", "left").withColumn("cell", F.explode(second_round("_qv", "_qg", "_u")))
        best = best.unionByName(_visit(more.select("_qk", "_qv", "_qg", "cell"), r, k, payload, block_rows, found, bool(group)))
    return _ranked(best, qkey, rkey, k, payload)


def _ranked(best: DataFrame, qkey: str, rkey: str, k: int, payload) -> DataFrame:
    order = Window.partitionBy("_qk").orderBy("distance", "_rk")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k) \
        .select(F.col("_qk").alias(qkey), "rank", F.col("_rk").alias(rkey), "distance", *payload)


def _visit(visits: DataFrame, r: DataFrame, k: int, payload, block_rows: int, found: T.StructType, apart: bool) -> DataFrame:
    """Each visit's k best members of every block of its cell."""
    visits = settled(visits)
    shape = r.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks")) \
        .join(visits.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("parts")), "cell")
    shape = F.broadcast(settled(shape))         # one row per pivot, MAX_PIVOTS at most
    members = r.join(shape, "cell").withColumn("blk", F.pmod(F.xxhash64("_rk"), F.col("blocks")).cast("int")) \
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    visits = visits.join(shape, "cell").withColumn("part", F.pmod(F.xxhash64("_qk"), F.col("parts")).cast("int")) \
        .withColumn("blk", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    keys = ["cell", "blk", "part"]

    def task(qs: pd.DataFrame, rs: pd.DataFrame) -> pd.DataFrame:
        if not len(qs) or not len(rs):
            return pd.DataFrame({f.name: [] for f in found.fields})
        order = rs["_rk"].rank(method="first").to_numpy()
        i, j, dist = best_in_block(np.stack(qs["_qv"].to_numpy()), np.stack(rs["_rv"].to_numpy()), order, k,
                                   *((qs["_qg"].to_numpy(), rs["_rg"].to_numpy()) if apart else ()))
        out = pd.DataFrame({"_qk": qs["_qk"].to_numpy()[i], "_rk": rs["_rk"].to_numpy()[j], "distance": dist})
        for p in payload:
            out[p] = rs[p].to_numpy()[j]
        return out

    return visits.select(*keys, "_qk", "_qv", "_qg").groupBy(*keys) \
        .cogroup(members.select(*keys, "_rk", "_rv", "_rg", *payload).groupBy(*keys)).applyInPandas(task, found)


def knn_predict(neighbours: DataFrame, qkey: str, label: str, mode: str) -> DataFrame:
    """M11 mean of neighbour labels; M17 majority vote, the smallest label wins ties."""
    if mode == "mean":
        return neighbours.groupBy(qkey).agg(F.avg(F.col(label).cast("double")).alias("prediction"))
    votes = neighbours.groupBy(qkey, label).agg(F.count(F.lit(1)).alias("_v"))
    best = votes.groupBy(qkey).agg(F.min(F.struct((-F.col("_v")).alias("nv"), F.col(label).alias("l"))).alias("_b"))
    return best.select(qkey, F.col("_b.l").cast("double").alias("prediction"))


class _KNNParams(Params):
    featuresCol = Param(Params._dummy(), "featuresCol", "", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "", TypeConverters.toString)
    k = Param(Params._dummy(), "k", "", TypeConverters.toInt)
    mode = Param(Params._dummy(), "mode", "mean | vote", TypeConverters.toString)


class KNNEstimator(Estimator, _KNNParams):
    """kNN as an estimator over a vector column: fit keeps the (train) frame; transform
    runs the exact join against it."""

    @keyword_only
    def __init__(self, featuresCol="features", labelCol="label", k=5, mode="mean"):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", k=5, mode="mean")
        self._set(**self._input_kwargs)

    def _fit(self, df):
        features, label = self.getOrDefault(self.featuresCol), self.getOrDefault(self.labelCol)
        train = settled(df.select(F.monotonically_increasing_id().alias("_rid"), F.col(label).alias("_y"),
                                  _vec_array(df, features).alias("_f")))
        return self._copyValues(KNNModel(train))

    def cross_validated(self, df: DataFrame, fold: str) -> tuple[KNNModel, DataFrame]:
        """(model of all rows, (fold, label, prediction) of every row from the rows of other folds)."""
        features, label = self.getOrDefault(self.featuresCol), self.getOrDefault(self.labelCol)
        train = settled(df.select(F.monotonically_increasing_id().alias("_rid"), F.col(label).alias("_y"),
                                  _vec_array(df, features).alias("_f"), F.col(fold).alias("fold")))
        nn = knn_join(train.withColumnRenamed("_rid", "_qid"), train, "_qid", "_rid", "_f", "_f", self.getOrDefault(self.k),
                      payload=["_y"], group="fold")
        pred = knn_predict(nn, "_qid", "_y", self.getOrDefault(self.mode)).withColumnRenamed("_qid", "_rid")
        scored = settled(train.join(pred, "_rid", "left").select("fold", F.col("_y").alias("label"), "prediction"))
        return self._copyValues(KNNModel(train.drop("fold"))), scored


class KNNModel(Model, _KNNParams, MLWritable, MLReadable):
    """``train`` is a table of the shared folder (or the saved model's), so its row ids are
    fixed; a transform likewise fixes the ids of its rows before it uses them twice."""

    def __init__(self, train: DataFrame | None = None):
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", k=5, mode="mean")
        self.train = train

    def _transform(self, df):
        q = settled(df.withColumn("_qid", F.monotonically_increasing_id()))
        qa = q.select("_qid", _vec_array(q, self.getOrDefault(self.featuresCol)).alias("_qf"))
        nn = knn_join(qa, self.train, "_qid", "_rid", "_qf", "_f", self.getOrDefault(self.k), payload=["_y"])
        pred = knn_predict(nn, "_qid", "_y", self.getOrDefault(self.mode))
        return q.join(pred, "_qid", "left").drop("_qid")

    def write(self):
        return _KNNWriter(self)

    @classmethod
    def read(cls):
        return _KNNReader()


class _KNNWriter(MLWriter):
    def __init__(self, model: KNNModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.train.write.parquet(f"{path}/train")


class _KNNReader(MLReader):
    def load(self, path: str) -> KNNModel:
        meta = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = KNNModel(self.sparkSession.read.parquet(f"{path}/train"))
        model._resetUid(meta["uid"])
        DefaultParamsReader.getAndSetParams(model, meta)
        return model


def _vec_array(df: DataFrame, col: str) -> Column:
    from pyspark.ml.linalg import VectorUDT
    is_vec = isinstance(df.schema[col].dataType, VectorUDT)
    return as_double_array(F.col(col), is_vec)
