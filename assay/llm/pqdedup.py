"""Embedding near-duplicates with product quantisation.

Vectors of one label link when their cosine reaches the threshold.  Equal vectors of a
label are one class first.  Class vectors, scaled to length one, fall into coarse
inverted lists (nearest centroid) and carry a code: per subspace the nearest codeword of
the residual, with the length e of what the code loses.  For unit vectors, cosine >= t
means distance <= r = sqrt(2 - 2t), which gives two tests that never lose a link:

* probes: a vector visits list c when its distance to the plane between its own centroid
  and c is at most r (a member of c lies beyond that plane);
* asymmetric distance: a table lookup per subspace gives the distance from the visitor to
  the member's decoded vector; the pair goes on when that is at most r + e.

Pairs that pass are reranked by the exact cosine of the original vectors in double
precision.  Each unordered pair of lists is visited from the lower-numbered side only.

A cell (label, list) is cut into member blocks and visitor blocks by the counted sizes, so
a task holds one block of each whatever the skew.  Tasks return one row per vector with
links (partial counts, and a root within the task), never pairs; counts are summed and the
roots joined by star contraction.  Centroids and codewords are fitted on a bounded sample
(``SAMPLE`` vectors chosen by hash); every vector is indexed.  The number of lists grows
with the rows per label, up to ``MAX_LISTS``.

Edge cases: vectors that are null, zero or hold null or non-finite components, and rows
with a null label or id, link with nothing (their component is themselves); vectors of
different lengths never link; rows that repeat id and vector are separate copies.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm._common import append_columns, col, cut, written
from assay.llm.components import components
from assay.llm.vectors import cosines, matrix, unit, usable

SAMPLE, ROUNDS = 16_384, 12
LIST_SIZE, MAX_LISTS = 2048, 1024
SUBSPACES, CODEWORDS = 8, 256
BLOCK = 4096                    # members, and visitors, of one task
STEP = 512                      # visitors whose distances are looked up at once
SLACK = 1e-6                    # rounding allowance of the two tests


def k_means(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Plain Lloyd rounds from distinct sample rows; at most k centroids."""
    start = np.unique(x, axis=0)
    rng = np.random.default_rng(seed)
    c = start[rng.permutation(len(start))[:k]]
    for _ in range(ROUNDS):
        own = nearest_centroid(x, c)[0]
        size = np.bincount(own, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, own, x)
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
    return c


def nearest_centroid(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest centroid and squared distances to all."""
    d = np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None], 0)
    return d.argmin(axis=1), d


class Index:
    """Coarse centroids and per-subspace residual codewords of one vector length."""

    def __init__(self, sample: np.ndarray, lists: int):
        u = unit(sample)
        self.centroids = k_means(u, lists, 1)
        residual = u - self.centroids[nearest_centroid(u, self.centroids)[0]]
        cuts = np.linspace(0, u.shape[1], min(SUBSPACES, u.shape[1]) + 1).astype(int)
        self.parts = [slice(a, b) for a, b in zip(cuts, cuts[1:])]
        self.books = [k_means(residual[:, p], CODEWORDS, 2 + i) for i, p in enumerate(self.parts)]

    def code(self, u: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """List, code, error length, and squared distances to all centroids."""
        own, d = nearest_centroid(u, self.centroids)
        residual = u - self.centroids[own]
        code = np.empty((len(u), len(self.parts)), dtype=np.uint8)
        lost = np.zeros(len(u))
        for i, (p, book) in enumerate(zip(self.parts, self.books)):
            code[:, i], far = nearest_centroid(residual[:, p], book)
            lost += ((residual[:, p] - book[code[:, i]]) ** 2).sum(axis=1)
        return own, code, np.sqrt(lost), d

    def probes(self, own: np.ndarray, d: np.ndarray, radius: float) -> np.ndarray:
        """True where a vector must visit a list numbered above its own."""
        gap = np.sqrt(nearest_centroid(self.centroids, self.centroids)[1])[own]
        beyond = d - np.take_along_axis(d, own[:, None], axis=1)
        must = beyond <= 2 * gap * (radius + SLACK) + SLACK
        return must & (np.arange(d.shape[1])[None] > own[:, None])

    def lookup(self, u: np.ndarray, at: int, code: np.ndarray) -> np.ndarray:
        """Asymmetric distances from vectors to the decoded members of list ``at``."""
        residual = u - self.centroids[at]
        out = np.zeros((len(u), len(code)))
        for i, (p, book) in enumerate(zip(self.parts, self.books)):
            out += nearest_centroid(residual[:, p], book)[1].take(code[:, i], axis=1)
        return np.sqrt(out)


def fit(vectors: DataFrame, n: int, lists: int, sample: int = SAMPLE) -> dict[int, Index]:
    """An index per vector length from a sample of at most about ``sample`` rows."""
    span = 1 << 31
    rate = min(span, -(-sample * span // max(n, 1)))
    rows = vectors.where(F.pmod(F.xxhash64("rep"), F.lit(span)) < rate).select("rep", "v").orderBy("rep").collect()
    by_dim: dict[int, list] = {}
    for r in rows:
        by_dim.setdefault(len(r["v"]), []).append(r["v"])
    return {d: Index(np.array(v, dtype=np.float64), lists) for d, v in by_dim.items()}


def local_roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Smallest index of each node's component under the links (i, j)."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        while (root[root] != root).any():
            root = root[root]
        apart = root[i] != root[j]
        i, j = i[apart], j[apart]
    return root


def link_block(index: Index, at: int, members: dict, visitors: dict, inside: bool, threshold: float,
               radius: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rep, links, root's rep) of the vectors with links between a visitor and a member
    block of list ``at``; ``inside``: both are the same block, each pair counts once."""
    u = unit(visitors["v"])
    links_m, links_v = np.zeros(len(members["rep"])), np.zeros(len(visitors["rep"]))
    found_i, found_j = [], []
    for a in range(0, len(u), STEP):
        far = index.lookup(u[a:a + STEP], at, members["code"])
        i, j = np.nonzero(far <= radius + members["err"][None] + SLACK)
        i = i + a
        if inside:
            i, j = i[i < j], j[i < j]
        exact = cosines(visitors["v"], i, members["v"], j) >= threshold
        i, j = i[exact], j[exact]
        links_v += np.bincount(i, weights=members["n"][j], minlength=len(links_v))
        links_m += np.bincount(j, weights=visitors["n"][i], minlength=len(links_m))
        root = local_roots(len(links_m) + len(links_v), i + (0 if inside else len(links_m)), j)
        keep = np.flatnonzero(root != np.arange(len(root)))     # a forest stands for this step's links
        found_i.append(keep)
        found_j.append(root[keep])
    nodes = np.concatenate([members["rep"], visitors["rep"]])
    root = local_roots(len(nodes), np.concatenate(found_i), np.concatenate(found_j)) if found_i else np.arange(len(nodes))
    counts = np.concatenate([links_m + links_v, 0 * links_v]) if inside else np.concatenate([links_m, links_v])
    has = np.flatnonzero(counts)
    return nodes[has], counts[has].astype(np.int64), nodes[root[has]]


def links(classes: DataFrame, threshold: float, block: int = BLOCK, list_size: int = LIST_SIZE,
          sample: int = SAMPLE) -> DataFrame:
    """``(rep, links, root)`` partial rows of ``classes(rep, label, v, n)``."""
    radius = math.sqrt(max(0.0, 2 - 2 * threshold))
    empty = classes.sparkSession.createDataFrame([], "rep long, links long, root long")
    n, labels = classes.agg(F.count(F.lit(1)), F.approx_count_distinct("label")).first()
    if n < 2:
        return empty
    lists = min(MAX_LISTS, max(1, round(n / (labels * list_size))))
    index = fit(classes, n, lists, sample)
    out = T.StructType([T.StructField("dim", T.IntegerType()), T.StructField("own", T.IntegerType()),
                        T.StructField("code", T.BinaryType()), T.StructField("err", T.DoubleType()),
                        T.StructField("visits", T.ArrayType(T.IntegerType()))])

    def factory():
        def f(cols: list[pa.Array]):
            sizes = np.diff(cols[0].offsets.to_numpy())
            got: list[list] = [[None] * len(sizes) for _ in range(5)]
            for d in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == d)
                x = index.get(d)
                u = unit(matrix(cols[0].take(pa.array(at))))
                if x is None:       # a length that the sample lacks: one list, zero codes, error one
                    x = Index(np.eye(1, d), 1)
                own, code, err, dist = x.code(u)
                must = x.probes(own, dist, radius)
                for k, r in enumerate(at.tolist()):
                    for c, v in zip(got, (d, int(own[k]), code[k].tobytes(), float(err[k]),
                                          np.flatnonzero(must[k]).tolist())):
                        c[r] = v
            return got
        return f

    coded = written(append_columns(classes, ["v"], out, factory, ["rep", "label", "v", "n"]), "pq-codes")
    cells = coded.groupBy("label", "dim", F.col("own").alias("list")).agg(F.count(F.lit(1)).alias("members")) \
        .withColumn("blocks", F.ceil(F.col("members") / block).cast("int"))
    seen = coded.select("label", "dim", F.explode("visits").alias("list")) \
        .groupBy("label", "dim", "list").agg(F.count(F.lit(1)).alias("visitors")) \
        .withColumn("parts", F.ceil(F.col("visitors") / block).cast("int"))
    cells = cells.join(seen, ["label", "dim", "list"], "left").fillna({"parts": 0}) \
        .select("label", "dim", "list", "blocks", "parts")
    row = ["rep", "v", "n", "code", "err"]
    part = F.pmod(F.xxhash64("rep"), F.lit(1 << 40))
    # A member block meets itself, the later blocks of its list, and every visitor part.
    home = coded.withColumnRenamed("own", "list").join(cells, ["label", "dim", "list"]) \
        .withColumn("mb", (part % F.col("blocks")).cast("int"))
    guest = coded.withColumn("list", F.explode("visits")).join(cells, ["label", "dim", "list"]) \
        .withColumn("vb", (part % F.col("parts")).cast("int"))
    one = F.lit(1)
    as_member = home.withColumn("vb", F.explode(F.sequence(-F.col("mb") - one, F.col("parts") - one))) \
        .select("label", "dim", "list", "mb", "vb", F.lit(True).alias("member"), *row)
    # Visitor blocks below zero are blocks of the list itself: -1 is block 0, -2 is block 1.
    as_earlier = home.where("mb + 1 < blocks") \
        .withColumn("to", F.explode(F.sequence(F.col("mb") + one, F.col("blocks") - one))) \
        .select("label", "dim", "list", F.col("to").alias("mb"), (-F.col("mb") - one).alias("vb"),
                F.lit(False).alias("member"), *row)
    as_guest = guest.withColumn("mb", F.explode(F.sequence(F.lit(0), F.col("blocks") - one))) \
        .select("label", "dim", "list", "mb", "vb", F.lit(False).alias("member"), *row)
    keys = ["label", "dim", "list", "mb", "vb"]

    def task(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        _, dim, at, mb, vb = key
        dim, at, mb, vb = int(dim), int(at), int(mb), int(vb)
        is_member = rows["member"].to_numpy()

        def side(part: pd.DataFrame) -> dict:
            return {"rep": part["rep"].to_numpy(), "n": part["n"].to_numpy().astype(np.float64),
                    "v": np.stack(part["v"].to_numpy()), "err": part["err"].to_numpy(),
                    "code": np.frombuffer(b"".join(part["code"]), dtype=np.uint8).reshape(len(part), -1)}

        inside = vb == -mb - 1
        if not is_member.any() or not (inside or (~is_member).any()):
            return pd.DataFrame({"rep": [], "links": [], "root": []})
        members = side(rows[is_member])
        visitors = members if inside else side(rows[~is_member])
        x = index.get(dim) or Index(np.eye(1, dim), 1)
        rep, count, root = link_block(x, at, members, visitors, inside, threshold, radius)
        return pd.DataFrame({"rep": rep, "links": count, "root": root})

    return as_member.unionByName(as_earlier).unionByName(as_guest).groupBy(*keys) \
        .applyInPandas(task, "rep long, links long, root long")


def near_duplicates(vectors: DataFrame, threshold: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", block: int = BLOCK, list_size: int = LIST_SIZE,
                    sample: int = SAMPLE) -> DataFrame:
    """One row per vector: ``vec_id, n_links`` (other rows linked directly),
    ``component_id`` (smallest id reachable) and ``kept`` (it is its component's id)."""
    base = vectors.select(col(id_col).alias("vec_id"), col(label_col).alias("label"), col(vector_col).alias("v")) \
        .withColumn("live", usable(F.col("v")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    classes = written(base.where("live").groupBy("label", "v")
                      .agg(F.min("vec_id").cast("long").alias("rep"), F.count(F.lit(1)).alias("n")), "pq-classes")
    partial = cut(links(classes, threshold, block, list_size, sample))
    counted = partial.groupBy("rep").agg(F.sum("links").alias("links"))
    member = components(partial, "rep", "root").withColumnRenamed("node", "rep")
    known = classes.join(counted, "rep", "left").join(member, "rep", "left") \
        .select("label", "v", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                F.coalesce("root", "rep").alias("component_id"))
    linked = base.where("live").drop("live").join(known, ["label", "v"]).select("vec_id", "n_links", "component_id")
    alone = base.where("not live").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                          F.col("vec_id").cast("long").alias("component_id"))
    return linked.unionByName(alone) \
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
