"""SimHash near-duplicates with BK-trees.

Fingerprint: A-Z lower-cased, words are runs without ASCII white space, shingles of
``shingle`` consecutive words (repeats count; a shorter text is one shingle; no word gives
fingerprint zero), each hashed with XXH64 (seed 42); a bit is one when it is set in more
than half of the hashes.

Links (fingerprints at most ``radius`` bits apart) are found among the distinct
fingerprints.  With ``radius + 1`` disjoint bands two linked fingerprints agree on one band
at least, so each band value is a shard: its fingerprints form one BK-tree (children keyed
by the Hamming distance to their parent) and a search follows only the edges within the
radius.  A shard tree is sent to the one task that searches it, by the shuffle on its key:
all trees together grow with the data, so they are not broadcast.  A shard above
``SHARD_LIMIT`` is cut again by the same argument on its remaining bits (each member then
stands in ``radius + 1`` smaller shards), twice at most; what is left then has at most 2^20
distinct members whatever the data, because the members of a shard are distinct and agree
on all other bits.  A shard emits one row per member that a link joins to another, never all
pairs.

Edge cases: null and word-less texts share fingerprint zero; rows that repeat a doc_id
stay separate rows, their fingerprints are joined through the equal id's minimum only
where they link; a null doc_id never becomes a component's id unless all its members are
null.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm._common import append_columns, col, cut, release, small_batches
from assay.llm.components import components

SEED = 42
BITS = 64
SHARD_LIMIT = 4096
CHUNK = 65_536          # hashes whose bits are counted at once

FP = T.StructType([T.StructField("fp", T.LongType())])


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit fingerprint of one whole text."""
    words = text.encode().lower().split() if text else []
    if not words:
        return 0
    k = min(shingle, len(words))
    hashes = list(map(xxhash.xxh64_intdigest, map(b" ".join, zip(*(words[i:] for i in range(k)))),
                      [SEED] * (len(words) - k + 1)))
    counts = np.zeros(BITS, dtype=np.int64)
    for i in range(0, len(hashes), CHUNK):
        h = np.array(hashes[i:i + CHUNK], dtype=np.uint64).astype(">u8")
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, text_col: str = "text", shingle: int = 3,
                 keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``fp``, the fingerprint's bits as a signed long."""
    def factory():
        release()

        def f(cols: list[pa.Array]):
            got = np.array([fingerprint(t, shingle) for t in cols[0].to_pylist()], dtype=np.uint64)
            return [got.view(np.int64)]
        return f

    return append_columns(docs, [text_col], FP, factory, keep)


class BKTree:
    """Node i has ``items[i]`` and a dict from Hamming distance to child."""

    def __init__(self):
        self.items: list[int] = []
        self.children: list[dict[int, int]] = []

    def add(self, x: int) -> None:
        self.items.append(x)
        self.children.append({})
        at, new = 0, len(self.items) - 1
        while at != new:
            at = self.children[at].setdefault((x ^ self.items[at]).bit_count(), new)

    def within(self, x: int, radius: int) -> list[int]:
        """Nodes at most ``radius`` from ``x``."""
        found, todo = [], [0] if self.items else []
        while todo:
            at = todo.pop()
            d = (x ^ self.items[at]).bit_count()
            if d <= radius:
                found.append(at)
            for k, child in self.children[at].items():
                if d - radius <= k <= d + radius:
                    todo.append(child)
        return found


def parts(members: list[int], radius: int) -> list[tuple[int, int]]:
    """(member, first member of its part) for every other member of the parts that links of
    distinct members join: a star per part, one row less than its members."""
    tree, parent = BKTree(), list(range(len(members)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, x in enumerate(members):
        for j in tree.within(x, radius):
            p, q = root(i), root(j)
            parent[max(p, q)] = min(p, q)
        tree.add(x)
    return [(x, members[root(i)]) for i, x in enumerate(members) if root(i) != i]


def _bands(df: DataFrame, key: str, rest_bits: int, n: int) -> tuple[DataFrame, int]:
    """One row per band of ``rest`` (the low ``rest_bits`` bits of the fingerprint not yet
    fixed): ``key`` holds band and value, ``rest`` the other bits."""
    width = rest_bits // n
    mask = (1 << width) - 1
    parts = []
    for i in range(n):
        lo = i * width
        value = F.shiftrightunsigned("rest", lo).bitwiseAND(F.lit(mask))
        below = F.col("rest").bitwiseAND(F.lit((1 << lo) - 1))
        above = F.shiftrightunsigned("rest", lo + width) if lo + width < BITS else F.lit(0)
        parts.append(F.struct((F.lit(i).cast("long") * (1 << width) + value).alias(key),
                              below.bitwiseOR(F.shiftleft(above.cast("long"), lo)).alias("rest")))
    others = [c for c in df.columns if c not in (key, "rest")]
    return df.withColumn("_b", F.explode(F.array(*parts))).select(*others, "_b.*"), rest_bits - width


def shards(fps: DataFrame, radius: int, limit: int = SHARD_LIMIT) -> DataFrame:
    """``(k1, k2, k3, fp)``: the shards each distinct fingerprint stands in.  Every pair
    within the radius shares a shard."""
    keys = ["k1", "k2", "k3"]
    df, rest = _bands(fps.withColumn("rest", F.col("fp")), "k1", BITS, radius + 1)
    df = df.withColumn("k2", F.lit(-1).cast("long")).withColumn("k3", F.lit(-1).cast("long"))
    for level in (1, 2):
        large = cut(df.groupBy(keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > limit).drop("n"))
        if large.isEmpty():
            break
        split, rest = _bands(df.join(large, keys, "left_semi").drop(keys[level]), keys[level], rest, radius + 1)
        df = df.join(large, keys, "left_anti").unionByName(split)
    return df.select(*keys, "fp")


def joined(fps: DataFrame, radius: int, limit: int = SHARD_LIMIT) -> DataFrame:
    """``(a, b)`` pairs of distinct fingerprints of one component that connect all pairs
    within ``radius``: in every shard each member of a part with the part's first."""
    keys = ["k1", "k2", "k3"]

    def search(batches):
        release()
        held: list[np.ndarray] = []

        def groups(rows: np.ndarray, last: bool):
            """Shards complete so far; keeps the last one, which may go on."""
            ends = np.flatnonzero((rows[1:, :3] != rows[:-1, :3]).any(axis=1)) + 1
            bounds = [0, *ends.tolist()] + ([len(rows)] if last else [])
            out = [l for a, b in zip(bounds, bounds[1:]) if b - a > 1
                   for l in parts(rows[a:b, 3].view(np.uint64).tolist(), radius)]
            held[:] = [] if last else [rows[bounds[-1]:]]
            return out

        def table(found):
            pairs = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
            return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

        for b in batches:
            held.append(np.column_stack([b.column(i).to_numpy(zero_copy_only=False) for i in range(4)]))
            key = held[-1][:, :3]
            if len(key) and (key != held[0][0, :3]).any():
                yield table(groups(np.ascontiguousarray(np.concatenate(held)), False))
        if held:
            rows = np.ascontiguousarray(np.concatenate(held))
            if len(rows):
                yield table(groups(rows, True))

    dealt = shards(fps, radius, limit).repartition(*keys).sortWithinPartitions(*keys, "fp")
    return small_batches(dealt).mapInArrow(search, "a long, b long")


def grouped(fps: DataFrame, radius: int, limit: int = SHARD_LIMIT) -> DataFrame:
    """``(fp, component_id)`` of the fingerprints in ``fps(doc_id, fp)``; the component's
    id is the smallest doc_id reachable over links."""
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("least")))
    member = components(joined(distinct.select("fp"), radius, limit))
    rooted = distinct.join(member, distinct.fp == member.node, "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.join(least, "root").select("fp", "component_id", "root")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2, limit: int = SHARD_LIMIT) -> DataFrame:
    """One row per document: ``doc_id``, ``fp`` (signed bits) and ``component_id``, the
    smallest id reachable over links."""
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    fps = cut(fingerprints(src, "text", shingle, ["doc_id"]))
    return fps.join(grouped(fps, radius, limit), "fp").select("doc_id", "fp", "component_id")


def representatives(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    radius: int = 2, limit: int = SHARD_LIMIT) -> DataFrame:
    """The rows of ``docs`` that stay: of each component the row with the smallest id
    (a null id only when all are null; equal ids go by the text's hash, fully equal
    texts by the other columns)."""
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    fps = fingerprints(src.withColumn("tkey", F.xxhash64("text")), "text", shingle, ["doc_id", "tkey"])
    fps = cut(fps)
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("doc_id"),
                     F.col("tkey").alias("tkey"))
    rows = fps.groupBy("fp", "doc_id", "tkey").agg(F.count(F.lit(1)).alias("n"))
    stay = rows.join(grouped(fps, radius, limit), "fp").groupBy("root") \
        .agg(F.min_by(F.struct(F.col("doc_id").alias("_id"), F.col("tkey").alias("_tkey"), F.col("n").alias("_n")),
                      place).alias("s")).select("s.*")
    stay = cut(stay)
    keyed = (col(id_col).eqNullSafe(F.col("_id"))) & (F.xxhash64(col(text_col).cast("string")) == F.col("_tkey"))
    out = docs.join(stay.where("_n = 1"), keyed, "left_semi")
    again = stay.where("_n > 1")
    if not again.isEmpty():
        others = [c for c in docs.columns if c not in (id_col, text_col)]
        one = docs.join(again, keyed, "left_semi").groupBy(col(id_col), col(text_col)) \
            .agg(F.min(F.struct(F.lit(0).alias("_"), *[col(c) for c in others])).alias("_row"))
        out = out.unionByName(one.select(*[col(c) if c in (id_col, text_col) else F.col("_row").getField(c).alias(c)
                                           for c in docs.columns]))
    return out
