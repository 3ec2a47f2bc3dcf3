

import numpy as np
from pyspark.sql import functions as F

from assay.llm import annsearch as A
from assay.llm.vectors import cosines

SCHEMA = "vec_id long, embedding array<float>, extra int"


def brute(rows, every, k):
    ok = [(i, np.array(v, dtype=np.float32)) for i, v in rows if i is not None and v is not None and
          all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for i in sorted({i for i, _ in ok if i % every == 0}):
        q = min((list(v) for j, v in ok if j == i))
        c = [(j, v) for j, v in ok if j != i and len(v) == len(q)]
        if c:
            m = np.stack([v for _, v in c])
            s = cosines(np.array([q], dtype=np.float32), np.zeros(len(c), dtype=int), m, np.arange(len(c)))
            best = sorted(zip(-s, [j for j, _ in c]))[:k]
            out += [(i, r + 1, j, -x) for r, (x, j) in enumerate(best)]
    return out


def rows_of(seed, n):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 16)).astype(np.float32)
    x[n // 2:n // 2 + 9] = x[0]             # a group of copies: ties
    x[n // 3] = x[0] * 3
    return [(i, v.tolist()) for i, v in enumerate(x)]


def test_equals_brute_force_over_many_tiles(spark):
    rows = rows_of(1, 300)
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA)
    for blocks in ((16_384, 32_768), (3, 40)):
        got = A.nearest(df, F.col("vec_id") % 10 == 0, 5, query_block=blocks[0], candidate_block=blocks[1]).collect()
        assert sorted(map(tuple, got)) == brute(rows, 10, 5)


def test_edge_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, None), (2, [0.0, 0.0]), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]),
            (6, [1e-30, 1e-30]), (7, [1e30, 2e30]), (8, [1.0, 2.0, 3.0]), (None, [1.0, 1.0]), (10, [2.0, 0.0]), (10, [1.0, 1.0]),
            (20, [])]
    df = spark.createDataFrame([(*r, 0) for r in rows], SCHEMA).withColumn("rank", F.lit("x")).withColumn("v", F.lit("y"))
    got = sorted(map(tuple, A.nearest(df, F.col("vec_id") % 10 == 0, 3).collect()))
    want = brute(rows, 10, 3)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])
    assert A.nearest(df.limit(0), F.col("vec_id") % 10 == 0, 3).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(4)
    u = rng.normal(size=(200, 64))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    q, s, e = A.quantise(u)
    gap = np.abs(u @ u.T - (q @ q.T) * s[:, None] * s[None])
    assert (gap <= e[:, None] + e[None] + e[:, None] * e[None] + 1e-9).all() and e.max() < 0.05


def test_copies_and_repeated_ids_in_a_tile():
    rng = np.random.default_rng(11)
    x = np.concatenate([np.repeat(rng.normal(size=(1, 8)), 60, axis=0), rng.normal(size=(40, 8))]).astype(np.float32)
    ids = np.concatenate([np.repeat([4, 2, 9], 10), np.arange(100, 130), np.arange(40) % 17]).astype(np.int64)
    order = rng.permutation(100)
    x, ids = x[order], ids[order]
    q_ids = np.array([2, 4, 105, 3, 500])
    q = np.stack([x[np.flatnonzero(ids == i)[0]] if i in ids else x[0] + np.float32(0.1) for i in q_ids])
    got = sorted(A.tile(q_ids, q, ids, x, 5))
    want = []
    for r, i in enumerate(q_ids):
        at = np.flatnonzero(ids != i)
        s = cosines(q[r:r + 1], np.zeros(len(at), dtype=int), x, at)
        want += [(int(i), j, -v) for v, j in sorted(zip((-s).tolist(), ids[at].tolist()))[:5]]
    assert got == sorted(want)


def test_a_tile_of_copies_is_no_slower_than_others():
    import time
    rng = np.random.default_rng(12)
    random = rng.normal(size=(4096, 32)).astype(np.float32)
    near = (random[:1] + rng.normal(scale=1e-5, size=random.shape)).astype(np.float32)
    took = []
    for x in (random, np.repeat(random[:1], 4096, axis=0), near):
        start = time.process_time()
        A.tile(np.arange(256) + 10_000, x[:256], np.arange(4096), x, 5)
        took.append(time.process_time() - start)
    assert took[1] < took[0] + 1 and took[2] < took[0] + 6
