from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from assay.llm import pqdedup as D
from assay.llm.vectors import cosines

SCHEMA = "vec_id long, embedding array<float>, label int"


def brute(rows, t):
    live = [k for k, (i, v, l) in enumerate(rows) if i is not None and l is not None and v and
            all(x is not None and np.isfinite(x) for x in v) and any(v)]
    parent = list(range(len(rows)))
    n = [0] * len(rows)

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for p, a in enumerate(live):
        for b in live[:p]:
            if rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                m = np.array([rows[a][1], rows[b][1]], dtype=np.float32)
                if cosines(m, np.array([0]), m, np.array([1]))[0] >= t:
                    n[a] += 1
                    n[b] += 1
                    parent[root(a)] = root(b)
    low = {}
    for k, (i, _, _) in enumerate(rows):
        if i is not None:
            low[root(k)] = min(low.get(root(k), i), i)
    return Counter((i, n[k], low.get(root(k)), i is not None and low[root(k)] == i) for k, (i, _, _) in enumerate(rows))


def corpus(seed, n, dim=16):
    rng = np.random.default_rng(seed)
    out = []
    for c in range(n // 12):
        base = rng.normal(size=dim)
        label = int(rng.integers(0, 3))
        for k in range(12):
            scale = [0.0, 0.02, 0.1, 0.25, 0.3][k % 5]      # around the threshold too
            out.append(((base + rng.normal(size=dim) * scale).astype(np.float32).tolist(), label if k % 7 else (label + 1) % 3))
    return [(i, v, l) for i, (v, l) in enumerate(out)]


def test_equals_brute_force_with_many_lists_and_blocks(spark):
    rows = corpus(3, 360)
    df = spark.createDataFrame(rows, SCHEMA)
    want = brute(rows, 0.93)
    assert sum(n for _, n, _, _ in want) > 200
    for block, size, sample in ((4096, 2048, 16_384), (7, 12, 100), (50, 40, 16_384)):
        got = Counter(map(tuple, D.near_duplicates(df, 0.93, block=block, list_size=size, sample=sample).collect()))
        assert got == want


def test_edge_vectors(spark):
    rows = [(5, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [2.0, 0.01], 1), (9, [1.0, 0.0], 2), (8, [1.0, 0.0], None), (7, None, 1),
            (6, [0.0, 0.0], 1), (10, [None, 1.0], 1), (11, [float("nan"), 1.0], 1), (12, [float("inf"), 1.0], 1), (None, [1.0, 0.0], 1),
            (13, [1.0, 0.0, 0.0], 1), (3, [1.0, 0.0], 1), (14, [], 1)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("n_links", F.lit("x")).withColumn("kept", F.lit("x")).withColumn("n", F.lit(0))
    assert Counter(map(tuple, D.near_duplicates(df).collect())) == brute(rows, 0.93)
    assert D.near_duplicates(df.limit(0)).count() == 0


def test_lookup_distance_is_the_distance_to_the_decoded_vector():
    rng = np.random.default_rng(8)
    x = D.Index(rng.normal(size=(500, 20)), 6)
    u = rng.normal(size=(60, 20))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    own, code, err, _ = x.code(u)
    decoded = x.centroids[own] + np.concatenate([b[code[:, i]] for i, b in enumerate(x.books)], axis=1)
    assert np.allclose(np.linalg.norm(u - decoded, axis=1), err)
    for at in range(len(x.centroids)):
        mine = own == at
        if mine.any():
            want = np.linalg.norm(u[:, None] - decoded[mine][None], axis=2)
            assert np.allclose(x.lookup(u, at, code[mine]), want, atol=1e-6)
