import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import veccodes as V
from assay.llm.gnat import Gnat, roots, squared

SCHEMA = "vec_id long, embedding array<double>, label int, extra string"


def brute(rows, parts, entries, rounds, scale):
    """(vec_id, codes, error) sorted, and the digest per length, in Python integers."""
    out, digests = [], {}
    ok = [(i, v) for i, v in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    for dim in {len(v) for _, v in ok}:
        own = sorted(((i, v) for i, v in ok if len(v) == dim), key=lambda r: (r[0] is None, r))
        seeds = [r for r in own if r[0] is not None][:entries]
        if not seeds:
            continue
        def ints(v):
            return [max(-V.MOST, min(V.MOST, math.floor(scale * x))) for x in v]
        cuts = V.bounds(dim, parts)
        books = [[ints(v)[a:b] for _, v in seeds] for a, b in cuts]

        def code(q, p):
            return min((sum((x - y) ** 2 for x, y in zip(q, c)), e) for e, c in enumerate(books[p]))
        for _ in range(rounds):
            for p, (a, b) in enumerate(cuts):
                got = {}
                for _, v in own:
                    q = ints(v)[a:b]
                    got.setdefault(code(q, p)[1], []).append(q)
                for e, qs in got.items():
                    books[p][e] = [sum(c) // len(qs) for c in zip(*qs)]
        digests[dim] = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
        for i, v in own:
            got = [code(ints(v)[a:b], p) for p, (a, b) in enumerate(cuts)]
            out.append((i, tuple(e for _, e in got), min(sum(d for d, _ in got), V.LONG_MAX)))
    return sorted(out, key=str), digests


@pytest.mark.parametrize("form", [np.float64, object])
def test_tree_finds_nearest_and_lowest_tie(form):
    rng = np.random.default_rng(3)
    entries = rng.integers(-40, 40, size=(200, 3))
    entries[50:80] = entries[7]             # equal entries
    queries = np.concatenate([rng.integers(-60, 60, size=(500, 3)), entries])
    tree = Gnat(entries.astype(form))
    index, best = tree.nearest(queries.astype(form))
    d2 = ((queries[:, None].astype(int) - entries[None]) ** 2).sum(2)
    assert (index == d2.argmin(1)).all() and (best.astype(int) == d2.min(1)).all()
    assert tree.measured < d2.size * 0.8      # subtrees are left out


def test_roots_enclose():
    x = np.arange(0, 3000, dtype=np.float64) ** 2
    low, high = roots(x)
    assert (low <= np.arange(3000)).all() and (high >= np.arange(3000)).all()
    low, high = roots(np.array([[2, 10 ** 40 + 1]], dtype=object))
    assert low[0, 0] == 1 and high[0, 1] == 10 ** 20 + 1 and low[0, 1] == 10 ** 20
    assert squared(np.array([[1 << 50]], dtype=object), np.array([[-(1 << 50)]], dtype=object))[0, 0] == 1 << 102


def run(spark, rows, **kw):
    df = spark.createDataFrame([(*r, n % 3 if n % 4 else None, "x") for n, r in enumerate(rows)], SCHEMA) \
        .withColumn("v", F.lit("clash")).withColumn("error", F.lit("clash"))
    books = V.train(df, **kw)
    got = V.encode(df, books)
    return df, books, got


def test_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(90, 10))           # parts of 3, 3, 2, 2
    x[40:60] = x[3]
    rows = [(100 - i, v.tolist()) for i, v in enumerate(x)] + [(7, x[5].tolist()), (7, x[6].tolist()), (None, x[8].tolist())]
    _, books, got = run(spark, rows, entries=16, rounds=3)
    want, digests = brute(rows, 4, 16, 3, 1024)
    assert sorted(((r.vec_id, tuple(r.codes), r.error) for r in got.collect()), key=str) == want
    assert books.digest(10) == digests[10]


def test_edge_vectors_and_label_error(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, None), (1, [1.0, None, 0.0, 0.0]), (2, [nan, 0.0, 0.0, 0.0]), (3, [-inf, 0.0, 0.0, 0.0]), (4, [0.0] * 4),
            (5, [1e30, -1e30, 1e300, 3.0]), (6, [1.0, 2.0, 3.0, 4.0]), (7, []), (8, [1.0, 2.0]), (9, [-0.0004, 0.0, 0.0, 0.0]),
            (4, [0.0] * 4), (11, [1e9, 1e9, -1e9, 1e9]), (12, [4.0, 3.0])]
    df, books, got = run(spark, rows, entries=2, rounds=2)
    want, digests = brute(rows, 4, 2, 2, 1024)
    assert sorted(((r.vec_id, tuple(r.codes), r.error) for r in got.collect()), key=str) == want
    assert {d: books.digest(d) for d in books.books} == digests
    sums = {}
    labelled = V.with_label_error(got).collect()
    for r in labelled:
        sums[r.label] = sums.get(r.label, 0) + r.error
    assert len(labelled) == len(want) and all(r.label_error == min(sums[r.label], V.LONG_MAX) for r in labelled)
    empty = df.limit(0)
    assert V.with_label_error(V.encode(empty, V.train(empty))).count() == 0
