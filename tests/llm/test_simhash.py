import random
from collections import Counter

import xxhash

from assay.llm import simhash as S
from pyspark.sql import functions as F
from tests_llm_support import brute_components


def brute_fp(text, k=3):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    sh = [b" ".join(w[i:i + k]) for i in range(len(w) - k + 1)] or [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in sh]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprint_and_spark_hash(spark):
    texts = ["a b c d e", "A  B\tc", "one two", "", None, "x", " ", "Ünï céd É é a", "w " * 5000]
    assert [S.fingerprint(t, 3) for t in texts] == [brute_fp(t) for t in texts]
    r = spark.createDataFrame([("one two",)], "t string").select(F.xxhash64("t")).first()[0]
    assert r % 2**64 == S.fingerprint("one two", 3)


def test_bk_tree_is_exact():
    rng = random.Random(3)
    pts = list({rng.getrandbits(8) for _ in range(150)})
    tree = S.BKTree()
    for p in pts:
        tree.add(p)
    for q in range(256):
        assert sorted(tree.items[i] for i in tree.within(q, 2)) == sorted(p for p in pts if (p ^ q).bit_count() <= 2)


def test_links_connect_like_brute_force_at_every_shard_size(spark):
    rng = random.Random(5)
    fps = set()
    for _ in range(12):
        c = rng.getrandbits(64)
        fps.add(c)
        for _ in range(25):
            x = c
            for b in rng.sample(range(64), rng.choice([1, 1, 2, 3])):
                x ^= 1 << b
            fps.add(x)
    fps = sorted(fps)
    want = brute_components(fps, fps, 2)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for limit in (4096, 10, 1):
        found = [(r.a % 2**64, r.b % 2**64) for r in S.joined(df, 2, limit).collect()]
        parent = {x: x for x in fps}

        def root(x):
            while parent[x] != x:
                x = parent[x]
            return x
        for a, b in found:
            p, q = sorted((root(a), root(b)))
            parent[q] = p
        assert [root(x) for x in fps] == want


def test_near_duplicates_edge_rows(spark):
    base = " ".join(f"w{i}" for i in range(300))
    rows = [(5, base), (3, base), (9, base.replace("w150", "zz")), (7, None), (4, ""), (None, base), (8, "solo text"),
            (8, "solo text"), (11, "é " * 4000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("fp", F.lit("clash")) \
        .withColumn("component_id", F.lit(0))
    got = Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in S.near_duplicates(df).collect())
    fps = [brute_fp(t) for _, t in rows]
    want = Counter(zip([i for i, _ in rows], fps, brute_components([i for i, _ in rows], fps, 2)))
    assert got == want
    assert S.near_duplicates(df.limit(0)).count() == 0
