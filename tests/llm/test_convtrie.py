import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from assay.llm import convtrie as C
from assay.llm.op12 import conversation_prefixes, with_borrowed_heads
from assay.llm.zfast import ZFastTrie, two_fattest

SCHEMA = "conv_id long, turn long, role string, text string, conv string, fp string"


def digest(role, text):
    r, t = (role or "").encode(), (text or "").encode()
    return hashlib.md5(str(len(r)).encode() + b":" + r + t).digest()


def brute(rows):
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, digest(role, text), role or "", text or ""))
    own = {c: [(r[3], r[4]) for r in sorted(v)] for c, v in own.items()}
    built = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        built[c] = own.get(base, [])[:h] + seq[h:]
    members, ends = {}, {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
        ends.setdefault(tuple(seq), []).append(c)
    kids, out = {}, []
    for k in members:
        if k:
            kids.setdefault(k[:-1], []).append(k)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        own_saved = (len(members[k]) - 1) * len(k[-1][1].encode()) if k else 0
        saved[k] = own_saved + sum(saved[x] for x in kids.get(k, []))
        leaves[k] = sum(leaves[x] for x in kids.get(k, [])) or 1
    for k, m in members.items():
        ids = ",".join(map(str, sorted(ends.get(k, []))))
        out.append((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), len(kids.get(k, [])), leaves[k], saved[k],
                    hashlib.sha256(ids.encode()).hexdigest()))
    return sorted(out, key=str)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash", "clash") for r in rows], SCHEMA)


def columns(df):
    return sorted((tuple(r) for r in df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                               "saved_tokens", "ends_sha256").collect()), key=str)


def sample(seed, convs, turns):
    rng, rows = random.Random(seed), []
    for c in range(convs):
        kind = rng.choice("abc")
        for t in range(rng.randint(0, turns)):
            rows.append((c, t, rng.choice(["user", "bot"]), kind * rng.randint(0, 2) + ("é" if rng.random() < 0.2 else "")))
    return rows


@pytest.mark.parametrize("segment,trie_turns", [(65_536, 131_072), (3, 4), (7, 40)])
def test_equals_brute_force(spark, segment, trie_turns):
    rows = sample(segment, 60, 14) + [(500, t, "user", "long") for t in range(40)] + [(501, t, "user", "long") for t in range(30)]
    assert columns(conversation_prefixes(table(spark, rows), segment, trie_turns)) == brute(rows)


def test_edge_rows(spark):
    rows = [(1, None, "user", "x"), (1, 0, None, None), (1, 0, "", ""), (2, 5, "a", "b"), (2, 5, "a", "b"), (2, 5, "c", "b"),
            (None, 0, "user", "lost"), (-3, 1, "user", "n"), (-5, 1, "user", "n"), (7, 3, "user", "ab"), (8, 3, "use", "rab"),
            (9, 1, "user", "y" * 200_000), (12, 0, "u", "only"), (13, 0, "u", "only")]
    got = columns(conversation_prefixes(table(spark, rows)))
    assert got == brute(rows)
    assert conversation_prefixes(table(spark, rows).limit(0)).count() == 0
    assert columns(conversation_prefixes(table(spark, [(12, 0, "u", "x")]))) == brute([(12, 0, "u", "x")])


def test_one_conversation_over_many_tasks(spark):
    rows = [(5, t // 2, "user", str(t % 3)) for t in range(300)] + [(6, 0, "a", "b"), (4, 0, "a", "b")]
    turns, most = C.numbered(C.digests(table(spark, rows)), range_rows=10)
    got = [r.idx for r in turns.where("conv = 5").orderBy("idx").collect()]
    assert got == list(range(300)) and most >= 299
    nodes, _ = C.trie(with_borrowed_heads(turns), most, segment=16, trie_turns=20)
    assert nodes.agg(F.max("depth")).first()[0] == 300


def test_digest_of_many_ends(spark):
    ids = list(range(-50, 9_000, 3))
    df = spark.createDataFrame([(bytes([i % 2]) if i < 300 else b"hot", i) for i in ids], "fp binary, conv long").repartition(7)
    got = {bytes(r.fp): r.ends_sha256 for r in C.ends_digest(df, chunk=100).collect()}
    for key in (b"\0", b"\1", b"hot"):
        own = [i for i in ids if (bytes([i % 2]) if i < 300 else b"hot") == key]
        assert got[key] == hashlib.sha256(",".join(map(str, own)).encode()).hexdigest()


def test_fat_binary_search_finds_the_exit():
    rng = random.Random(2)
    trie, keys = ZFastTrie(0), []
    for _ in range(300):
        key = [rng.choice("ab") for _ in range(rng.randint(0, 40))]
        if keys and rng.random() < 0.6:
            key = rng.choice(keys)[:rng.randint(0, 40)] + key
        keys.append(key)
        path = [0] + [hash(tuple(key[:d])) for d in range(1, len(key) + 1)]
        before, longest = trie.probes, trie.locate(path)
        assert trie.probes - before <= max(1, len(path)).bit_length() + 1
        nodes, stack = [], [trie.root]
        while stack:
            n = stack.pop()
            nodes.append(n)
            stack += n.kids.values()
        fit = [n for n in nodes if n.depth < len(path) and n.path[:n.depth + 1] == path[:n.depth + 1]]
        assert longest is max(fit, key=lambda n: n.depth)
        trie.insert(path, [1] * len(key), 1, len(keys))
    assert sum(1 for _ in trie.expand()) == len({tuple(k[:d]) for k in keys for d in range(len(k) + 1)})
    assert two_fattest(4, 7) == 6 and two_fattest(0, 7) == 4 and two_fattest(7, 8) == 8
