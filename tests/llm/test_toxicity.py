import math
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import op13
from assay.llm import toxicity as X

MASK = (1 << 64) - 1
P = int(X._P)


def bucket(h, salt):
    h = ((h ^ (salt * 0x1000193)) * int(X._MIX)) & MASK
    h ^= h >> 32
    return (((h * int(X._MIX)) & MASK) >> 40) & (X.BUCKETS - 1)


def brute_score(model, text, table):
    """The score word by word and window by window."""
    words, now = [], []
    for c in (text or "").lower():
        s = int(table[ord(c)])
        if s == X.BORDER:
            words, now = words + ([now] if now else []), []
        else:
            now.append(s)
    words += [now] if now else []
    values = []
    for w in words:
        whole = sum(s * pow(P, i, 1 << 64) for i, s in enumerate(w)) & MASK
        rows, framed = [bucket(whole, 7)], [X.BORDER, *w, X.BORDER]
        for n in X.GRAMS:
            for i in range(len(framed) - n + 1):
                h = 0
                for s in framed[i:i + n]:
                    h = (h * P + s) & MASK
                rows.append(bucket(h, 100 + n))
        values.append(sum(model.weight[r] for r in rows) / len(rows))
    half, logits = X.WINDOW // 2, []
    starts = range(0, max(1, len(values) - half) if values else 1, half)
    for a in starts:
        part = values[a:a + X.WINDOW]
        logits.append(model.bias + (sum(part) / len(part) if part else 0.0))
    return 1 / (1 + math.exp(-max(logits)))


TEXTS = ["", None, "...", "a", "You are an Idiot, really", "naïve Ünïcode 漢字 слово " * 9, "x " * 23, "x y " * 12, "x " * 25, "w" * 700,
         " ".join(f"word{i}" for i in range(200)), "ab́c İstanbul ẞ", "tab\tline\nbreak nbsp"]


@pytest.fixture(scope="module")
def model():
    rng = np.random.default_rng(1)
    return X.Model(rng.normal(size=X.BUCKETS), -0.5)


def test_scores_equal_brute_force_in_any_pieces(model, monkeypatch):
    table = X.word_symbols()
    want = [brute_score(model, t, table) for t in TEXTS]
    got = model.scores(TEXTS)
    assert np.allclose(got, want, rtol=1e-12, atol=0)
    monkeypatch.setattr(X, "PIECE", 800)        # no word is cut
    assert (model.scores(TEXTS) == got).all()
    assert [model.scores([t])[0] for t in TEXTS] == got.tolist()


def corpus(rng, n, bad):
    common = [f"{a}{b}" for a in ("ro", "ta", "mel", "sin", "por") for b in ("den", "lic", "ma", "tor", "vek")]
    out = []
    for i in range(n):
        words = [rng.choice(common) for _ in range(rng.randint(30, 600))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(bad)
        out.append(" ".join(words))
    return out, [int(i % 4 == 0) for i in range(n)]


def test_single_words_in_long_texts_and_misspellings_are_found():
    rng = random.Random(3)
    texts, labels = corpus(rng, 300, ["wretchface", "grumblehead"])
    model = X.train(texts, labels)
    new, truth = corpus(rng, 200, ["wretchface", "grumblehead"])
    assert ((model.scores(new) >= 0.5) == np.array(truth)).mean() > 0.99
    misspelt, truth = corpus(rng, 200, ["wretchfaces", "wwretchface", "grumbleheadd", "grumblehed"])
    assert ((model.scores(misspelt) >= 0.5) == np.array(truth)).mean() > 0.95
    very_long = "melden talic " * 40_000
    assert model.scores([very_long])[0] < 0.5 <= model.scores([very_long + "grumblehead " + very_long])[0]


def test_labels_without_both_classes():
    assert X.train([], []).scores(["a", None]).max() < 1e-6
    assert X.train(["a b"], [1]).scores(["c"])[0] > 0.99
    assert abs(X.train(["", "."], [0, 1]).scores(["c"])[0] - 0.5) < 1e-6


def test_edge_rows(spark, model):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(None, "idiot", "x"), (4, "idiot", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string").withColumn("label", F.lit(1))
    got = X.score(docs, model).select("doc_id", "score").collect()
    want = model.scores([r[1] for r in rows])
    assert sorted((str(r.doc_id), r.score) for r in got) == sorted((str(r[0]), s) for r, s in zip(rows, want))
    broken = docs.limit(1).select("doc_id", F.expr("cast(X'61FF62' as string)").alias("text"))
    assert X.score(broken, model).first().score == model.scores(["a�b"])[0]
    assert X.score(docs.limit(0), model).count() == 0
    labels = spark.createDataFrame([(4, 1), (4, 1), (4, 0), (5, 0), (6, None), (7, 3), (None, 1), (99, 1)], "doc_id long, toxic int")
    texts, ys, shares = X.labelled_sample(docs, labels)
    assert sorted(zip(ys, texts)) == sorted([(0, TEXTS[4]), (0, "idiot"), (0, TEXTS[5]), (1, TEXTS[4]), (1, "idiot")])
    assert shares == (3 / 5, 2 / 5)
    assert X.labelled_sample(docs, labels.limit(0)) == ([], [], (0.0, 0.0))
    assert all(len(t) <= 3 for t in X.labelled_sample(docs, labels, texts=1, chars=3)[0])


def test_registered_query_on_rows_it_never_learned_from(spark):
    sf = "/root/testdata/sf0.1"
    got = {r.doc_id: r for r in op13.op13_toxicity(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert len(got) == docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    own = [(got[r.doc_id].predicted, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if got[r.doc_id].held_out]
    caught = sum(p for p, y in own if y)
    assert sum(p == y for p, y in own) / len(own) > 0.97
    assert caught / sum(y for _, y in own) > 0.8 and caught / sum(p for p, _ in own) > 0.97
