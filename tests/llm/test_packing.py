import itertools
import zlib

import numpy as np
from pyspark.sql import functions as F

from assay.llm import packing as P
from assay.llm._common import tokenizer_path

PATH = tokenizer_path("word_bpe_49k.json")


def whole_ids(texts):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(PATH)
    return [e.ids for e in tok.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_word_encoder_equals_the_tokenizer():
    texts = ["It's  the\tend.\n\nNext line é ÀÉ   x", "<|endoftext|> a<|endoftext|>b", "", " ", "\x1c\x85 9'll",
             "漢字 かな 🙂🙂 don't!!! 12.5%", "İstanbul ǅ ﬁ Σς", "ÀÉÎ õü'S ß'll Straße ÿ×÷ 1½ ² aª µ", "été,été... 'tis 'T 're''s <|x|>",
             "".join(chr(c) for c in range(32, 127)), "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"]
    rng = np.random.default_rng(7)
    texts += ["".join(rng.choice(list("aeéßNthe'sS.,!?-_|<> \n\t0189ÿÀ"), size=200)) for _ in range(300)]
    assert P.WordEncoder(PATH).by_word
    enc = P.WordEncoder(PATH)
    assert [np.frombuffer(enc(t), enc.dtype).tolist() for t in texts] == whole_ids(texts)


def test_hilbert_neighbours_and_bijection():
    cells = np.array(list(itertools.product(range(8), repeat=3)))
    key = P.hilbert_key(cells, 3)
    assert sorted(key) == list(range(512))
    path = cells[np.argsort(key)]
    assert (np.abs(np.diff(path, axis=0)).sum(axis=1) == 1).all()


def check(rows, texts, length):
    pieces = [r.asDict() for r in rows]
    seqs = {}
    for p in pieces:
        seqs.setdefault(p["sequence_id"], []).append(p)
        assert p["length"] > 0 and p["ids_crc32"] == zlib.crc32(p["ids"]) and len(p["ids"]) == 4 * p["length"]
    for ps in seqs.values():
        ps.sort(key=lambda p: p["offset"])
        at = 0
        for p in ps:
            assert p["offset"] == at
            at += p["length"]
        assert at == length or at < length and at & (at - 1) == 0
    docs = {}
    for p in pieces:
        docs.setdefault(p["doc_id"], []).append(p)
    for doc_id, ids in texts.items():
        ps = sorted(docs.pop(doc_id), key=lambda p: p["start"])
        got = np.frombuffer(b"".join(p["ids"] for p in ps), "<u4").tolist()
        assert got == ids + [1] and [p["start"] for p in ps] == [0, *itertools.accumulate(p["length"] for p in ps)][:-1]
        assert {p["doc_tokens"] for p in ps} == {len(ids) + 1}
    assert not docs
    return seqs


def test_pack_round_trip(spark):
    texts = {0: "short", 1: None, 2: "", 3: "long words here " * 4000, **{i: f"document {i} of many " * (i % 40) for i in range(4, 90)}}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5) \
        .withColumn("key", F.lit("c")).withColumn("n", F.lit(1)).withColumn("ids", F.lit("z"))
    ids = dict(zip(texts, whole_ids(texts.values())))
    check(P.pack(df, PATH, length=256).collect(), ids, 256)
    assert P.pack(df.limit(0), PATH).count() == 0


def test_pack_repeated_rows_and_null_id(spark):
    df = spark.createDataFrame([(1, "same text"), (1, "same text"), (None, "no id")], "doc_id long, text string")
    rows = P.pack(df, PATH).collect()
    assert sorted(r.doc_id for r in rows if r.doc_id is not None and r.start == 0) == [1, 1]
    assert sum(r.length for r in rows) == sum({(r.doc_id): r.doc_tokens for r in rows}[d] for d in (1, 1, None))


def test_order_places_like_documents_together(spark):
    a, b = "the cat sat on the mat ", "quarterly revenue growth exceeded forecasts "
    df = spark.createDataFrame([(i, (a if i % 2 else b) * 40) for i in range(40)], "doc_id long, text string")
    rows = sorted(P.pack(df, PATH, length=8192).collect(), key=lambda r: (r.sequence_id, r.offset))
    kinds = [r.doc_id % 2 for r in rows if r.start == 0]
    assert sum(x != y for x, y in zip(kinds, kinds[1:])) <= 3
