import hashlib
import random

import numpy as np
import public_tokenizers
import tiktoken
from pyspark.sql import functions as F

from assay.llm import bytebpe as B

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
RANKS = B.read_ranks(PATH)
TIK = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
ODD = ["", "a", "a" * 5000, "ab" * 3000, "\x1c\x1d \x85  x", "🙂👩‍👩‍👧 漢字かな İß", "don't we'll I'M 's", "  \n\n \t x  ",
       "the" * 2000, "\u0000\u0001", "1234567890" * 50, "é" * 999, "!" * 777 + "?", "zz" + "́" * 40]


def test_transducer_equals_library_on_random_bytes():
    rng = random.Random(1)
    enc = B.Transducer(RANKS)
    letters = [list("abcdefghijklmnopqrstuvwxyz"), list("aeiouthn"), list("ab"), list(" ~=-_"), list("éàñüñ漢🙂")]
    for n in range(4000):
        w = "".join(rng.choices(rng.choice(letters), k=rng.randrange(1, 30)))
        b = w.encode()
        assert enc(b) == TIK._core_bpe.encode_single_piece(b), w


def test_states_are_rebuilt_without_effect(monkeypatch):
    monkeypatch.setattr(B, "MAX_STATES", 3)
    monkeypatch.setattr(B, "MAX_PAIRS", 2)
    enc = B.Transducer(RANKS)
    for w in ("transducers", "determinised", "lookahead", "transducers"):
        assert enc(w.encode()) == TIK._core_bpe.encode_single_piece(w.encode())


def test_whole_texts_equal_library_and_decode_back():
    enc, dec = B.Encoder(PATH, public_tokenizers.PATTERN), B.Decoder(PATH)
    for t in ODD:
        ids = np.frombuffer(enc(t), "<i4")
        assert ids.tolist() == TIK.encode_ordinary(t), t[:20]
        assert dec(ids) == t


def test_utf8_machine_is_incremental_and_replaces_ill_formed_bytes():
    rng = random.Random(2)
    for _ in range(300):
        data = bytes(rng.choices([0x41, 0xC3, 0xA9, 0xE2, 0x82, 0xAC, 0xF0, 0x9F, 0x99, 0x82, 0xED, 0xFF, 0xE0], k=12))
        m, out, at = B.Utf8Machine(), "", 0
        while at < len(data):
            n = rng.randrange(1, 4)
            out += m.feed(data[at:at + n])
            at += n
        assert out + m.end() == data.decode(errors="replace")


def test_query_shape(spark):
    rows = list(enumerate([*ODD, None]))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("IDS", F.lit(1)).withColumn("decoded", F.lit(2))
    got = {r.doc_id: r for r in B.decode(B.encode(df, PATH, public_tokenizers.PATTERN), PATH).collect()}
    for i, t in rows:
        assert list(got[i].ids) == TIK.encode_ordinary(t or "") and bytes(got[i].decoded) == (t or "").encode()
    assert B.decode(B.encode(df.limit(0), PATH, public_tokenizers.PATTERN), PATH).count() == 0


def test_registered_query_equals_library(spark):
    from assay.llm.op9 import op9_byte_bpe
    sf = "/root/testdata/sf0.001"
    text = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = op9_byte_bpe(spark, sf).collect()
    assert len(rows) == len(text)
    for r in rows:
        ids = TIK.encode_ordinary(text[r.doc_id])
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text[r.doc_id].encode()).hexdigest()
