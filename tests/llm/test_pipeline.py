import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as C
from assay.llm import langid, linededup, simhash
from pyspark.sql import Row
from test_linededup import brute as brute_passages
from test_linededup import staying
from tests_llm_support import brute_components


def test_pipeline_equals_brute_force(spark, tmp_path):
    words = {"en": "the of and in that with for", "fr": "le la des une dans pour avec"}
    rows = []
    for i in range(60):
        lang = "fr" if i % 3 == 0 else "en"
        w = words[lang].split()
        rows.append((i, " ".join(w[(i * k * k + k) % 7] + ("s" if (i + k) % 5 == 0 else "") for k in range(40 + i)) + ".",
                     lang if i % 7 else None, "src0", 0))
    passage = " ".join(f"shared{k}" for k in range(60)) + "."
    rows += [(100, rows[5][1], "en", "s", 0), (101, rows[5][1], None, None, None), (102, "", "en", "s", 0),
             (103, None, "en", "s", 0), (104, "12 34 !!", "en", "s", 0), (105, f"First {passage}", "en", "s", 0),
             (106, f"the of and {passage} in that with", "en", "s", 0), (107, f"Also here. {passage} with more", "en", "s", 0),
             (108, f"Nothing else here at all. {passage}", "en", "s", 0), (108, f"Nothing else here at all. {passage}", "en", "t", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    pieces = C.run(spark, str(tmp_path)).collect()

    kept = [r for r in rows if r[1] and any(c.isalpha() for c in r[1])]
    comp = brute_components([r[0] for r in kept], [simhash.fingerprint(r[1], 3) for r in kept], 2)
    kept = [r for i, (r, c) in enumerate(zip(kept, comp)) if r[0] == c and r[0] not in [x[0] for x in kept[:i]]]
    # the words that stay, by the brute-force version of substring dedup
    stay = brute_passages([r[:2] for r in kept], linededup.MIN_WORDS)
    texts = {r.doc_id: r.text for r in linededup.deduplicate(spark.createDataFrame([r[:2] for r in kept], "doc_id long, text string")).collect()}
    assert staying([Row(doc_id=i, text=t) for i, t in texts.items()]) == stay
    want = {i: t for i, t in texts.items() if t.strip()}
    assert all("shared30" not in t for i, t in want.items() if i != 105) and "shared0 " in want[105]
    assert 100 not in want and 101 not in want and want[108] == "Nothing else here at all."
    from tokenizers import Tokenizer
    from assay.llm._common import tokenizer_path
    tok = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    n = {d: len(tok.encode(t, add_special_tokens=False).ids) + 1 for d, t in want.items()}
    assert {p.doc_id: p.doc_tokens for p in pieces} == n
    assert sum(p.length for p in pieces) == sum(n.values())


def test_stages_on_an_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in C.STAGES:
        assert stage(spark, df, "").count() == 0


def test_language_sample_and_edges(spark):
    en = "this is the text of the house and that of the other one "
    de = "das ist der text des hauses und der von dem anderen "
    rows = [(i, (en if i % 2 else de) * 5, "en" if i % 2 else "de") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = langid.labelled_sample(df)
    assert sample == {"en": [en * 5], "de": [de * 5]}
    test = [None, "", "12 !?", "and the other house", "und dem anderen des", "é" * 3, "the house of that " * 30_000]
    got = langid.identify(spark.createDataFrame([(i, t) for i, t in enumerate(test)], "i long, text string")
                          .withColumn("score", F.lit("clash")), sample)
    assert got.columns == ["i", "text", "lang_pred", "score"]
    res = {r.i: r for r in got.collect()}
    assert [res[i].lang_pred for i in (0, 1, 2, 3, 4, 6)] == ["und", "und", "und", "en", "de", "en"]
    assert res[0].score == 0.0 and all(0 <= r.score <= 1 for r in res.values()) and res[6].score > 0.5
    assert langid.identify(got.select("i", "text"), {}).select("lang_pred").distinct().collect()[0][0] == "und"


def test_phrases_are_greedy_longest_matches():
    sample = {"x": ["abracadabra alakazam"], "y": ["lorem ipsum dolor"]}
    parser = langid.CrossParser(sample)
    for text in ["abra kazam", "zzabracadabra", "lorem dolor ipsum", "qqq"]:
        s = langid.symbols(text, parser.table)
        row = np.full((1, langid.WINDOW), langid.PAD, dtype=np.uint8)
        row[0, :len(s)] = s
        got = parser.phrases(row)[0]
        for k, lang in enumerate(parser.langs):
            train = langid.symbols(sample[lang][0], parser.table).tolist()
            subs = {tuple(train[a:b]) for a in range(len(train)) for b in range(a + 1, len(train) + 1)}
            at, n, x = 0, 0, s.tolist()
            while at < len(x):
                m = 1
                while at + m <= len(x) and tuple(x[at:at + m]) in subs:
                    m += 1
                at += max(1, m - 1)
                n += 1
            assert int(got[k]) == n, (text, lang, got[k], n)


def test_held_out_accuracy(spark):
    from assay.llm.op1 import op1_language_id
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in op1_language_id(spark, sf).collect() if r.held_out]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows]) > 0.97


def test_language_of_a_few_texts_with_many_copies_is_sampled(spark):
    # Texts whose hash a rate of 256 in all rows would never draw.
    some = spark.range(300).select(F.concat(F.lit("mot numero "), F.col("id").cast("string")).alias("text")) \
        .where(F.pmod(F.xxhash64("text"), F.lit(1 << 31)) > (1 << 30)).limit(3)
    texts = sorted(r.text for r in some.collect())
    df = spark.createDataFrame([(t, "fr") for t in texts], "text string, lang string") \
        .crossJoin(spark.range(2000)).select("text", "lang") \
        .unionByName(spark.createDataFrame([("the house", "en")], "text string, lang string"))
    sample = langid.labelled_sample(df)
    assert sorted(sample["fr"]) == texts and sample["en"] == ["the house"]


def test_language_of_long_texts_only_is_learned(spark):
    long = "12 " * 9000 + "das ist der text des hauses " * 2000
    df = spark.createDataFrame([(long, "de"), ("the house of the text", "en")], "text string, lang string")
    sample = langid.labelled_sample(df)
    assert sample["de"] == [long[27_000:][:langid.SAMPLE_TEXT_CHARS]]
    got = langid.identify(df.select("text"), sample, keep=[]).collect()
    assert sorted(r.lang_pred for r in got) == ["de", "en"]


def test_languages_of_one_script_beside_many_letters_are_told_apart():
    common = "".join(chr(c) for c in [*range(0x61, 0x7b), *range(0x3b1, 0x3ca), *range(0x430, 0x450), *range(0x10d0, 0x10f1)])
    rng = np.random.default_rng(3)
    own = {"ha": [chr(0x4e00 + 8 * i) for i in range(300)], "hb": [chr(0x7000 + 8 * i) for i in range(300)]}
    text = {k: "".join(rng.choice(v, 4000)) for k, v in own.items()}
    parser = langid.CrossParser({"aa": [common * 100], **{k: [t] for k, t in text.items()}})
    assert parser.predict([text["hb"][100:400], text["ha"][7:300], "".join(own["hb"]), common])[0] == ["hb", "ha", "hb", "aa"]


def test_tables_follow_the_transitions():
    rng = np.random.default_rng(5)
    seq = (langid.LETTERS + rng.integers(0, 3000, langid.SAMPLE_SYMBOLS)).tolist()
    m = langid.Machine(seq, 4000)
    assert m.base.nbytes + m.owner.nbytes + m.next.nbytes < 8_000_000      # states x symbols: over 200 MB
    steps = np.array(seq[500:700], dtype=np.uint16)[:, None]
    assert m.phrases(steps).tolist() == [1]
    assert langid.part_length([5, 5, 100], 40) == 30 and langid.part_length([5, 5], 40) == 5
