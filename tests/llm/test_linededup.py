import collections
import itertools
import random
import re
import string
import unicodedata

import xxhash

from pyspark.sql import functions as F

from assay.llm import linededup as L


def key(text):
    return xxhash.xxh64_intdigest(text, 42) & 0x7FFFFFFF


WORD = re.compile(rf"[{L.UNSPACED}]|[^\s{re.escape(string.punctuation)}{L.ENDS}{L.UNSPACED}]++")
TOKEN = re.compile(rf"\n|{WORD.pattern}")


def can_end(word):
    return L.read(word).hashes[0] % L.RATE == 0


def weight(word):
    return 1 / L.WORD_LETTERS if re.match(f"[{L.UNSPACED}]", word) else 1


def cut(text):
    """Chunks of a text as lists of (normalised word, line number), word by word."""
    chunks, now, line = [], [], 0
    for t in TOKEN.findall(text):
        if t == "\n":
            line += 1
        else:
            now.append((unicodedata.normalize("NFKC", t).casefold(), line))
        if now and (t == "\n" or len(now) == L.MOST or (len(now) >= L.LEAST and can_end(t))):
            chunks.append(now)
            now = []
    return chunks + ([now] if now else [])


def sentence_starts(text):
    """Numbers of the words that begin a sentence or line."""
    out, n, end = [0], 0, 0
    for m in TOKEN.finditer(text):
        if m.group() == "\n":
            continue
        between = text[end:m.start()]
        if n and ("\n" in between or any(c in L.ENDS or (c in ".!?" and between[k + 1:k + 2].isspace()) for k, c in enumerate(between))):
            out.append(n)
        n, end = n + 1, m.end()
    return out


def brute(rows, min_words):
    """Words that stay of every row: earliest occurrence of every chunk by (id, text, place),
    later ones marked, passages extended along their kept copy, long ones and whole lines
    or documents removed."""
    docs = {(L.LAST_RANK if i is None else i, key(t)): cut(t) for i, t in rows if t}
    first = {}
    for (i, k), chunks in docs.items():
        for n, c in enumerate(chunks):
            words = tuple(w for w, _ in c)
            first[words] = min(first.get(words, (i, k, n)), (i, k, n))
    out = []
    for i, t in rows:
        me = (L.LAST_RANK if i is None else i, key(t) if t else 0)
        chunks = docs.get(me, [])
        flat = [w for c in chunks for w in c]
        at = [sum(map(len, chunks[:n])) for n in range(len(chunks) + 1)]
        kept = [first[tuple(w for w, _ in c)] for c in chunks]
        again = [n for n in range(len(chunks)) if kept[n] != (*me, n)]
        rows_of = [[n for _, n in g] for _, g in itertools.groupby(enumerate(again), lambda x: x[1] - x[0])]
        marked = {n for g in rows_of if sum(len(chunks[n]) for n in g) >= L.WHOLE_WORDS for n in g}
        held = {p for n in marked for p in range(at[n], at[n + 1])}
        for n in list(marked):
            if n - 1 in marked and n + 1 in marked:
                continue
            run = [n]
            while run[0] - 1 in marked:
                run.insert(0, run[0] - 1)
            while run[-1] + 1 in marked:
                run.append(run[-1] + 1)
            word = {d: [0, *itertools.accumulate(map(len, docs[d]))] for d in {kept[j][:2] for j in run}}
            votes = collections.Counter((kept[j][0], (kept[j][1] << 26) + word[kept[j][:2]][kept[j][2]] - (me[1] << 26) - at[j]) for j in run)
            where, shift = min(votes, key=lambda v: (-votes[v], v))
            text_of, place = divmod(shift + (me[1] << 26) + at[n], 1 << 26)
            theirs = [w for c in docs.get((where, text_of), []) for w, _ in c]
            theirs_end = place + len(chunks[n])
            if theirs_end > len(theirs):
                continue
            floor = theirs_end if (where, text_of) == me else 0
            begins = sentence_starts(t)
            if n - 1 not in marked:
                m = 0
                while m < min(L.EXTEND, place, at[n] - floor) and flat[at[n] - m - 1][0] == theirs[place - m - 1]:
                    m += 1
                inner = [p for p in begins if at[n] - m < p <= at[n]]
                if inner and at[n] - m not in begins and inner[0] - (at[n] - m) < L.EDGE:
                    m = at[n] - inner[0]        # too little of a further sentence
                held.update(range(at[n] - m, at[n]))
            if n + 1 not in marked:
                m, end = 0, at[n + 1]
                while m < min(L.EXTEND, len(flat) - end, len(theirs) - theirs_end) and flat[end + m][0] == theirs[theirs_end + m]:
                    m += 1
                inner = [p for p in begins if end <= p < end + m]
                if inner and end + m < len(flat) and end + m not in begins and end + m - inner[-1] < L.EDGE:
                    m = inner[-1] - end
                held.update(range(end, end + m))
        gone = set()
        for g in [list(x) for _, x in itertools.groupby(range(len(flat)), lambda p: p in held)]:
            if g[0] in held and sum(weight(flat[p][0]) for p in g) >= min_words:
                gone.update(g)
        lines = [list(x) for _, x in itertools.groupby(range(len(flat)), lambda p: flat[p][1])]
        for g in [*lines, list(range(len(flat)))]:
            if held.issuperset(g) and sum(weight(flat[p][0]) for p in g) >= min(L.WHOLE_WORDS, min_words):
                gone.update(g)
        out.append((i, None if t is None else [w for p, (w, _) in enumerate(flat) if p not in gone]))
    return sorted(out, key=repr)


def staying(result):
    """The same of an operator's result."""
    return sorted(((r.doc_id, None if r.text is None else [w for c in cut(r.text) for w, _ in c]) for r in result), key=repr)


def test_words_and_chunks(monkeypatch):
    rng = random.Random(1)
    for k, n in enumerate((0, 1, 5, 200, 300)):
        monkeypatch.setattr(L, "SLICE", 1 << 20 if k < 4 else 90)
        text = "".join(rng.choice(["la ", f"w{rng.randrange(99)} ", "\n", ". ", "\u00e9\u00d1x-v1.5 ", "\u4e00\u4e8c", "\ufb01n "]) for _ in range(n)) + "same " * n
        words, want = L.read(text), cut(text)
        assert [text[a:b] for a, b in zip(words.begin, words.end)] == [m for m in TOKEN.findall(text) if m != "\n"]
        starts = words.chunks()
        assert starts.tolist() == [sum(map(len, want[:j])) for j in range(len(want))]
        if n:
            by_words = {}
            for d, chunk in zip(L.chunk_digests(words.hashes, starts).tolist(), want):
                assert by_words.setdefault(tuple(w for w, _ in chunk), d) == d
            assert len(set(by_words.values())) == len(by_words)
    assert (L.read("STRASSE \uff21b").hashes == L.read("strasse Ab").hashes).all()


def test_passage_inside_and_over_lines_is_removed_once(spark):
    passage = "Alpha beta gamma delta. " + " ".join(f"p{i}" for i in range(30)) + ".\nOmega " + "psi " * 25 + "end."
    rows = [(1, f"Start one. {passage}\nTail one."), (2, f"Start two. {passage} Tail two."),
            (3, passage), (0, "Clean text. Start one."), (4, "Only a short line.\nStart one."), (5, None), (6, ""),
            (7, "Long. " * 20_000), (None, passage + " Own words."), (2, f"Start two. {passage} Tail two.")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("removed", F.lit(1)) \
        .withColumn("marked", F.lit("x")).withColumn("doc", F.lit("y"))
    res = L.deduplicate(df)
    assert res.columns == ["doc_id", "marked", "doc", "text", "removed"]
    assert staying(res.collect()) == brute(rows, L.MIN_WORDS)
    by = {r.doc_id: (r.doc_id, r.text, [tuple(x) for x in r.removed]) for r in res.collect()}
    assert by[1][1] == rows[0][1] and by[2][1] == "Start two. Tail two." and by[3][1] == ""
    assert by[0][1] == rows[3][1] and by[4][1] == rows[4][1]
    start, end = by[2][2][0]
    assert rows[1][1][start:end].strip() == passage
    assert L.deduplicate(df.limit(0)).count() == 0


def test_random_corpus_like_brute_force(spark):
    rng = random.Random(9)
    sentences = [" ".join(f"w{rng.randrange(200)}" for _ in range(rng.randrange(1, 14))) + "." for _ in range(120)]
    rows = [(i, rng.choice([" ", "\n"]).join(rng.choices(sentences, k=rng.randrange(1, 25)))) for i in range(80)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = L.deduplicate(df, min_words=8).collect()
    assert staying(got) == brute(rows, 8)
    assert any(r.removed for r in got)


def test_registered_form_on_mixed_passages_like_brute_force(spark):
    rng = random.Random(12)
    vocabulary = [f"v{k}" for k in range(900)]
    passages = [rng.choices(vocabulary, k=n) for n in (18, 30, 40, 55, 70, 90)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(1, 4)):
            words += [f"o{i}x{rng.randrange(10 ** 6)}" for _ in range(rng.randrange(0, 30))]
            if rng.random() < 0.6:
                words += rng.choice(passages)
        rows.append((i, "".join(w + rng.choice([" ", " ", " ", ". ", "\n", ", "]) for w in words)))
    df = spark.createDataFrame([*rows, rows[3], (None, rows[4][1])], "doc_id long, text string")
    got = L.deduplicate(df, keep=["doc_id", "text"])
    assert got.columns == ["doc_id", "text", "removed"]
    assert staying(got.collect()) == brute([*rows, rows[3], (None, rows[4][1])], L.MIN_WORDS)


def test_repeated_paragraph_without_spaces(spark):
    rng = random.Random(3)
    han = ["".join(chr(0x4e00 + rng.randrange(2000)) for _ in range(30)) + "\u3002" for _ in range(6)]
    thai = "".join(chr(0x0e01 + rng.randrange(40)) for _ in range(200))
    rows = [(1, "\u4e00\u4e8c\u3002" + "".join(han[:5])), (2, "\u4e09\u56db\u3002" + "".join(han[:5]) + han[5]),
            (3, thai), (4, "x y\n" + thai), (5, han[0] + "\u4e94")]
    got = {r.doc_id: r.text for r in L.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: rows[0][1], 2: "\u4e09\u56db\u3002" + han[5], 3: thai, 4: "x y", 5: rows[4][1]}


def test_passages_inside_sentences(spark):
    rng = random.Random(7)

    def own(n):
        return " ".join(f"x{rng.randrange(10 ** 9)}" for _ in range(n))

    rows, want, k = [], {}, 0
    for n in (25, 30, 51, 58, 80):
        for stops in (False, True):
            w = own(n).split()
            passage = " ".join(x + "." * (stops and j % 13 == 5) for j, x in enumerate(w))
            for copy in range(4):
                a, b = own(10), own(10)
                rows.append((k, f"{a} {passage} {b}. {own(5)}."))
                want[k] = (rows[-1][1] if not copy else rows[-1][1].replace(passage, "")).split()
                k += 1
    w = own(40)
    rows += [(k, f"{own(3)} {w} {own(4)} {w} {own(5)}"), (k + 1, "la " * 300), (k + 2, own(12)), (None, None)]
    rows.append((k + 3, rows[k + 2][1] + " " + own(12)))
    df = spark.createDataFrame([*rows, *rows[:5]], "doc_id long, text string")
    got = {r.doc_id: r for r in L.deduplicate(df).collect()}
    for i, x in want.items():
        assert got[i].text.split() == x, (i, rows[i][1], got[i].text)
    assert got[k].text.count(w) == 1 and len(got[k].text.split()) == 52
    assert got[k + 1].text.split().count("la") >= 1 and got[k + 3].text == rows[-1][1] and got[None].text is None
    r = got[1]
    assert "".join(c for j, c in enumerate(rows[1][1]) if not any(a <= j < b for a, b in r.removed)).split() == want[1]


def test_whole_lines_and_documents_under_the_bound(spark):
    line = "All of these words stand here. Again."
    rows = [(1, f"Own one.\n{line}\nOwn end."), (2, f"Own two.\n{line}\nOwn last."), (3, f"In a line {line}"),
            (4, "Short one.\nShort two.\nShort three."), (5, "Short one.\nShort two.\nShort three."), (6, "Short one.\nNew.")]
    got = {r.doc_id: r.text for r in L.deduplicate(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {**dict(rows), 2: "Own two.\nOwn last.", 5: ""}


def test_clashing_columns_bad_bytes_and_extra_rows(spark):
    words = " ".join(f"b{k}" for k in range(60))
    df = spark.createDataFrame([(1, f"a {words} z"), (2, f"c {words} d")], "doc_id long, text string") \
        .withColumn("key", F.lit("k")).withColumn("ends", F.lit("e")).withColumn("h", F.lit(3))
    broken = df.unionByName(df.limit(1).withColumn("doc_id", F.lit(9).cast("long"))
                            .withColumn("text", F.expr("cast(concat(X'61FF6220', encode(text, 'UTF-8')) as string)")))
    got = {r.doc_id: r for r in L.deduplicate(broken).collect()}
    assert got[1].text == f"a {words} z" and got[2].text == "c d" and got[2].key == "k" and got[2].ends == "e" and got[2].h == 3
    assert got[9].text.startswith("a") and "b30" not in got[9].text
