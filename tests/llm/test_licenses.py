import math
import random
import re

import duckdb
from pyspark.sql import functions as F

from assay.llm import licenses as L

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(t):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def brute(text, templates, phrases, threshold):
    w = WORD.findall(lower(text or ""))
    places = [(i, label) for p, label in phrases.items() for i in range(len(w))
              if w[i:i + len(p.split())] == p.split()]
    spans = []
    for a, b, block in L.blocks(text or ""):
        assert block == {x.encode() for x in w[a:b]}
        for label, t in templates:
            tokens = set(L.words(t))
            shared = len(tokens & block)
            if tokens and shared >= math.ceil(threshold * len(tokens) - 1e-9) and shared:
                spans.append((label, a, b, shared / len(tokens)))
    at = [i for i, _ in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None),
            ",".join(sorted({label for _, label in places})), sorted(set(spans)))


TEXTS = [None, "", "!!", "Under the MIT License and the mit\nlicense; mit license.", "GENERAL public   license general public license",
         "All rights reserved.", "rights all\nreserved", "Licensed under CC BY-NC 4.0. More", "Ünder thé Äpache license É x",
         "apache-license apachelicense apache licenses", "word " * 3000 + "This work is licensed under the GNU General Public License, version 3. "
         + "word " * 3000, "x" * 100_000, "mit mit license license mit license"]


def check_notices(r, text, threshold):
    """Notices have enough of a template's words in order, close together, with its names;
    labels and score follow from them and the base phrases."""
    w = WORD.findall(lower(text or ""))
    for n in r.notices:
        inside = w[n.start:n.end]
        fits = []
        for label, t in L.TEMPLATES:
            tw = WORD.findall(lower(t))
            if label == n.label and len(inside) <= 2 * len(tw):
                rows = [[0] * (len(inside) + 1)]
                for x in tw:
                    rows.append([0])
                    for j, y in enumerate(inside):
                        rows[-1].append(rows[-2][j] + 1 if x == y else max(rows[-2][j + 1], rows[-1][j]))
                fits.append((rows[-1][-1] / len(tw), {x.decode() for x in L.names(t)} <= set(inside)))
        assert any(share >= threshold - 1e-9 and abs(share - n.in_order) < 1e-9 and named for share, named in fits), (n, inside)
    base = set(r.base_labels.split(",")) - {""}
    assert r.labels == ",".join(sorted(base | {n.label for n in r.notices}))
    assert r.score == max([1.0 * bool(base), *(n.in_order for n in r.notices)])


BY_HAND = [
    ("Licensed under the Apache License, Version 2.0.", "apache"), ("licensed under the apache license version 2.0", "apache"),
    ("This work is licensed under the GNU General Public License, version 3.", "gpl"),
    ("Licensed under CC BY 4.0.", "cc-by"), ("Licensed under CC BY-NC 4.0.", "cc-by-nc"), ("Licensed under CC BY-SA 4.0.", "cc-by-sa"),
    ("Licensed under the EUPL license.", ""), ("We released the new driver under the license of the city.", ""),
    ("Released under the MIT License.", "mit"), ("It is licensed under the MIT license.", "mit"),
    ("Released under the BSD 3-Clause License.", "bsd"), ("Released under the BSD 2-Clause License.", ""),
    ("This library is licensed under the GNU Lesser General Public License", "gpl,lgpl"),
    ("This program is licensed under the GNU Lesser General Public License", "gpl,lgpl"),
    ("This program is licensed under the GNU Affero General Public License", "agpl,gpl"),
    ("This library is licensed under the GNU General Public License", "gpl"),
    ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.", "mpl"),
    ("This work is licensed under a Creative Commons Attribution 4.0 International License.", "cc-by"),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "cc-by-nc"),
    ("This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.", "cc-by-sa"),
    ("All rights reserved.", "all-rights-reserved"), ("All the rights of way are reserved for walkers.", ""),
    ("This is free and unencumbered software released into the public domain.", "unlicense"),
    ("The software was released into the public domain.", ""),
    ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software", "mit"),
    ("Redistribution and use in source and binary forms, with or without modification, are permitted", "bsd"),
    ("A driving license is needed under the law of the state.", ""), ("The city licensed the general public school.", ""),
    ("Released under the MIT License. Licensed under CC BY 4.0.", "cc-by,mit"),
    ("Licensed under the Apache License, Version 2.0.\nLicensed under CC BY-NC 4.0.", "apache,cc-by-nc"),
    ("Students of MIT were released under the new rules; the license of the bar was not.", ""),
    ("You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0", "apache"),
]


def test_labels_of_sentences_labelled_by_hand(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(BY_HAND)], "id long, text string")
    got = {r.id: r.labels for r in L.scan(df).collect()}
    assert [(BY_HAND[i][0], got[i]) for i in got if got[i] != BY_HAND[i][1]] == []
    around = [(i, "Some words before it. " * 9 + t + " And some words after it." * 9) for i, (t, _) in enumerate(BY_HAND)]
    got = {r.id: r.labels for r in L.scan(spark.createDataFrame(around, "id long, text string")).collect()}
    assert [(BY_HAND[i][0], got[i]) for i in got if got[i] != BY_HAND[i][1]] == []


def test_label_sets_of_the_registered_query(spark):
    """The driver's documents hold five notices, each of one label."""
    from assay.llm.op7 import op7_license_scan
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    said = {"Released under the MIT License.": "mit", "Licensed under the Apache License, Version 2.0.": "apache",
            "GNU General Public License, version 3.": "gpl", "Licensed under CC BY-NC 4.0.": "cc-by-nc",
            "All rights reserved": "all-rights-reserved"}
    for r in op7_license_scan(spark, sf).collect():
        assert r.labels == ",".join(sorted({v for k, v in said.items() if k in texts[r.doc_id]})), (r.doc_id, r.labels)


def test_equals_brute_force(spark):
    rng = random.Random(4)
    vocabulary = sorted({t.decode() for _, x in L.TEMPLATES for t in L.words(x)}) + [f"w{i}" for i in range(20)]
    texts = TEXTS + [" ".join(rng.choices(vocabulary, k=rng.randrange(1, 60))) + rng.choice(["", "\n" + x]) for _, x in L.TEMPLATES * 8]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("labels", F.lit(0)) \
        .withColumn("Score", F.lit("s"))
    for threshold in (0.8, 0.5, 1.0):
        rows = L.scan(df, threshold=threshold).collect()
        got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, sorted({tuple(m) for m in r.matches})) for r in rows}
        for r in rows:
            check_notices(r, texts[r.doc_id], threshold)
        for i, t in enumerate(texts):
            assert got[i] == brute(t, L.TEMPLATES, L.BASE, threshold), (i, threshold, (t or "")[:60])
    assert L.scan(df.limit(0)).count() == 0
    assert L.scan(df, templates=[], phrases={}).agg(F.max("score")).first()[0] == 0.0


def test_registered_base_columns_equal_sql(spark):
    from assay.llm.op7 import op7_license_scan
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in op7_license_scan(spark, sf).collect()}
    con = duckdb.connect()
    con.execute("SET lambda_syntax='ENABLE_SINGLE_ARROW'")
    rows = con.execute(f"""SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') FROM '{sf}/documents.parquet'""").fetchall()
    assert len(rows) == len(got)
    labelled = 0
    for d, w in rows:
        line = " " + " ".join(w) + " "
        labels = ",".join(sorted(v for k, v in L.BASE.items() if f" {k} " in line))
        assert (got[d].n_words, got[d].base_labels) == (len(w), labels)
        assert got[d].n_base >= bool(labels) and set(labels.split(",")) - {""} <= set(got[d].labels.split(","))
        labelled += bool(labels)
    assert labelled > 20


def test_notices_wrapped_over_lines_and_long_templates(spark):
    heads = {"bsd": "Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided",
             "mpl": " * This Source Code Form is subject to the terms of the Mozilla Public\n * License, v. 2.0. If a copy",
             "gpl": "This program is free software: you can redistribute it and/or modify\nit under the terms of the GNU General Public\nLicense as published"}
    before, after = "one two three\n" * 40, "\nfour five six" * 40
    own = " ".join(f"t{i}" for i in range(150))
    texts = {**{k: before + v + after for k, v in heads.items()}, "own": "x " * 70 + own + " y" * 300,
             "wrapped": "x\n" * 70 + own.replace(" ", "\n") + "\ny" * 300}
    df = spark.createDataFrame(list(texts.items()), "id string, text string")
    got = {r.id: r for r in L.scan(df, templates=[*L.TEMPLATES, ("own", own)]).collect()}
    usual = {r.id: r for r in L.scan(df).collect()}
    for k in heads:
        assert k in usual[k].labels.split(",") and k in got[k].labels.split(",")
        assert max(m.containment for m in usual[k].matches if m.label == k) == 1.0
    assert got["own"].labels == got["wrapped"].labels == "own" and got["own"].score == got["wrapped"].score == 1.0


def test_any_words_in_a_row_share_a_block():
    rng = random.Random(2)
    for most in (3, 22, 150):
        for n in (1, 50, 200, 700):
            text = "".join(f"w{i}" + rng.choice([" ", " ", "\n"]) for i in range(n))
            got = L.blocks(text, most)
            for a in range(max(1, n - 2 * most + 1)):
                assert any(x <= a and min(a + 2 * most, n) <= y for x, y, _ in got)
