"""License scan by exact set-similarity join with containment.

Text blocks and license templates are sets of tokens.  Blocks are the lines (a long line in
overlapping windows) and windows over the words of the whole text that run on over line
breaks, so a notice wrapped over lines is met as well; the windows grow with the longest template.  A block matches a template when it holds at least ``threshold`` of the template's
tokens.  Tokens are ordered globally by how many blocks hold them, rarest first, counted
over the whole table:

* prefix: a template of n tokens needs ``need = ceil(threshold * n)`` of them, so a matching
  block holds one of the template's ``n - need + 1`` rarest; only those are indexed;
* length: a block with fewer template tokens than ``need`` cannot match;
* positional: when the first shared token stands at place i of the template and j of the
  block's ordered template tokens, at most ``1 + min(n - i, m - j) - 1`` tokens are shared;
* what remains is verified by intersecting the sets.

Every block is tested against every template this way, and the result (``matches``) is exact.
A label needs more than shared tokens: a match becomes a notice when, within twice the
template's length, at least ``threshold`` of its words stand in the template's order and
its names are among them.  Names come from the template itself: the words written with a
capital after its first word, and those with a digit (MIT, Apache, Lesser, NC, 4).  Of
notices of several labels over the same words, one whose names are all among another's
gives way (CC BY to CC BY-NC).  The
templates are a bounded table (``MAX_TEMPLATES``) that travels with the task, so documents
are never shuffled; the counts are one partial aggregate per token of the templates.

Words are runs of ASCII letters and digits and of all other non-ASCII characters, A-Z
lower-cased.  Base phrases are found by their words in a row, wherever they stand.

Edge cases: null text is empty text (no words, empty labels, score 0); a template without
tokens matches nothing; equal templates and labels count once; invalid bytes read as U+FFFD.
"""

from __future__ import annotations

import bisect
import math
import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm._common import append_columns, col, decoded, held, small_batches

THRESHOLD = 0.8
MAX_TEMPLATES = 10_000
WINDOW = 96                     # words of a block of a long line, at least; half of it from one to the next

#: Keeps ASCII digits and letters (lower-cased) and all bytes of non-ASCII characters;
#: everything else separates words.
KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))

#: Phrases and the label of each (fixed values).
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

#: Short license notices and the label of each (fixed values: their usual public wording).
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("mit", "Released under the MIT License."),
    ("mit", "Licensed under the MIT license."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("apache", "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0"),
    ("gpl", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License"),
    ("lgpl", "This library is licensed under the GNU Lesser General Public License"),
    ("agpl", "This program is licensed under the GNU Affero General Public License"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("bsd", "Released under the BSD 3-Clause License."),
    ("mpl", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("cc-by", "Licensed under CC BY 4.0."),
    ("cc-by-nc", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa", "Licensed under CC BY-SA 4.0."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("cc0", "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work."),
    ("unlicense", "This is free and unencumbered software released into the public domain."),
    ("all-rights-reserved", "All rights reserved."),
]

OUT = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_base", T.LongType()),
    T.StructField("first_word", T.LongType()), T.StructField("last_word", T.LongType()),
    T.StructField("base_labels", T.StringType()), T.StructField("labels", T.StringType()),
    T.StructField("score", T.DoubleType()),
    T.StructField("matches", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("containment", T.DoubleType())]))),
    T.StructField("notices", T.ArrayType(T.StructType([
        T.StructField("label", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
        T.StructField("in_order", T.DoubleType())])))])


def words(text: str) -> list[bytes]:
    return text.encode().translate(KEEP).split()


NAME = re.compile(r"[A-Z0-9]")


def names(text: str) -> frozenset[bytes]:
    """Words of a template that name its license: with a capital after the first word, or
    with a digit."""
    written = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)
    return frozenset(words(w)[0] for k, w in enumerate(written) if any(c.isdigit() for c in w) or (k and NAME.search(w)))


def in_order(template: list[bytes], text: list[bytes]) -> list[tuple[int, int]]:
    """(template word, text word) pairs of a longest common subsequence."""
    n, m = len(template), len(text)
    best = [[0] * (m + 1) for _ in range(n + 1)]
    for i in range(n - 1, -1, -1):
        row, below = best[i], best[i + 1]
        for j in range(m - 1, -1, -1):
            row[j] = below[j + 1] + 1 if template[i] == text[j] else max(below[j], row[j + 1])
    out, i, j = [], 0, 0
    while i < n and j < m:
        if template[i] == text[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        elif best[i + 1][j] >= best[i][j + 1]:
            i += 1
        else:
            j += 1
    return out


def longest(templates: list[tuple[str, str]]) -> int:
    """Words of the longest template, 1 at least."""
    return max((len(words(text)) for _, text in templates), default=0) or 1


LONGEST = longest(TEMPLATES)


def blocks(text: str, most: int = LONGEST) -> list[tuple[int, int, set[bytes]]]:
    """(first word, word after the last, token set) of a text's blocks, for templates of at
    most ``most`` words: any ``2 * most`` words in a row stand together in one block."""
    out, ends, every, at = [], [], [], 0
    window = max(WINDOW, 4 * most)
    stride = window // 2
    for line in text.encode().translate(KEEP_LINES).split(b"\n"):
        w = line.split()
        if len(w) <= window:
            out.append((at, at + len(w), set(w)))
        else:
            out += [(at + a, at + min(a + window, len(w)), set(w[a:a + window])) for a in range(0, len(w) - stride, stride)]
        at += len(w)
        if w:
            ends.append(at)
            every += w
    if len(ends) > 1:
        for a in range(0, max(1, at - 2 * most), most):
            b = min(a + 3 * most, at)
            if ends[bisect.bisect_right(ends, a)] < b:      # not inside one line
                out.append((a, b, set(every[a:b])))
    return out


KEEP_LINES = KEEP[:10] + b"\n" + KEEP[11:]


class Templates:
    """Templates as token tuples in the global order, and the index of their prefixes."""

    def __init__(self, templates: list[tuple[str, str]], frequency: dict[bytes, int], threshold: float):
        if len(templates) > MAX_TEMPLATES:
            raise ValueError(f"at most {MAX_TEMPLATES} templates")
        sets: dict = {}
        for label, text in sorted(templates):
            sets.setdefault((label, frozenset(words(text))), []).append((words(text), names(text)))
        vocabulary = {t for _, s in sets for t in s}
        self.threshold, self.wordings = threshold, []
        self.rank = {t: i for i, t in enumerate(sorted(vocabulary, key=lambda t: (frequency.get(t, 0), t)))}
        self.items, self.index = [], {}
        for label, tokens in sorted(sets, key=lambda x: (x[0], sorted(x[1]))):
            order = sorted(self.rank[t] for t in tokens)
            if not order:
                continue
            need = max(1, math.ceil(threshold * len(order) - 1e-9))
            for place, r in enumerate(order[:len(order) - need + 1]):
                self.index.setdefault(r, []).append((len(self.items), place))
            self.items.append((label, order, frozenset(order), need))
            self.wordings.append([(w, n, {t for t in tokens if self.rank[t] in order[:len(order) - need + 1]})
                                  for w, n in sets[label, tokens]])
        self.prefix = {t for t, r in self.rank.items() if r in self.index}

    def notices(self, text: list[bytes], blocks_: list[tuple[int, int, int]]) -> list[tuple[str, int, int, float]]:
        """(label, first word, word after the last, share of words in order) of the notices
        in the blocks (template, first word, word after the last) of a text."""
        found = {}
        for item, a, b in blocks_:
            for w, named, rare in self.wordings[item]:
                for at in [k for k in range(a, b) if text[k] in rare]:
                    low = max(a, at - len(w))
                    pairs = in_order(w, text[low:min(b, at + len(w))])
                    if pairs and len(pairs) >= math.ceil(self.threshold * len(w) - 1e-9) and named <= {w[i] for i, _ in pairs}:
                        place = (self.items[item][0], low + pairs[0][1], low + pairs[-1][1] + 1)
                        found[place] = max(found.get(place, (0.0,)), (len(pairs) / len(w), sorted(named)))
        return sorted((label, a, b, share) for (label, a, b), (share, named) in found.items()
                      if not any(label != other and a < y and x < b and set(named) < set(more)
                                 for (other, x, y), (_, more) in found.items()))

    def matches(self, block: set[bytes]) -> list[tuple[int, str, float]]:
        """(template, label, containment) of every template the block holds enough of."""
        if self.prefix.isdisjoint(block):
            return []
        mine = sorted(self.rank[t] for t in block.intersection(self.rank))
        have, seen, out = set(mine), set(), []
        for r in mine:
            for item, place in self.index.get(r, ()):
                if item in seen:
                    continue
                seen.add(item)
                label, order, tokens, need = self.items[item]
                after = len(mine) - bisect.bisect_right(mine, r)
                if len(mine) < need or 1 + min(len(order) - place - 1, after) < need:
                    continue
                shared = len(tokens & have)
                if shared >= need:
                    out.append((item, label, shared / len(order)))
        return out


class Phrases:
    """Base phrases by their first word."""

    def __init__(self, phrases: dict[str, str]):
        self.starts: dict[bytes, list] = {}
        for text, label in phrases.items():
            w = words(text)
            if w:
                self.starts.setdefault(w[0], []).append((w, label))
        self.rarest = {max(w, key=len) for v in self.starts.values() for w, _ in v}

    def places(self, w: list[bytes]) -> list[tuple[int, str]]:
        """(first word's place, label) of every place where a phrase stands."""
        present = set(w)
        if self.rarest.isdisjoint(present):
            return []
        out = []
        for first in self.starts.keys() & present:
            at = -1
            for _ in range(w.count(first)):
                at = w.index(first, at + 1)
                out += [(at, label) for p, label in self.starts[first] if w[at:at + len(p)] == p]
        return out


def token_frequency(docs: DataFrame, templates: list[tuple[str, str]], text_col: str = "text") -> dict[bytes, int]:
    """In how many blocks of the whole table each token of the templates stands."""
    vocabulary, most = {t for _, text in templates for t in words(text)}, longest(templates)

    def run(batches):
        seen: Counter = Counter()
        for b in batches:
            for t in decoded(b.column(0)):
                if t:
                    for _, _, block in blocks(t, most):
                        seen.update(block & vocabulary)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), type=pa.binary()),
                                          pa.array(list(seen.values()), type=pa.int64())], names=["token", "n"])

    rows = small_batches(docs.select(col(text_col).cast("string").alias("t"))).mapInArrow(run, "token binary, n long") \
        .groupBy("token").agg(F.sum("n").alias("n")).collect()       # one row per template token at most
    return {bytes(r["token"]): r["n"] for r in rows}


def scan(docs: DataFrame, templates: list[tuple[str, str]] | None = None, phrases: dict[str, str] | None = None,
         threshold: float = THRESHOLD, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with word count, base places and labels, all labels, ``score`` (the largest
    share of a template's words a notice has in order, 1 for a base phrase, else 0),
    ``matches``: every (template label, block) that reaches the threshold, the block as word
    offsets, and ``notices``: those that stand as the module tells."""
    templates = TEMPLATES if templates is None else templates
    phrases = BASE if phrases is None else phrases
    frequency, most = token_frequency(docs, templates, text_col), longest(templates)

    def factory():
        index, base = held(("licenses", *templates, *phrases.items(), *sorted(frequency.items()), threshold),
                           lambda: (Templates(templates, frequency, threshold), Phrases(phrases)))

        def one(text: str | None) -> tuple:
            w = words(text) if text else []
            found = base.places(w)
            labels = {label for _, label in found}
            at = [p for p, _ in found]
            hits = [] if not w or index.prefix.isdisjoint(w) else \
                [(item, label, a, b, s) for a, b, block in blocks(text, most) for item, label, s in index.matches(block)]
            notices = index.notices(w, [(item, a, b) for item, _, a, b, _ in hits])
            score = max([1.0 if found else 0.0, *(s for *_, s in notices)])
            return (len(w), len(found), min(at, default=None), max(at, default=None), ",".join(sorted(labels)),
                    ",".join(sorted(labels | {n[0] for n in notices})), score,
                    [{"label": label, "start": a, "end": b, "containment": s} for _, label, a, b, s in hits],
                    [dict(zip(("label", "start", "end", "in_order"), n)) for n in notices])

        return lambda cols: [list(c) for c in zip(*[one(t) for t in decoded(cols[0])])]

    return append_columns(docs, [text_col], OUT, factory, keep)
