"""Repeated-passage removal by hashing chunks of lines.

A line is cut into chunks by its content: after a word whose hash is a multiple of ``RATE``
if the chunk has ``LEAST`` words, after ``MOST`` words without one, and at the line's end.
Two copies of a passage thus soon have the same chunks, wherever it starts or ends.  Words
are normalised character by character (NFKC, case-folded, punctuation dropped); a chunk is known by a 64-bit hash of its words.
Chunks are grouped over the whole table; the occurrence with the smallest (doc_id, place)
stays and every later one is marked.  Marked chunks that stand next to each other form a
passage, which is extended word by word to both sides as far as the words around its kept
copy (where most of its chunks are kept) agree; one or two words of a further sentence that
happen to agree stay, and so does what has fewer than ``WHOLE_WORDS`` words in such chunks.
Passages of ``min_words`` words or more are removed, shorter ones (a common
greeting) stay inside a line.  A whole line or document that is marked goes from
``WHOLE_WORDS`` words on.  Scripts that put no space between words count four letters as a
word.  The removed spans are returned as offsets into the original text.

Texts are hashed once: the chunk table is written to the shared folder.  The smallest
occurrence per hash is an aggregate with map-side combine, the marking a join on the hash
(skewed hashes are split by AQE), and only marked chunks travel back to their document, so
a chunk that stands in a third of all documents is never gathered.  The words around a kept
copy are taken only for the ends of passages, from the texts that hold those copies.

Edge cases: null text gives null text and no spans; rows that repeat both doc_id and text
are one document stored twice and get the same result; a null doc_id ranks after all
others; text without a word is never marked and does not end a passage; a passage without a
whole chunk of its own stays (about one in 6 of 25 words, one in 100 of 50 words and fewer of
longer ones); invalid bytes read as U+FFFD.
"""

from __future__ import annotations

import re
import string
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm._common import append_columns, col, cut, decoded, held, small_batches, written
from assay.operators._small import attach

MIN_WORDS = 25
WHOLE_WORDS = 5             # of a whole line or document
ENDS = "\u3002\uff01\uff1f\uff61\uff0e\u0964\u0965\u061f\u06d4\u104b\u17d4\u1362"     # sentence ends that need no space after them
#: Letters of scripts without spaces between words: Han, Kana, Thai, Lao, Tibetan, Myanmar, Khmer.
UNSPACED = "\u3005-\u3007\u3041-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d" \
    "\u0e01-\u0e4e\u0e81-\u0ecd\u0f40-\u0fbc\u1000-\u109f\u1780-\u17d3\U00020000-\U0003ffff"
WORD_LETTERS = 4
OPENING = "([{\"'\u2018\u201c\u00ab\u00bf\u00a1\u300c\u300e\u3008\u300a\uff08"     # belongs to the word after it
RATE, LEAST, MOST = 6, 3, 48        # one word in so many can end a chunk; words of a chunk
EXTEND = 48                 # words compared beyond an end of a passage
EDGE = 3                    # words of a further sentence that an extension has to share
STOP = re.compile(rf"\n|[.!?]\s|[{ENDS}]")
LAST_RANK = 2**63 - 1       # a null doc_id ranks after every other

SPAN = T.ArrayType(T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
OUT = T.StructType([T.StructField("text", T.StringType()), T.StructField("removed", SPAN)])


SLICE = 1 << 20             # characters read at once; a longer word is cut there
_BASE, _MIX = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0xFF51AFD7ED558CCD)


def character_tables() -> tuple[np.ndarray, np.ndarray]:
    """Of every code point: 0 between words, 1 in a word, 2 a word of its own; and what it
    is normalised to (a number that stands for several characters, if it must)."""
    kind, fold = np.ones(0x110000, dtype=np.uint8), np.arange(0x110000, dtype=np.uint32)
    unspaced = re.compile(f"[{UNSPACED}]")
    for cp in range(0x30000):
        c = chr(cp)
        if c.isspace() or c in string.punctuation or c in ENDS:
            kind[cp] = 0
        elif cp >= 0xE00 and unspaced.match(c):
            kind[cp] = 2
        n = unicodedata.normalize("NFKC", c).casefold() if cp >= 128 else c.lower()
        if n != c:
            fold[cp] = ord(n) if len(n) == 1 else 0x110000 + (xxhash.xxh32_intdigest(n) >> 1)
    return kind, fold


@dataclass
class Words:
    """Of every word of a text: a hash, first character, character after the last, and the
    line it stands in; ``letters`` tells letters of unspaced scripts."""
    hashes: np.ndarray
    begin: np.ndarray
    end: np.ndarray
    line: np.ndarray
    letters: np.ndarray

    def chunks(self) -> np.ndarray:
        """First word of every chunk."""
        n = len(self.hashes)
        if not n:
            return np.zeros(0, dtype=np.int64)
        forced = self.line[1:] != self.line[:-1]
        after = np.flatnonzero(forced | (self.hashes[:-1] % np.uint64(RATE) == 0))
        starts, last = [0], 0
        for p, must in zip((after + 1).tolist(), forced[after].tolist()):
            if must or p - last >= LEAST:
                starts.append(p)
                last = p
        starts = np.array(starts)
        if np.diff(np.append(starts, n)).max() > MOST:
            starts = np.concatenate([np.arange(a, b, MOST) for a, b in zip(starts, np.append(starts[1:], n))])
        return starts

    def weights(self) -> np.ndarray:
        """1 for a word, a quarter for a letter of an unspaced script."""
        return np.where(self.letters, 1 / WORD_LETTERS, 1.0)


def read(text: str) -> Words:
    kind_of, fold = held("dedup-tables", character_tables)
    parts, at, lines = [], 0, 0
    while True:
        cp = np.frombuffer(text[at:at + SLICE].encode("utf-32-le", "replace"), dtype=np.uint32)
        kind = kind_of[cp]
        if at + SLICE < len(text):
            gaps = np.flatnonzero(kind == 0)
            if len(gaps):
                cp, kind = cp[:gaps[-1] + 1], kind[:gaps[-1] + 1]
        inside, own = kind > 0, kind == 2
        before = np.concatenate([[False], inside[:-1]])
        first = inside & (~before | own | np.concatenate([[False], own[:-1]]))
        begin, spots = np.flatnonzero(first), np.flatnonzero(inside)
        number = np.cumsum(first)[spots] - 1
        size = np.bincount(number, minlength=len(begin))
        power = np.concatenate([np.ones(1, dtype=np.uint64), np.cumprod(np.full(int(size.max(initial=1)), _BASE, dtype=np.uint64))])
        terms = (fold[cp[spots]].astype(np.uint64) + np.uint64(1)) * power[spots - begin[number]]
        h = np.add.reduceat(terms, np.cumsum(size) - size) if len(begin) else np.zeros(0, dtype=np.uint64)
        h = (h ^ (h >> np.uint64(31))) * _MIX
        breaks = np.cumsum(cp == 10)
        parts.append((h ^ (h >> np.uint64(29)), begin + at, begin + size + at, breaks[begin] + lines, own[begin]))
        at += len(cp)
        lines += int(breaks[-1]) if len(breaks) else 0
        if at >= len(text):
            return Words(*(np.concatenate(c) for c in zip(*parts)))


def chunk_digests(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """64-bit hash of every chunk."""
    place = np.arange(len(words)) - np.repeat(starts, np.diff(np.append(starts, len(words))))
    power = np.cumprod(np.full(MOST, 0x9E3779B97F4A7C15, dtype=np.uint64))
    h = np.add.reduceat((words ^ (words >> np.uint64(29))) * power[place], starts)
    h = (h ^ (h >> np.uint64(32))) * np.uint64(0xFF51AFD7ED558CCD)
    return (h ^ (h >> np.uint64(29))).view(np.int64)


def chunk_table(docs: DataFrame) -> DataFrame:
    """``(h, doc, place)``: one row per chunk of ``docs(doc, key, text)``; ``place`` holds
    the text's key (which tells apart texts of one id), the chunk's first word and its words (6
    bits), so that (doc, place) ranks the occurrences."""
    names = ["h", "doc", "place"]

    def run(batches):
        for b in batches:
            got: list[list] = [[], [], []]
            for doc, key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), decoded(b.column(2))):
                if not text:
                    continue
                words = read(text)
                starts = words.chunks()
                if not len(starts):
                    continue
                h, n = chunk_digests(words.hashes, starts), np.diff(np.append(starts, len(words.hashes)))
                for column, v in zip(got, (h, np.full(len(h), doc), (starts << 6) + n + (key << 32))):
                    column.append(v)
            if got[0]:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(g), pa.int64()) for g in got], names=names)

    return small_batches(docs.select("doc", "key", "text")).mapInArrow(run, "h long, doc long, place long")


def passages(found: DataFrame) -> DataFrame:
    """``(doc, a, z, kept_doc, shift)``: places of the first and last chunk of every row of
    neighbouring chunks that have a smaller occurrence, and the text and distance at which
    most of them are kept."""
    place = F.struct("doc", "place")
    first = found.groupBy("h").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")) \
        .where("n > 1").select("h", "first")
    # Cut here, so that the join's inputs are plain shuffles whose hot digests AQE can split.
    first = cut(first)
    # a document stored twice gives its chunks twice
    later = found.join(first, "h").where(place != F.col("first")) \
        .select("doc", "place", F.struct(F.col("first.doc").alias("doc"), (F.col("first.place") - F.col("place")).alias("shift"))
                .alias("kept")).distinct()
    order = Window.partitionBy("doc", F.shiftright("place", 32)).orderBy("place")
    begin = F.shiftright("place", 6)
    end = begin + F.col("place").bitwiseAND(63)
    apart = F.coalesce(F.lag(end).over(order) != begin, F.lit(True)).cast("int")
    return later.withColumn("apart", apart).withColumn("run", F.sum("apart").over(order)) \
        .groupBy("doc", F.shiftright("place", 32).alias("key"), "run") \
        .agg(F.min("place").alias("a"), F.max("place").alias("z"), F.mode("kept", True).alias("kept"),
             F.sum(F.col("place").bitwiseAND(63)).alias("words")).where(F.col("words") >= WHOLE_WORDS) \
        .select("doc", "a", "z", F.col("kept.doc").alias("kept_doc"), F.col("kept.shift").alias("shift"))


def around(ends: DataFrame, rows: DataFrame) -> DataFrame:
    """``(kept_doc, kept_place, before, after)``: hashes of the words on both sides of the
    kept chunks in ``ends``, outwards."""
    low = F.shiftright("kept_place", 32)
    wanted = ends.select("kept_doc", "kept_place").distinct().groupBy(F.col("kept_doc").alias("doc"), low.alias("key")) \
        .agg(F.collect_list("kept_place").alias("wanted"))
    texts = attach(rows.select("doc", "key", "text"), wanted, ["doc", "key"])

    def run(batches):
        for b in batches:
            got: list[list] = [[], [], [], []]
            for doc, text, want in zip(b.column(0).to_pylist(), decoded(b.column(1)), b.column(2).to_pylist()):
                short = read(text).hashes.astype(np.uint32)
                for place in want:
                    a = (place & 0xFFFFFFFF) >> 6
                    z = a + (place & 63)
                    if z <= len(short):
                        for column, v in zip(got, (doc, place, short[max(0, a - EXTEND):a][::-1].tobytes(), short[z:z + EXTEND].tobytes())):
                            column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(g, t) for g, t in zip(got, (pa.int64(), pa.int64(), pa.binary(), pa.binary()))],
                                             names=["kept_doc", "kept_place", "before", "after"])

    return small_batches(texts.select("doc", "text", "wanted")) \
        .mapInArrow(run, "kept_doc long, kept_place long, before binary, after binary").dropDuplicates(["kept_doc", "kept_place"])


def marks(rows: DataFrame) -> DataFrame:
    """``(doc, key, ends)``: per document both ends of each of its passages: the passage's
    first word, the word after its last, and the words beyond this end of its kept copy
    (``kept``: the word after the kept chunk's last when it stands in the same text)."""
    runs_ = cut(passages(written(chunk_table(rows), "chunks")))
    side = F.explode(F.array(F.lit(-1), F.lit(1))).alias("side")
    ends = runs_.select("doc", "a", "z", "kept_doc", "shift", side) \
        .withColumn("kept_place", F.col("shift") + F.when(F.col("side") < 0, F.col("a")).otherwise(F.col("z")))
    known = ends.join(around(ends, rows), ["kept_doc", "kept_place"], "left")
    key = F.shiftright("a", 32)

    def first(place):
        return F.shiftright(place.bitwiseAND(0xFFFFFFFF), 6).cast("int")

    def after(place):
        return first(place) + place.bitwiseAND(63).cast("int")
    same = (F.col("kept_doc") == F.col("doc")) & (F.shiftright("kept_place", 32) == key)
    end = F.struct(first(F.col("a")).alias("a"), after(F.col("z")).alias("z"), "side",
                   F.when(F.col("side") < 0, F.col("before")).otherwise(F.col("after")).alias("beyond"),
                   F.when(same, after(F.col("kept_place"))).alias("kept"))
    return known.groupBy("doc", key.alias("key")).agg(F.collect_list(end).alias("ends"))


def held_words(words: np.ndarray, ends: list[dict], stops: np.ndarray) -> np.ndarray:
    """Which words stand in passages or in their extensions; ``stops`` are the words that
    begin a sentence."""
    n = len(words)
    held, short = np.zeros(n, dtype=bool), words.astype(np.uint32)
    for e in ends:
        a, b = e["a"], e["z"]
        held[a:b] = True
        beyond = np.frombuffer(e["beyond"] or b"", dtype=np.uint32)
        if e["side"] < 0:
            floor, x = e["kept"] or 0, a      # the kept words themselves stay
            for h in beyond:
                if x <= floor or short[x - 1] != h:
                    break
                x -= 1
            k = int(np.searchsorted(stops, x))
            if k < len(stops) and x < stops[k] <= a and stops[k] - x < EDGE:
                x = int(stops[k])
            held[x:a] = True
        else:
            x = b
            for h in beyond:
                if x == n or short[x] != h:
                    break
                x += 1
            k = int(np.searchsorted(stops, x)) - 1
            if x < n and k >= 0 and b <= stops[k] and not (k + 1 < len(stops) and stops[k + 1] == x) and x - stops[k] < EDGE:
                x = int(stops[k])
            held[b:x] = True
    return held


def runs(mask: np.ndarray) -> Iterator[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
    return zip(edge[::2].tolist(), edge[1::2].tolist())


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def remove_passages(text: str, ends: list[dict], min_words: int) -> tuple[str, list[tuple[int, int]]]:
    """Text without its passages (see ``marks``), and the removed spans.  A line that is
    removed whole takes its line break along."""
    read_ = read(text)
    words, line, sizes = read_.hashes, read_.line, read_.weights()
    places = list(zip(read_.begin.tolist(), read_.end.tolist()))
    stops = np.array([0, *(k for k in range(1, len(places)) if STOP.search(text, places[k - 1][1], places[k][0]))], dtype=np.int64)
    held = held_words(words, ends, stops)
    gone = np.zeros(len(words), dtype=bool)
    for a, b in runs(held):
        if sizes[a:b].sum() >= min_words:
            gone[a:b] = True
    first = np.flatnonzero(np.diff(line, prepend=-1))
    for a, b in [*zip(first.tolist(), [*first[1:].tolist(), len(words)]), (0, len(words))]:
        if held[a:b].all() and sizes[a:b].sum() >= min(WHOLE_WORDS, min_words):
            gone[a:b] = True
    spans = merged([span(text, places[a][0], places[b - 1][1]) for a, b in runs(gone)])
    out, at = [], 0
    for a, b in spans:
        out.append(text[at:a])
        at = b
        if a == 0 or text[a - 1] == "\n":
            if b == len(text):
                out[-1] = out[-1].removesuffix("\n")
            at += text[b:b + 1].isspace()
    out.append(text[at:])
    return "".join(out), spans


def span(text: str, a: int, b: int) -> tuple[int, int]:
    """A passage's first and last word with the marks that belong to them, and the space
    before it unless it begins a line."""
    while a and text[a - 1] in OPENING:
        a -= 1
    space = a
    while space and text[space - 1] != "\n" and text[space - 1].isspace():
        space -= 1
    if space and text[space - 1] != "\n":
        a = space
    while b < len(text) and not text[b].isspace() and not text[b].isalnum() and text[b] not in OPENING:
        b += 1
    return a, b


def deduplicate(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_words: int = MIN_WORDS, keep: list[str] | None = None) -> DataFrame:
    """``docs`` with the repeated passages of ``text_col`` removed, plus ``removed``
    (array of start and end offsets into the original text)."""
    keep = docs.columns if keep is None else keep
    carried = [c for c in keep if c.lower() not in (text_col.lower(), "removed")]
    text = col(text_col).cast("string")
    rows = docs.select(F.struct(*[col(c) for c in carried]).alias("row") if carried else F.lit(None).alias("row"),
                       F.coalesce(col(id_col).cast("long"), F.lit(LAST_RANK)).alias("doc"),
                       F.xxhash64(text).bitwiseAND(0x7FFFFFFF).alias("key"), text.alias("text"))
    joined = rows.join(marks(rows), ["doc", "key"], "left")

    def factory():
        def f(cols):
            got = [(t, []) if not t or not e else remove_passages(t, e, min_words)
                   for t, e in zip(decoded(cols[0]), cols[1].to_pylist())]
            return [[t for t, _ in got], [[{"start": a, "end": b} for a, b in s] for _, s in got]]
        return f

    out = append_columns(joined, ["text", "ends"], OUT, factory, ["row"])
    return out.select(*[F.col("row").getField(c).alias(c) for c in carried],
                      F.col("text").alias(text_col), "removed")
