"""Toxicity scores from subword-bag embeddings and a linear softmax.

A word is the bag of its character n-grams (with its borders) and the word itself, each
hashed to a row of an embedding table; a word's vector is the mean of its rows, so unseen
misspellings share the n-grams of the words they come from.  A window of ``WINDOW`` words is
the mean of its words' vectors and goes through a linear softmax; windows overlap by half
and cover the whole text, and a document scores as its most toxic window does, so that a
few words in a very long text count as much as in a short one.

Embeddings and softmax are trained together in numpy on a bounded labelled sample: first
every window carries its document's label, then only the window that scores highest.  A
trained model is linear in the rows, so scoring needs one number per row: its embedding
times the difference of the softmax's two weight vectors.

Edge cases: null or empty text, or text without a letter or digit, is a window without
words and scores by the softmax's bias alone; without labelled rows of both classes every
score is the share of the label seen (0 without any); labels other than 0 and 1 teach
nothing; equal texts count once in the sample; invalid bytes read as U+FFFD.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm._common import append_columns, col, decoded, held

#: Bounds of the labelled sample: distinct texts of each label, characters taken of a text.
SAMPLE_TEXTS, SAMPLE_CHARS = 2_048, 8_192
GRAMS = (3, 4, 5)
BUCKETS, DIM = 1 << 18, 16
WINDOW = 24                 # words; windows begin at every half of it
EPOCHS, WARM_UP, RATE, DECAY = 400, 100, 1.0, 1e-4
PIECE = 1 << 18             # symbols read at once; a longer word is cut there
BORDER = 1                  # symbol of everything outside words

_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def word_symbols() -> np.ndarray:
    """Symbol of every code point: its own for letters, marks and digits, else BORDER."""
    out = np.full(0x110000, BORDER, dtype=np.uint32)
    for cp in range(0x110000):
        if chr(cp).isalnum() or unicodedata.category(chr(cp))[0] == "M":
            out[cp] = cp + 2
    return out


def symbols_of(lowered: str, table: np.ndarray) -> np.ndarray:
    points = np.frombuffer(lowered.encode("utf-32-le", "replace"), dtype=np.uint32)
    return table[points]


@dataclass
class Bags:
    """Words of some text: a 64-bit hash, the place of the first symbol, and the table
    ``rows`` of their bags, each with the number of its word (``owner``)."""
    words: np.ndarray
    at: np.ndarray
    rows: np.ndarray
    owner: np.ndarray

    def each(self) -> list[np.ndarray]:
        """Rows of every word."""
        order = np.argsort(self.owner, kind="stable")
        return np.split(self.rows[order], np.searchsorted(self.owner[order], np.arange(1, len(self.words))))


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    h = (h ^ np.uint64(salt * 0x1000193)) * _MIX
    h ^= h >> np.uint64(32)
    return ((h * _MIX) >> np.uint64(40)).astype(np.int64) & (BUCKETS - 1)


def bags(symbols: np.ndarray) -> Bags:
    """Words and subword rows of a symbol sequence, without a loop over words."""
    s = np.concatenate([[BORDER], symbols, [BORDER]]).astype(np.uint64)
    inside = s != BORDER
    begin = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
    length = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1 - begin
    if not len(begin):
        none = np.zeros(0, dtype=np.int64)
        return Bags(none.astype(np.uint64), none, none, none)
    with np.errstate(over="ignore"):
        # the word itself: a polynomial over its symbols
        letters, first = np.flatnonzero(inside), np.cumsum(length) - length
        power = np.concatenate([np.ones(1, dtype=np.uint64), np.cumprod(np.full(int(length.max()), _P, dtype=np.uint64))])
        words = np.add.reduceat(s[letters] * power[np.arange(len(letters)) - np.repeat(first, length)], first)
        number = np.zeros(len(s), dtype=np.int64)
        number[letters] = np.repeat(np.arange(len(begin)), length)
        rows, owner = [_bucket(words, 7)], [np.arange(len(begin))]
        for n in GRAMS:
            ok = np.ones(max(0, len(s) - n + 1), dtype=bool)
            for k in range(1, n - 1):
                ok &= inside[k:k + len(ok)]
            at = np.flatnonzero(ok)
            h = np.zeros(len(at), dtype=np.uint64)
            for k in range(n):
                h = h * _P + s[at + k]
            rows.append(_bucket(h, 100 + n))
            owner.append(number[at + 1])
    return Bags(words, begin - 1, np.concatenate(rows), np.concatenate(owner))


@dataclass
class Model:
    """``weight`` of every table row in a window's logit of label 1, and the bias."""
    weight: np.ndarray
    bias: float

    def word_scores(self, b: Bags) -> np.ndarray:
        n = len(b.words)
        return np.bincount(b.owner, self.weight[b.rows], n) / np.bincount(b.owner, minlength=n) if n else np.zeros(0)

    def scores(self, texts: list[str | None]) -> np.ndarray:
        """Score of each text: the probability of label 1 in its highest window."""
        if not texts:
            return np.zeros(0)
        docs, words = [], []
        for owner, symbols in pieces(texts, held("toxicity-symbols", word_symbols)):
            b = bags(symbols)
            docs.append(owner[b.at])
            words.append(self.word_scores(b))
        counts = np.bincount(np.concatenate(docs), minlength=len(texts))
        logit, windows = window_logits(np.concatenate(words), counts, self.bias)
        return sigmoid(np.maximum.reduceat(logit, np.cumsum(windows) - windows))


def pieces(texts: list[str | None], table: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """``(text of each symbol, symbols)``: all texts one after the other, in pieces of about
    ``PIECE`` symbols that end between words (inside one only if it is longer than that)."""
    owner, parts, size = [], [], 0
    for i, text in enumerate(texts):
        text, a = (text or "").lower(), 0
        while True:
            symbols = symbols_of(text[a:a + PIECE], table)
            if a + PIECE < len(text):
                border = np.flatnonzero(symbols == BORDER)
                if len(border):
                    symbols = symbols[:border[-1] + 1]
            a += len(symbols)
            parts += [symbols, np.full(1, BORDER, dtype=symbols.dtype)]
            owner.append(np.full(len(symbols) + 1, i))
            size += len(symbols) + 1
            if size >= PIECE:
                yield np.concatenate(owner), np.concatenate(parts)
                owner, parts, size = [], [], 0
            if a >= len(text):
                break
    yield (np.concatenate(owner), np.concatenate(parts)) if parts else (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint32))


def halves(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For documents of ``counts`` words: first word of every half window, words in it, and
    the number of halves of each document."""
    half = WINDOW // 2
    n = -(-counts // half)
    doc = np.repeat(np.arange(len(counts)), n)
    nth = np.arange(len(doc)) - np.repeat(np.cumsum(n) - n, n)
    first = np.repeat(np.cumsum(counts) - counts, n) + nth * half
    return first, np.minimum(half, counts[doc] - nth * half), n


def window_logits(scores: np.ndarray, counts: np.ndarray, bias: float) -> tuple[np.ndarray, np.ndarray]:
    """Logit of every window, document after document, and the windows of each (at least
    one: a document without words has an empty window)."""
    first, size, n = halves(counts)
    total = np.add.reduceat(scores, first) if len(first) else np.zeros(0)
    windows = np.maximum(n - 1, 1)
    out = np.full(int(windows.sum()), bias)
    doc = np.repeat(np.arange(len(counts)), windows)
    at = (np.cumsum(n) - n)[doc] + np.arange(len(doc)) - np.repeat(np.cumsum(windows) - windows, windows)
    some = n[doc] > 0
    two = n[doc] > 1
    a = at[some]
    s, c = total[a].copy(), size[a].astype(np.float64)
    more = two[some]
    s[more] += total[a[more] + 1]
    c[more] += size[a[more] + 1]
    out[some] += s / c
    return out, windows


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -500, 500)))


def telling(seen: np.ndarray, with_1: np.ndarray, share: float) -> np.ndarray:
    """Rows whose texts carry label 1 more or less often than chance explains: the
    log-likelihood ratio against the common share exceeds the logarithm of the rows tried.
    All others keep an embedding of zero, so that rare words are not learnt by heart."""
    q = np.divide(with_1, seen, out=np.full(len(seen), share), where=seen > 0)
    with np.errstate(divide="ignore", invalid="ignore"):
        a, b = q * np.log(q / share), (1 - q) * np.log((1 - q) / (1 - share))
    ratio = seen * (np.where(q > 0, a, 0.0) + np.where(q < 1, b, 0.0))
    return ratio > np.log(max(2, np.count_nonzero(seen)))


def train(texts: list[str], labels: list[int], shares: tuple[float, float] | None = None, epochs: int = EPOCHS,
          warm_up: int = WARM_UP, rate: float = RATE, decay: float = DECAY, seed: int = 1) -> Model:
    """Embeddings and softmax by Adagrad on all windows at once.  ``shares`` are the weights
    of label 0 and 1 (default: as in the sample); the loss is a weighted mean over documents."""
    y = np.array(labels, dtype=np.float64)
    if not any(labels) or all(labels):
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(BUCKETS), float(np.log(share + 1e-9) - np.log(1 - share + 1e-9)))
    table = held("toxicity-symbols", word_symbols)
    own, inverse, counts, known = [], [], [], {}
    seen, with_1 = np.zeros(BUCKETS), np.zeros(BUCKETS)
    for t, label in zip(texts, labels):     # rows of every distinct word once
        b = bags(symbols_of(t.lower(), table))
        if len(b.words):
            for w, rows in zip(b.words.tolist(), b.each()):
                k = known.get(w)
                if k is None:
                    k = known[w] = len(own)
                    own.append(rows)
                inverse.append(k)
        counts.append(len(b.words))
        present = np.unique(b.rows)
        seen[present] += 1
        with_1[present] += label
    counts, inverse = np.array(counts), np.array(inverse, dtype=np.int64)
    sizes = np.array([len(r) for r in own])
    if not own:
        return Model(np.zeros(BUCKETS), float(np.log(y.mean()) - np.log(1 - y.mean())))
    flat, word = np.concatenate(own), np.repeat(np.arange(len(own)), sizes)
    some_row = telling(seen, with_1, float(y.mean()))[flat]
    used, flat = np.unique(flat[some_row], return_inverse=True)
    word = word[some_row]
    shares = shares or (float((y == 0).mean()), float((y == 1).mean()))
    per_doc = np.where(y == 1, shares[1] / (y == 1).sum(), shares[0] / (y == 0).sum())
    rng = np.random.default_rng(seed)
    table_e = rng.normal(scale=0.1, size=(len(used), DIM))
    soft = rng.normal(scale=0.1, size=(2, DIM))
    bias = np.log(np.array(shares) / sum(shares))
    sq_e, sq_w, sq_b = np.full(len(used), 1e-8), np.full_like(soft, 1e-8), np.full(2, 1e-8)
    first, size, n_half = halves(counts)
    windows = np.maximum(n_half - 1, 1)
    doc = np.repeat(np.arange(len(counts)), windows)
    w_start = np.cumsum(windows) - windows
    at = (np.cumsum(n_half) - n_half)[doc] + np.arange(len(doc)) - np.repeat(w_start, windows)
    some, two = n_half[doc] > 0, n_half[doc] > 1
    half_of = np.repeat(np.arange(len(first)), size)
    n_words = np.zeros(len(doc))
    n_words[some] = size[at[some]]
    n_words[two] += size[at[two] + 1]
    for epoch in range(epochs):
        v = soft[1] - soft[0]
        weight = table_e @ v
        scores = (np.bincount(word, weight[flat], len(own)) / sizes)[inverse]
        logit, _ = window_logits(scores, counts, float(bias[1] - bias[0]))
        if epoch < warm_up:
            take = per_doc[doc] / windows[doc]
        else:
            top = np.maximum.reduceat(logit, w_start)
            best = logit >= top[doc]
            take = np.where(best, per_doc[doc] / np.add.reduceat(best.astype(float), w_start)[doc], 0.0)
        g = (sigmoid(logit) - y[doc]) * take                # gradient of each window's logit
        per_word = np.divide(g, n_words, out=np.zeros_like(g), where=n_words > 0)
        half_g = np.bincount(at[some], per_word[some], len(first)) + np.bincount(at[two] + 1, per_word[two], len(first))
        word_g = np.bincount(inverse, half_g[half_of], len(own)) / sizes
        row_g = np.bincount(flat, word_g[word], len(used))  # the gradient of row r is row_g[r] * v
        g_v = row_g @ table_e
        g_w = np.stack([-g_v, g_v]) + decay * soft
        g_b = np.array([-g.sum(), g.sum()])
        sq_e += (row_g * row_g) * (v @ v)
        table_e -= rate * ((row_g / np.sqrt(sq_e))[:, None] * v[None] + decay * table_e)
        sq_w += g_w * g_w
        soft -= rate * g_w / np.sqrt(sq_w)
        sq_b += g_b * g_b
        bias -= rate * g_b / np.sqrt(sq_b)
    out = np.zeros(BUCKETS)
    out[used] = table_e @ (soft[1] - soft[0])
    return Model(out, float(bias[1] - bias[0]))


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", id_col: str = "doc_id",
                    text_col: str = "text", texts: int = SAMPLE_TEXTS, chars: int = SAMPLE_CHARS) \
        -> tuple[list[str], list[int], tuple[float, float]]:
    """Texts, labels and the shares of label 0 and 1 among the distinct labelled texts.

    Of each label the ``texts`` distinct texts with the smallest hash, each its first
    ``chars`` characters.  Only ids and hashes are joined; the driver receives the bounded
    sample.
    """
    known = labels.where(col(label_col).isin(0, 1)).select(col(id_col).alias("id"), col(label_col).cast("int").alias("y")).distinct()
    hashed = docs.select(col(id_col).alias("id"), F.xxhash64(col(text_col).cast("string")).alias("h")) \
        .join(known, "id").groupBy("y", "h").agg(F.min("id").alias("id"))
    counts = {r["y"]: r["n"] for r in hashed.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(counts.values())
    out_texts, out_labels = [], []
    for y in sorted(counts):
        picked = hashed.where(F.col("y") == y).orderBy(F.abs("h"), "h").limit(texts).select("id", "h")
        rows = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text")) \
            .join(F.broadcast(picked), "id").where(F.xxhash64("text") == F.col("h")) \
            .groupBy("h").agg(F.min(F.substring("text", 1, chars)).alias("text")).collect()
        rows = sorted(rows, key=lambda r: r["h"])
        out_texts += [r["text"] or "" for r in rows]
        out_labels += [y] * len(rows)
    shares = tuple(counts.get(y, 0) / total if total else 0.0 for y in (0, 1))
    return out_texts, out_labels, shares


OUT = T.StructType([T.StructField("score", T.DoubleType())])


def score(docs: DataFrame, model: Model, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` plus ``score``, from 0 to 1, higher for likelier label 1.  The model (one
    number per table row, 2 MB) goes to every task once."""
    sent = docs.sparkSession.sparkContext.broadcast((model.weight, model.bias))

    def factory():
        own = Model(*sent.value)
        return lambda arrays: [pa.array(own.scores(decoded(arrays[0])), pa.float64())]
    return append_columns(docs, [text_col], OUT, factory, keep=keep)
