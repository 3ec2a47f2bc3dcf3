"""Language identification by cross-parsing entropy.

Per language a suffix automaton of labelled text accepts every substring of that text.
A document is parsed greedily into the longest phrases the automaton accepts; the
language that needs the fewest phrases, normalised by the automaton's text length
(``phrases * log2(text length) / symbols``), wins.

Text is read as letters: each letter (Unicode L, with its marks) is lower-cased to one
symbol, runs of anything else become one space.  Of texts too long for the automaton all
together, each gives its beginning, to the same length.  A document is parsed in windows of ``WINDOW`` symbols
covering the whole text (a phrase ends at a window's end, for every language alike), and
the windows of many documents advance together, one symbol per step, so the work per
symbol is a few vector operations and memory does not depend on a document's length.

Edge cases: null text or text without a letter gives ``und`` with score 0; ties go to the
language that sorts first; with no learned language every document is ``und``.
"""

from __future__ import annotations

import math
import unicodedata
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm._common import append_columns, col, held

UNDETERMINED = "und"
WINDOW = 256
LANES = 32_768          # windows parsed together
OWN_CLASSES = 60_000    # letters of the sample with a symbol of their own; others share
SHARED_CLASSES = 16
#: Bounds of the labelled sample: texts per language, characters taken of a text, letters per automaton.
SAMPLE_TEXTS, SAMPLE_TEXT_CHARS, SAMPLE_SYMBOLS = 128, 20_000, 60_000
MAX_LANGUAGES = 2_000   # an error beyond, never a silent cut

OUT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])


def labelled_sample(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", texts: int = SAMPLE_TEXTS,
                    max_chars: int = SAMPLE_TEXT_CHARS) -> dict[str, list[str]]:
    """A bounded sample of distinct labelled texts per language, chosen by content hash.

    One aggregate counts the distinct usable hashes of each language; a second scan keeps
    the texts whose hash falls under a per-language rate that yields about ``2 * texts``
    distinct ones, made distinct before they travel, so the driver receives a bounded number
    of texts however often each is stored.  A text over ``max_chars`` characters stands
    there with the span of that length from its first letter on.
    """
    text = col(text_col).cast("string")
    span = F.substring(F.regexp_replace(text, r"\A\P{L}++", ""), 1, max_chars)
    usable = docs.select(F.when(F.length(text) > max_chars, span).otherwise(text).alias("text"),
                         col(lang_col).cast("string").alias("lang")) \
        .where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")).withColumn("h", F.xxhash64("text"))
    rows = usable.select("lang", "h").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n")) \
        .limit(MAX_LANGUAGES + 1).collect()
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"{lang_col} has more than {MAX_LANGUAGES} values; these are no language labels")
    counts = {r["lang"]: r["n"] for r in rows}
    if not counts:
        return {}
    span = 1 << 31
    rate = F.create_map(*[F.lit(x) for k, n in counts.items()
                          for x in (k, min(span, -(-2 * texts * span // n)))])
    rows = usable.where(F.pmod(F.col("h"), F.lit(span)) < rate[F.col("lang")]).select("lang", "h", "text") \
        .distinct().collect()
    got: dict[str, list[tuple]] = {}
    for r in rows:
        got.setdefault(r["lang"], []).append((r["h"] % span, r["text"]))
    return {k: [t for _, t in sorted(v)[:texts]] for k, v in got.items()}


SPACE, SEPARATOR, PAD, LETTERS = 0, 1, 2, 3     # symbols: between words, between training texts, after a document


def is_letter(c: str) -> bool:
    return c.isalpha() or unicodedata.category(c)[0] == "M"


def symbol_table(sample: dict[str, list[str]]) -> tuple[np.ndarray, int]:
    """Symbol of every code point, and their number: the letters and marks of the sample
    have their own, in every script (the commonest, beyond ``OWN_CLASSES``); the others one
    of the shared ones."""
    seen = Counter()
    for texts in sample.values():
        for t in texts:
            seen.update(t.lower())
    seen = [(c, n) for c, n in seen.items() if is_letter(c)]
    own = {c: LETTERS + i for i, (c, _) in enumerate(sorted(seen, key=lambda x: (-x[1], x[0]))[:OWN_CLASSES])}
    shared = LETTERS + len(own)
    out = np.zeros(0x110000, dtype=np.uint16)
    for cp in range(0x110000):
        c = chr(cp)
        if is_letter(c):
            low = c.lower()[0]
            out[cp] = own.get(low) or shared + ord(low) % SHARED_CLASSES
    return out, shared + SHARED_CLASSES


def symbols(text: str, table: np.ndarray) -> np.ndarray:
    """Symbols of a whole text: letters, and one space for each run of others; empty
    when it has no letter."""
    s = table[np.frombuffer(text.encode("utf-32-le"), dtype="<u4")]
    if not len(s):
        return s
    keep = s != 0
    keep[1:] |= s[:-1] != 0
    s = s[keep]
    if len(s) and s[0] == 0:
        s = s[1:]
    return s


def suffix_automaton(seq: list[int]) -> list[dict[int, int]]:
    """Transitions of the smallest automaton that accepts every substring of ``seq``."""
    nxt: list[dict[int, int]] = [{}]
    link, length, last = [-1], [0], 0
    for c in seq:
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and c not in nxt[p]:
            nxt[p][c] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(nxt)
                nxt.append(dict(nxt[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p != -1 and nxt[p].get(c) == q:
                    nxt[p][c] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
    return nxt


class Machine:
    """Greedy-parse table of one automaton, its rows laid over each other: symbol ``c`` of
    state ``q`` has the slot ``base[q] + c``, which is ``q``'s when ``owner`` says so.  Memory
    follows the transitions, not states x symbols.  A symbol that the text lacks is a phrase
    of its own (a last state without a way on)."""

    def __init__(self, seq: list[int], classes: int):
        nxt = suffix_automaton(seq)
        alone = len(nxt)
        self.start = np.full(classes, alone, dtype=np.int32)
        for c, q in nxt[0].items():
            self.start[c] = q
        rows = sorted((q for q in range(1, alone) if len(nxt[q]) > 1), key=lambda q: -len(nxt[q]))
        single = [q for q in range(1, alone) if len(nxt[q]) == 1]
        size = 4 * sum(len(nxt[q]) for q in range(1, alone)) + 2 * classes
        used, base, at = bytearray(size), [0] * (alone + 1), 0
        for q in rows:
            syms = list(nxt[q])
            while any(map(used.__getitem__, [at + c for c in syms])):
                at += 1
                if at + classes > len(used):
                    used.extend(bytes(size))
            base[q] = at
            for c in syms:
                used[at + c] = 1
        slot = classes
        for q in single:
            slot = used.find(0, slot)
            if slot < 0:
                slot = len(used)
                used.extend(bytes(size))
            used[slot] = 1
            base[q] = slot - next(iter(nxt[q]))
        self.base = np.array(base, dtype=np.int32)
        self.owner = np.full(max(base) + classes, -1, dtype=np.int32)
        self.next = np.zeros(len(self.owner), dtype=np.int32)
        for q in range(1, alone):
            for c, to in nxt[q].items():
                self.owner[base[q] + c] = q
                self.next[base[q] + c] = to

    def phrases(self, steps: np.ndarray) -> np.ndarray:
        """Phrases of every window (a column of ``steps``)."""
        state = np.zeros(steps.shape[1], dtype=np.int32)
        count = np.zeros(steps.shape[1], dtype=np.int32)
        for s in steps:
            slot = self.base[state] + s
            goes = self.owner[slot] == state
            new = np.where(goes, self.next[slot], self.start[s])
            pad = s == PAD
            count += ~(goes | pad) & (state != 0)
            state = np.where(pad, state, new)
        return count + (state != 0)


def part_length(lengths: list[int], total: int) -> int:
    """The most that can be taken of each text so that ``total`` is kept in all."""
    lengths = sorted(lengths)
    for i, n in enumerate(lengths):
        if n * (len(lengths) - i) >= total:
            return total // (len(lengths) - i)
        total -= n
    return lengths[-1] if lengths else 0


class CrossParser:
    """Cross-parsing machines of all learned languages."""

    def __init__(self, sample: dict[str, list[str]]):
        self.table, classes = symbol_table(sample)
        self.langs, self.machines, self.bits = [], [], []
        for lang in sorted(sample):
            parts = [p for p in (symbols(t, self.table) for t in sample[lang]) if len(p)]
            most = part_length([len(p) + 1 for p in parts], SAMPLE_SYMBOLS)
            seq: list[int] = []
            for p in parts:
                seq += p[:max(1, most - 1)].tolist() + [SEPARATOR]
            if seq:
                self.langs.append(lang)
                self.machines.append(Machine(seq, classes))
                self.bits.append(math.log2(len(seq) + 1))

    def phrases(self, windows: np.ndarray) -> np.ndarray:
        """Phrases per window and language; a window that is all padding has none."""
        steps = np.ascontiguousarray(windows.T)
        out = np.empty((len(windows), len(self.langs)), dtype=np.int64)
        for k, m in enumerate(self.machines):
            out[:, k] = m.phrases(steps)
        return out

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        n = len(texts)
        total = np.zeros((n, len(self.langs)), dtype=np.int64)
        size = np.zeros(n, dtype=np.int64)
        block, owner, held = [], [], 0

        def flush():
            if block:
                np.add.at(total, np.concatenate(owner), self.phrases(np.concatenate(block)))
                block.clear()
                owner.clear()

        for i, t in enumerate(texts):
            if not t or not self.langs:
                continue
            s = symbols(t, self.table)
            size[i] = len(s)
            rows = -(-len(s) // WINDOW)
            for a in range(0, rows, LANES):
                part = s[a * WINDOW:(a + LANES) * WINDOW]
                w = np.full(-(-len(part) // WINDOW) * WINDOW, PAD, dtype=np.uint16)
                w[:len(part)] = part
                block.append(w.reshape(-1, WINDOW))
                owner.append(np.full(len(block[-1]), i))
                held += len(block[-1])
                if held >= LANES:
                    flush()
                    held = 0
        flush()
        cost = total * np.array(self.bits or [0.0])[:max(1, len(self.langs))] if self.langs else total
        langs, scores = [], []
        for i, t in enumerate(texts):
            if not size[i] or not any(c.isalpha() for c in t):
                langs.append(UNDETERMINED)
                scores.append(0.0)
                continue
            order = np.argsort(cost[i], kind="stable")
            best = cost[i][order[0]]
            second = cost[i][order[1]] if len(order) > 1 else math.inf
            langs.append(self.langs[order[0]])
            scores.append(1.0 if math.isinf(second) else float(max(0.0, 1.0 - best / second)))
        return langs, scores


def identify(docs: DataFrame, sample: dict[str, list[str]], text_col: str = "text",
             keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (the share of phrases the winner saves
    against the runner-up, 0 to 1).  The sample (bounded, see ``labelled_sample``) travels
    with the task; each worker builds the automata once."""
    def factory():
        parser = held(("languages", *((k, *v) for k, v in sorted(sample.items()))), lambda: CrossParser(sample))

        def f(cols: list[pa.Array]):
            return parser.predict(cols[0].to_pylist())
        return f

    return append_columns(docs, [text_col], OUT, factory, keep)
