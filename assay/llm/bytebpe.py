"""Byte-level BPE as a lazily determinised finite-state transducer.

The merges are compiled into a nondeterministic transducer over bytes.  A configuration
is the last finished token and a node of the vocabulary's trie (the token being read).
Reading a byte moves along the trie; where the node is a token that may follow the last
one, a second configuration begins a new token.  Two tokens may stand next to each other
exactly when the merges leave their concatenation as these two, and a byte string's
encoding is the one path whose neighbours all may.  A state of the deterministic machine
is the set of live configurations with their pending tokens; tokens that all
configurations share are emitted, and as a configuration dies within the longest token's
length, output lags behind input by a bounded number of bytes.  States and transitions are
built when first met and kept in a bounded table.

Decoding is a stream: token bytes pass an incremental UTF-8 state machine that emits
whole characters and holds the bytes of an unfinished one; ill-formed bytes become U+FFFD.

Edge cases: null text encodes as empty text (no ids); every match of the pattern is
encoded by itself, whatever its length; an id outside the vocabulary raises.
"""

from __future__ import annotations

import base64
import gc
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from assay.llm._common import RecentWords, append_columns, held

MAX_STATES = 200_000        # states kept before the tables are built anew
MAX_PAIRS = 600_000         # neighbour verdicts kept
CACHE_WORDS = 250_000       # matches remembered with their ids, in each of two generations

NEVER = 1 << 62
FEW = 6                     # tokens below a trie node up to which they are listed
CONFIGS, REST = -1, -2      # keys of a state beside its bytes

IDS = T.StructType([T.StructField("ids", T.ArrayType(T.IntegerType()))])
DECODED = T.StructType([T.StructField("decoded", T.BinaryType())])


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def merge(word: bytes, ranks: dict[bytes, int], note=None) -> list[bytes]:
    """The merges' definition, on a short string: join the neighbours whose
    concatenation ranks first, leftmost first, while any is a token.  ``note(parts, rank)``
    sees each stage."""
    parts, rank = [word[i:i + 1] for i in range(len(word))], -1
    while True:
        if note:
            note(parts, rank)
        rank, i = min(((ranks.get(a + b, NEVER), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))),
                      default=(NEVER, 0))
        if rank == NEVER:
            return parts
        parts[i:i + 2] = [parts[i] + parts[i + 1]]


class Transducer:
    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.token = {i: b for b, i in ranks.items()}
        self.child: dict[int, int] = {}         # node * 256 + byte -> node
        self.ends: list[int] = [-1]             # token that ends at a node
        self.inner: list[bool] = [False]
        for b, i in ranks.items():
            node = 0
            for c in b:
                key = node << 8 | c
                if key not in self.child:
                    self.child[key] = len(self.ends)
                    self.ends.append(-1)
                    self.inner.append(False)
                    self.inner[node] = True
                node = self.child[key]
            self.ends[node] = i
        # Tokens below each node that has few of them.
        self.below: dict[int, list[int]] = {}
        for b, i in ranks.items():
            node = 0
            for c in b:
                node = self.child[node << 8 | c]
                self.below.setdefault(node, []).append(i)
        self.below = {n: frozenset(v) for n, v in self.below.items() if len(v) <= FEW}
        self.edges: dict[int, tuple[list, list]] = {}
        self.pairs: dict[int, bool] = {}
        self._reset()

    def _reset(self):
        """An empty machine.  A state is a dict: byte -> (tokens now certain, next state),
        CONFIGS -> its configurations, REST -> the tokens still due if the input ends."""
        self.start = {CONFIGS: (((), -1, 0),), REST: ()}
        self.states = {self.start[CONFIGS]: self.start}

    def _edges(self, t: int) -> tuple[list, list]:
        """How the merges build a token: its first piece over time and its last one, each
        as (piece, rank that made it)."""
        got = self.edges.get(t)
        if got is None:
            left, right = [], []

            def note(parts, rank):
                for log, piece in ((left, parts[0]), (right, parts[-1])):
                    if not log or log[-1][0] != piece:
                        log.append((piece, rank))
            merge(self.token[t], self.ranks, note)
            got = self.edges[t] = left, right
        return got

    def _stay_apart(self, a: int, t: int) -> bool:
        """Whether the merges leave ``a`` and ``t`` as they are side by side.

        Both grow by themselves in order of rank; they meet when the pieces at their border
        form a token before either grows on (at equal rank the left one is first).  Where
        the ranks met are not increasing, the merges are carried out instead."""
        left, right = self._edges(a)[1], self._edges(t)[0]
        i = j = 0
        while True:
            (x, made_x), (y, made_y) = left[i], right[j]
            grow_x = left[i + 1][1] if i + 1 < len(left) else NEVER
            grow_y = right[j + 1][1] if j + 1 < len(right) else NEVER
            meet = self.ranks.get(x + y)
            if grow_x < made_x or grow_y < made_y or meet is not None and (meet < made_x or meet < made_y):
                return merge(self.token[a] + self.token[t], self.ranks) == [self.token[a], self.token[t]]
            if meet is not None and meet < grow_x and meet <= grow_y:
                return False
            if grow_x == grow_y == NEVER:
                return True
            if grow_x <= grow_y:
                i += 1
            else:
                j += 1

    def may_follow(self, a: int, t: int) -> bool:
        key = (a + 1) << 32 | t
        ok = self.pairs.get(key)
        if ok is None:
            if len(self.pairs) > MAX_PAIRS:
                self.pairs.clear()
            whole = self._edges(t)[0][-1][0] == self.token[t]     # else no text encodes as t
            ok = self.pairs[key] = whole and (a < 0 or self._stay_apart(a, t))
        return ok

    def _move(self, state: dict, byte: int) -> tuple[tuple, dict]:
        """Build one transition.  A configuration is (pending tokens, guard, node); the
        guard is the last token or, below a node with few tokens, the set of those that may
        still follow it (a configuration without any is dropped)."""
        live = []
        for out, guard, node in state[CONFIGS]:
            n = self.child.get(node << 8 | byte)
            if n is None:
                continue
            few, t = self.below.get(n), self.ends[n]
            if few is None:
                if self.inner[n]:
                    live.append((out, guard, n))
                ok = t >= 0 and self.may_follow(guard, t)
            else:
                left = guard & few if type(guard) is frozenset else \
                    frozenset([x for x in few if self.may_follow(guard, x)])
                ok = t in left
                if len(left) > ok:
                    live.append((out, left, n))
            if ok:
                live.append(((*out, t), t, 0))
        sure, first = 0, live[0][0]
        if len(live) > 1:
            shortest = min([len(c[0]) for c in live])
            while sure < shortest and all([c[0][sure] == first[sure] for c in live]):
                sure += 1
        else:
            sure = len(first)
        key = tuple([(c[0][sure:], c[1], c[2]) for c in live]) if sure else tuple(live)
        nxt = self.states.get(key)
        if nxt is None:
            nxt = self.states[key] = {CONFIGS: key, REST: next(c[0] for c in key if c[2] == 0)}
        move = state[byte] = (first[:sure], nxt)
        return move

    def __call__(self, word: bytes) -> list[int]:
        """Token ids of one match of the pattern."""
        whole = self.ranks.get(word)
        if whole is not None:
            return [whole]
        if len(self.states) > MAX_STATES:
            self._reset()
        out: list[int] = []
        state = self.start
        for byte in word:
            sure, state = state.get(byte) or self._move(state, byte)
            if sure:
                out += sure
        out += state[REST]
        return out


class Encoder:
    """Ids of whole texts: the pattern's matches, each through the transducer."""

    def __init__(self, path: str, pattern: str):
        # \s means Unicode white space here, as in the reference tokenizers; some separators
        # that Python also counts as space are not.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.transducer = Transducer(read_ranks(path))
        self.recent = RecentWords(self._ids, CACHE_WORDS)

    def _ids(self, word: str) -> bytes:
        return array("i", self.transducer(word.encode())).tobytes()

    def __call__(self, text: str) -> bytes:
        """Ids as 32-bit integers."""
        return self.recent.join(self.pattern.findall(text))


#: UTF-8: for a lead byte, the number of bytes that follow and the range of the first of them.
def _lead(byte: int) -> tuple[int, int, int] | None:
    if byte < 0x80:
        return 0, 0, 0
    if 0xC2 <= byte <= 0xDF:
        return 1, 0x80, 0xBF
    if 0xE0 <= byte <= 0xEF:
        return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
    if 0xF0 <= byte <= 0xF4:
        return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
    return None


LEAD = [_lead(b) for b in range(256)]
BAD = "\N{REPLACEMENT CHARACTER}"


class Utf8Machine:
    """State: bytes of the unfinished character, how many are missing, range of the next."""

    def __init__(self):
        self.held, self.missing, self.low, self.high = b"", 0, 0, 0

    def feed(self, data: bytes) -> str:
        """Characters that ``data`` completes."""
        if not self.missing and data.isascii():
            return data.decode()
        out = []
        for c in data:
            if self.missing:
                if self.low <= c <= self.high:
                    self.held += bytes([c])
                    self.missing -= 1
                    self.low, self.high = 0x80, 0xBF
                    if not self.missing:
                        out.append(self.held.decode())
                        self.held = b""
                    continue
                out.append(BAD)
                self.held, self.missing = b"", 0
            lead = LEAD[c]
            if lead is None:
                out.append(BAD)
            elif lead[0] == 0:
                out.append(chr(c))
            else:
                self.held, (self.missing, self.low, self.high) = bytes([c]), lead
        return "".join(out)

    def end(self) -> str:
        """What an unfinished character at the end becomes."""
        left, self.held, self.missing = self.held, b"", 0
        return BAD if left else ""


class Decoder:
    """Text of id streams.  A token that is whole characters by itself has its text ready;
    only the others move the machine's state."""

    def __init__(self, path: str):
        ranks = read_ranks(path)
        size = max(ranks.values()) + 1
        self.bytes: list[bytes | None] = [None] * size
        self.text: list[str | None] = [None] * size
        self.whole = np.zeros(size, dtype=bool)
        for b, i in ranks.items():
            machine = Utf8Machine()
            text = machine.feed(b)
            self.bytes[i] = b
            if not machine.missing and BAD not in text:
                self.text[i], self.whole[i] = text, True

    def __call__(self, ids: np.ndarray) -> str:
        odd = np.flatnonzero(~self.whole[ids])
        listed = ids.tolist()
        if not len(odd):
            return "".join(map(self.text.__getitem__, listed))
        out, at, machine = [], 0, Utf8Machine()
        for k in odd.tolist():
            if k < at:
                continue
            out += map(self.text.__getitem__, listed[at:k])
            out.append(machine.feed(self.bytes[listed[k]]))
            at = k + 1
            while machine.missing and at < len(listed):
                out.append(machine.feed(self.bytes[listed[at]]))
                at += 1
        out += map(self.text.__getitem__, listed[at:])
        return "".join(out) + machine.end()


def _encoded(enc: Encoder, texts: pa.Array) -> pa.ListArray:
    gc.disable()        # the machine's tables hold no garbage; walking them costs a third of the time
    try:
        raw = [enc(t) if t else b"" for t in texts.to_pylist()]
    finally:
        gc.enable()
    ends = np.cumsum([0, *(len(r) // 4 for r in raw)], dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(raw), dtype="<i4"), type=pa.int32()))


def _decoded(dec: Decoder, ids: pa.ListArray) -> list[bytes | None]:
    flat, ends = ids.values.to_numpy(zero_copy_only=False), ids.offsets.to_numpy()
    return [dec(flat[a:b]).encode() if ok else None
            for a, b, ok in zip(ends[:-1], ends[1:], ids.is_valid().to_pylist())]


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text",
           keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids``, the whole text's token ids."""
    def factory():
        enc = held(("encode", path, pattern), lambda: Encoder(path, pattern))
        return lambda cols: [_encoded(enc, cols[0])]

    return append_columns(docs, [text_col], IDS, factory, keep)


def decode(tokens: DataFrame, path: str, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``tokens`` with ``decoded``, the UTF-8 bytes of the ids' text (null for null)."""
    def factory():
        dec = held(("decode", path), lambda: Decoder(path))
        return lambda cols: [_decoded(dec, cols[0])]

    return append_columns(tokens, [ids_col], DECODED, factory, keep)


def round_trip(docs: DataFrame, path: str, pattern: str, text_col: str = "text",
               keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``ids`` and ``decoded``: ``decode`` after ``encode`` in one pass, so
    that the ids cross to the JVM once."""
    def factory():
        enc, dec = held(("round trip", path, pattern), lambda: (Encoder(path, pattern), Decoder(path)))

        def f(cols: list[pa.Array]):
            ids = _encoded(enc, cols[0])
            return [ids, _decoded(dec, ids)]
        return f

    return append_columns(docs, [text_col], T.StructType([*IDS.fields, *DECODED.fields]), factory, keep)
