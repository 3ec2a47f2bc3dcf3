"""Packing documents into fixed-length sequences along a space-filling curve.

Each document's token ids are hashed into a vector, projected to ``DIMS`` dimensions by
per-id random signs, and standardised with the corpus mean and deviation.  Its cell on a
grid of ``2**GRID_BITS`` steps per dimension (steps of equal normal probability) has a
Hilbert key; a range shuffle by that key lays similar documents next to each other, and
each partition's stream of ids is cut every ``length`` ids.  What is left over at a
partition's end is cut into power-of-two sequences (binary digits of its length), which need
no padding; so sequences are always full or a power of two.

The ids are computed once and written to the shared folder (two bytes an id when the
vocabulary allows), because the range shuffle reads its input twice.  Documents that are
longer than a sequence continue in the next one, and a piece never spans two sequences.

Edge cases: null text packs as empty text (its end id only); rows that repeat a doc_id are
packed as separate documents with equal ids; a null doc_id stays null; an empty table gives
no rows.
"""

from __future__ import annotations

import gc
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assay.llm._common import RecentWords, append_columns, col, held, small_batches, written

DIMS, GRID_BITS = 4, 12
CACHE_WORDS = 200_000       # distinct pieces a worker remembers, in each of two generations

#: Text rules of the word tokenizer's file (fixed values), and what they amount to on
#: texts of ASCII and accented Latin letters.
RULES = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "behavior": "Removed", "invert": True, "pattern": {
            "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]},
    "post_processor": None,
}
PIECE = re.compile("[a-zß-öø-ÿ]+|[0-9]|'s|'t|'re|'ve|'m|'ll|'d|[^ \\t\\na-zß-öø-ÿ0-9]+")
PLAIN = bytes([9, 10, *range(0x20, 0x7F), *(c for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7))])    # in Latin-1


def is_plain(text: str) -> bool:
    try:
        return not text.encode("latin-1").translate(None, PLAIN)
    except UnicodeEncodeError:
        return False

TOKENS = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("n", T.LongType())] +
                      [T.StructField(f"v{i}", T.DoubleType()) for i in range(DIMS)])


class WordEncoder:
    """Ids of a whole text from the tokenizer file, remembered per word.

    A file whose text rules are ``RULES`` splits plain Latin text into lower-cased words,
    digits and signs that are merged each by itself.  Such texts are split here, and only
    pieces not met lately reach the tokenizer's merge model.  Any other text, and any text
    under another file, goes through the tokenizer as a whole.
    """

    def __init__(self, path: str):
        import json
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.dtype = np.dtype("<u4" if self.tokenizer.get_vocab_size() > 1 << 16 else "<u2")
        with open(path, encoding="utf-8") as f:
            config = json.load(f)
        self.by_word = {k: config.get(k) for k in RULES} == RULES
        self.special = [t["content"] for t in config.get("added_tokens") or []]
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0x21, 0x100) if c in PLAIN]
        self.bytes_as_letters = str.maketrans({c: level.pre_tokenize_str(c)[0][0] for c in letters})
        self.recent = RecentWords(self._piece, CACHE_WORDS)

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = piece.translate(self.bytes_as_letters)
        return array(self.dtype.char, [t.id for t in self.model.tokenize(piece)]).tobytes()

    def __call__(self, text: str) -> bytes:
        if not self.by_word or not is_plain(text) or any(t in text for t in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=self.dtype).tobytes()
        return self.recent.join(PIECE.findall(text.lower()))


def id_type(path: str) -> np.dtype:
    """Two bytes an id when the vocabulary allows, else four."""
    from tokenizers import Tokenizer
    return np.dtype("<u4" if Tokenizer.from_file(path).get_vocab_size() > 1 << 16 else "<u2")


def signs(n_ids: int) -> np.ndarray:
    """The +1/-1 of every id and dimension, from a multiplicative hash of the id."""
    i = np.arange(n_ids, dtype=np.uint64)[:, None]
    h = (i + np.uint64(1)) * np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                       0xD6E8FEB86659FD93], dtype=np.uint64)[None, :DIMS]
    h ^= h >> np.uint64(29)
    return np.where((h * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(63), 1.0, -1.0).astype(np.float32)


def tokenise(docs: DataFrame, path: str, end_id: int, text_col: str, keep: list[str]) -> DataFrame:
    """``docs`` with ``ids`` (packed, the end id last), ``n`` and the projection ``v0..``."""
    def factory():
        enc = held(("packing", path), lambda: WordEncoder(path))
        end = np.array([end_id], dtype=enc.dtype).tobytes()
        table = signs(max(enc.tokenizer.get_vocab_size(), end_id + 1))

        def f(cols: list[pa.Array]):
            ids, n, vec = [], [], np.empty((len(cols[0]), DIMS))
            gc.disable()        # remembered pieces are no garbage; walking them costs time
            encoded = [enc(t or "") + end for t in cols[0].to_pylist()]
            gc.enable()
            for k, raw in enumerate(encoded):
                a = np.frombuffer(raw, dtype=enc.dtype)
                ids.append(raw)
                n.append(len(a))
                vec[k] = table[a].sum(axis=0) / np.sqrt(len(a))
            return [ids, n, *vec.T]
        return f

    return append_columns(docs, [text_col], TOKENS, factory, keep)


def hilbert_key(cells: np.ndarray, bits: int = GRID_BITS) -> np.ndarray:
    """Hilbert index of integer points, one per row (Skilling's transpose form)."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            hit = (x[i] & q) != 0
            t = (x[0] ^ x[i]) & p
            x[0] = np.where(hit, x[0] ^ p, x[0] ^ t)
            if i:
                x[i] = np.where(hit, x[i], x[i] ^ t)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) != 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def with_key(tokens: DataFrame) -> DataFrame:
    """``tokens`` with ``key``, the Hilbert key of the standardised projection."""
    stats = tokens.agg(*[f(f"v{i}") for i in range(DIMS) for f in (F.avg, F.stddev_pop)]).first()
    mean = np.array([stats[2 * i] or 0.0 for i in range(DIMS)])
    dev = np.array([stats[2 * i + 1] or 1.0 for i in range(DIMS)])

    def factory():
        def f(cols: list[pa.Array]):
            z = (np.column_stack([c.to_numpy() for c in cols]) - mean) / dev
            share = 1.0 / (1.0 + np.exp(-1.702 * np.clip(z, -8, 8)))    # close to the normal distribution function
            return [hilbert_key(np.minimum((share * (1 << GRID_BITS)).astype(np.int64), (1 << GRID_BITS) - 1))]
        return f

    return append_columns(tokens, [f"v{i}" for i in range(DIMS)], T.StructType([T.StructField("key", T.LongType())]),
                          factory, [c for c in tokens.columns if c not in {f"v{i}" for i in range(DIMS)}])


def sequence_bounds(total: int, length: int) -> np.ndarray:
    """Cumulative ends of the sequences of a stream: full ones, then the rest's binary
    digits, largest first."""
    full, rest = divmod(total, length)
    sizes = [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]
    return np.cumsum(np.array([length] * full + sizes, dtype=np.int64))


PIECE_COLUMNS = "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def pack(docs: DataFrame, path: str, end_id: int = 1, length: int = 2048, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset`` and ``ids`` (the piece, little-endian unsigned 32-bit).  Sequence ids are
    unique; a sequence's pieces cover its offsets from 0 without a gap."""
    src = docs.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    tokens = written(tokenise(src, path, end_id, "text", ["doc_id"]), "packing-ids")
    width = id_type(path).itemsize
    ordered = with_key(tokens).select("key", "doc_id", "n", "ids")
    ordered = ordered.repartitionByRange("key", "doc_id").sortWithinPartitions("key", "doc_id", "ids")
    schema = T.StructType([T.StructField("doc_id", src.schema["doc_id"].dataType)] +
                          list(T._parse_datatype_string(PIECE_COLUMNS).fields) + [T.StructField("ids", T.BinaryType())])

    def run(batches):
        from pyspark import TaskContext
        state = {"seq": TaskContext.get().partitionId() << 33, "at": 0}
        tail: list[tuple] = []          # (doc_id, bytes) since the last full sequence, less than one
        schema_of: list = []

        def emit(rows, doc_id, n, start, part, seq, at):
            wide = np.frombuffer(part, dtype=f"<u{width}").astype("<u4").tobytes()
            rows.append((doc_id, start, len(wide) // 4, zlib.crc32(wide), n, seq, at, wide))

        def table(rows, key_type):
            types = [key_type] + [pa.int64()] * 6 + [pa.binary()]
            cols = list(zip(*rows)) if rows else [[]] * 8
            return pa.RecordBatch.from_arrays([pa.array(c, type=t) for c, t in zip(cols, types)], names=schema.names)

        for b in batches:
            schema_of[:] = [b.column(1).type]
            rows: list[tuple] = []
            for doc_id, n, ids in zip(*(b.column(i).to_pylist() for i in (1, 2, 3))):
                start = 0
                while start < n:
                    take = min(n - start, length - state["at"])
                    tail.append((doc_id, n, start, ids[start * width:(start + take) * width], state["at"]))
                    start += take
                    state["at"] += take
                    if state["at"] == length:
                        for d, m, s, part, at in tail:
                            emit(rows, d, m, s, part, state["seq"], at)
                        tail.clear()
                        state["seq"] += 1
                        state["at"] = 0
            yield table(rows, schema_of[0])
        rows = []
        ends = sequence_bounds(state["at"], length)
        for d, m, s, part, at in tail:
            left, size = 0, len(part) // width
            while left < size:
                k = int(np.searchsorted(ends, at + left, side="right"))
                take = min(size - left, int(ends[k]) - at - left)
                emit(rows, d, m, s + left, part[left * width:(left + take) * width], state["seq"] + k,
                     at + left - (int(ends[k - 1]) if k else 0))
                left += take
        if rows:
            yield table(rows, schema_of[0])

    return small_batches(ordered).mapInArrow(run, schema)
