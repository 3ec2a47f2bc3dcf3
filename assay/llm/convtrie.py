"""Prefix trie of conversations, built from z-fast tries inside tasks.

``numbered`` gives every turn its place in its conversation: a range sort by conversation,
turn and digest cuts even one conversation with a third of all rows over many tasks; each
task counts from its own start, and the few counts that cross a task's border (a row per
task) reach the driver and go back as a table of that size.  Texts stay behind: a turn is
from then on a 128-bit digest of role and text and its number of bytes.

``trie`` works on segments, at most ``SEGMENT`` turns of one conversation.  A prefix is
known by a 127-bit polynomial fingerprint; where a conversation has several segments, the
fingerprint at a segment's start comes from the affine maps of the earlier ones.  Tasks
insert their segments into z-fast tries (``zfast.ZFastTrie``) of bounded size and write the
expanded nodes: one row for each node and local trie, however many conversations share it.
Rows of equal fingerprint are one node of the whole trie.  Each node is owned by the local
trie that holds its smallest member, so a sum over a subtree is the sum, over the local
tries that know the node, of what they own below it: every local trie adds up its own tree
and one grouped sum joins them.  Sums of whole segments below a segment's end climb by
pointer doubling over the segments' starts.  Nothing is grouped by first turn, conversation
or node beyond one row for each local trie.

Edge cases: rows without a conversation id take no part; null role or text is empty; turns
of equal number (or null, which comes first) stand in the order of their digests; repeated
rows are turns of their own; an empty table gives no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from assay.llm._common import col, cut, small_batches, written
from assay.llm.zfast import ZFastTrie
from assay.operators._small import collect_bounded

SEGMENT = 65_536            # turns of one conversation handled together
TRIE_TURNS = 131_072        # turns in one local trie
RANGE_ROWS = 2_000_000      # turns in one task of the range sort
MAX_TASKS = 1_000_000       # tasks whose border counts the driver takes
CHUNK_IDS = 4_096

PRIME = (1 << 127) - 1      # modulus of the prefix fingerprints
BASE = 0x3C6EF372FE94F82BA54FF53A5F1D36F1
SEED = 0x1F83D9ABFB41BD6B5BE0CD19137E2179
ROOT = SEED.to_bytes(16, "big")
EMPTY_SHA256 = hashlib.sha256(b"").hexdigest()


def digests(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> DataFrame:
    """``(conv, turn, sym, nbytes)``: digest of role and text and the text's UTF-8 length."""
    role = F.coalesce(col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(col(text_col).cast("string"), F.lit(""))
    return conversations.where(col(conv_col).isNotNull()).select(
        col(conv_col).cast("long").alias("conv"), col(turn_col).alias("turn"),
        F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text))).alias("sym"),
        F.octet_length(text).cast("long").alias("nbytes"))


def _run_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Place of each row in its task's run of one conversation; rows arrive sorted."""
    task, last, count = TaskContext.get().partitionId(), None, 0
    for b in batches:
        if not b.num_rows:
            continue
        conv = b.column(0).to_numpy(zero_copy_only=False)
        start = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
        length = np.diff(np.append(start, len(conv)))
        place = np.arange(len(conv)) - np.repeat(start, length)
        if conv[0] == last:
            place[:length[0]] += count
        last, count = conv[-1], int(place[-1]) + 1
        yield pa.RecordBatch.from_arrays([pa.array(np.full(len(conv), task, dtype=np.int32)), b.column(0), pa.array(place),
                                          b.column(1), b.column(2)], names=["task", "conv", "idx", "sym", "nbytes"])


def numbered(turns: DataFrame, range_rows: int = RANGE_ROWS) -> tuple[DataFrame, int]:
    """``(conv, idx, sym, nbytes)`` with idx from 0 inside each conversation, and a number
    that no idx exceeds (-1 without rows)."""
    spark = turns.sparkSession
    keys = ["conv", "turn", "sym"]
    need = -(-turns.count() // range_rows)
    by = [*keys, F.rand(17)]            # equal rows may part
    dealt = turns.repartitionByRange(need, *by) if need > int(spark.conf.get("spark.sql.shuffle.partitions")) \
        else turns.repartitionByRange(*by)
    placed = small_batches(dealt.sortWithinPartitions(*keys).select("conv", "sym", "nbytes")) \
        .mapInArrow(_run_places, "task int, conv long, idx long, sym binary, nbytes long")
    placed = written(placed, "conversation-turns")
    seen = sorted(collect_bounded(placed.groupBy("task").agg(
        F.min("conv").alias("first"), F.max("conv").alias("last"), F.max("idx").alias("most"),
        F.max_by("idx", F.struct("conv", "idx")).alias("end")), MAX_TASKS), key=lambda r: r["task"])
    borders, before, most = [], None, -1
    for r in seen:
        offset = before[1] if before is not None and before[0] == r["first"] else 0
        if offset:
            borders.append((r["task"], r["first"], offset))
        most = max(most, r["most"] + offset)
        before = (r["last"], r["end"] + 1 + (offset if r["first"] == r["last"] else 0))
    out = placed
    if borders:
        side = spark.createDataFrame(borders, "task int, conv long, offset long")     # at most one row for each task
        out = out.join(F.broadcast(side), ["task", "conv"], "left") \
            .withColumn("idx", F.col("idx") + F.coalesce("offset", F.lit(0)))
    return out.select("conv", "idx", "sym", "nbytes"), most


def _number(b: bytes) -> int:
    return int.from_bytes(b, "big")


def _bytes(x: int) -> bytes:
    return x.to_bytes(16, "big")


def _sequences(column: pa.Array) -> Iterator[tuple[list[bytes], list[int]]]:
    """Digests and sizes of each row's turns."""
    flat, at = column.flatten(), 0
    syms, sizes = flat.field("sym").to_pylist(), flat.field("nbytes").to_pylist()
    for n in column.value_lengths().to_pylist():
        yield syms[at:at + n], sizes[at:at + n]
        at += n


def _affine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each segment: its turns and the map x -> m * x + c of its fingerprint."""
    for b in batches:
        n, m, c = [], [], []
        for syms, _ in _sequences(b.column(2)):
            y = 0
            for sym in syms:
                y = (y * BASE + _number(sym)) % PRIME
            n.append(len(syms))
            m.append(_bytes(pow(BASE, len(syms), PRIME)))
            c.append(_bytes(y))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(m, pa.binary()),
                                          pa.array(c, pa.binary())], names=["conv", "block", "n", "m", "c"])


def _starts(rows: pd.DataFrame) -> pd.DataFrame:
    """Depth and fingerprint where each segment of one conversation begins."""
    rows = rows.sort_values("block")
    depth, x, out = 0, SEED, []
    for conv, block, n, m, c in rows[["conv", "block", "n", "m", "c"]].itertuples(index=False):
        out.append((conv, block, depth, _bytes(x), False))
        depth, x = depth + n, (_number(m) * x + _number(c)) % PRIME
    out[-1] = (*out[-1][:4], True)
    return pd.DataFrame(out, columns=["conv", "block", "depth", "start", "last"])


def segments(turns: DataFrame, most: int, size: int = SEGMENT) -> DataFrame:
    """``(conv, turns, depth, start, last)``: the turns of a conversation in pieces, each
    with the depth and fingerprint it begins at.  ``turns(conv, idx, sym, nbytes)`` orders a
    conversation by idx (gaps are allowed, at most ``most``); a row of idx -1 only says that
    the conversation exists."""
    turn = F.when(F.col("idx") >= 0, F.struct("idx", "sym", "nbytes"))
    pieces = turns.withColumn("block", F.floor(F.greatest("idx", F.lit(0)) / size)).groupBy("conv", "block") \
        .agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    if most < size:
        return pieces.select("conv", "turns", F.lit(0).cast("long").alias("depth"), F.lit(ROOT).alias("start"),
                             F.lit(True).alias("last"))
    pieces = written(pieces, "conversation-segments")
    maps = small_batches(pieces.join(pieces.where("block > 0").select("conv").distinct(), "conv", "left_semi")
                         .select("conv", "block", "turns")).mapInArrow(_affine, "conv long, block long, n long, m binary, c binary")
    starts = maps.groupBy("conv").applyInPandas(_starts, "conv long, block long, depth long, start binary, last boolean")
    return pieces.join(starts, ["conv", "block"], "left").select(
        "conv", "turns", F.coalesce("depth", F.lit(0).cast("long")).alias("depth"),
        F.coalesce("start", F.lit(ROOT)).alias("start"), F.coalesce("last", F.lit(True)).alias("last"))


NODE_ROWS = "trie long, nid int, up int, depth long, fp binary, parent binary, root binary, size long, n long, conv long, inside boolean, is_end boolean"


def _local_tries(limit: int):
    names = [f.split()[0] for f in NODE_ROWS.split(", ")]
    types = {"trie": pa.int64(), "nid": pa.int32(), "up": pa.int32(), "depth": pa.int64(), "fp": pa.binary(),
             "parent": pa.binary(), "root": pa.binary(), "size": pa.int64(), "n": pa.int64(), "conv": pa.int64(),
             "inside": pa.bool_(), "is_end": pa.bool_()}

    def rows_of(columns: dict) -> pa.RecordBatch:
        size = len(columns["fp"])
        return pa.RecordBatch.from_arrays([pa.array(columns[c], types[c]) if c in columns else pa.nulls(size, types[c])
                                           for c in names], names=names)

    def expanded(serial: int, held: dict) -> Iterator[pa.RecordBatch]:
        """Nodes of the local tries, one trie for each (depth, fingerprint) its segments begin at."""
        out = {c: [] for c in ("nid", "up", "depth", "fp", "parent", "root", "size", "n", "conv")}
        for (depth, start), batch in held.items():
            trie, first = ZFastTrie(start), len(out["fp"])
            trie.insert_batch(batch)
            for d, fp, up, size, n, least, _ in trie.expand():
                top = d == 0 and depth > 0      # counted by the trie that ends here
                out["nid"].append(len(out["fp"]))
                out["up"].append(first + up if up >= 0 else -1)
                out["depth"].append(depth + d)
                out["fp"].append(_bytes(fp))
                out["parent"].append(out["fp"][first + up] if up >= 0 else None)
                out["root"].append(_bytes(start) if depth > 0 else None)
                out["size"].append(size)
                out["n"].append(0 if top else n)
                out["conv"].append(None if top else least)
        if out["fp"]:
            inside = np.zeros(len(out["fp"]), dtype=bool)       # has a node right below it
            inside[[u for u in out["up"] if u >= 0]] = True
            out["inside"], out["trie"] = inside, [serial] * len(out["fp"])
            out["is_end"] = [False] * len(out["fp"])
            yield rows_of(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        serial, held, inside = TaskContext.get().partitionId() << 32, {}, 0
        for b in batches:
            ends: dict = {"fp": [], "conv": []}
            rest = (b.column(i).to_pylist() for i in (0, 2, 3, 4))
            for (syms, sizes), conv, depth, start, last in zip(_sequences(b.column(1)), *rest):
                x = _number(start)
                path = [x]
                for sym in syms:
                    x = (x * BASE + _number(sym)) % PRIME
                    path.append(x)
                if syms or depth == 0:
                    held.setdefault((depth, path[0]), []).append((path, sizes, conv))
                    inside += len(path)
                if last:
                    ends["fp"].append(_bytes(x))
                    ends["conv"].append(conv)
                if inside >= limit:
                    yield from expanded(serial, held)
                    serial, held, inside = serial + 1, {}, 0
            if ends["fp"]:
                yield rows_of(ends | {"is_end": [True] * len(ends["fp"])})
        yield from expanded(serial, held)
    return run


def _below(owned: DataFrame) -> DataFrame:
    """``(fp, saved, leaves)``: what stands below each segment start, through all later
    segments.  The starts form a tree (the start above is the root of the trie that ends
    here); sums climb it by doubling, in as many rounds as the logarithm of its height."""
    own = owned.where("root is not null").groupBy(F.col("root").alias("fp")).agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaves"))
    up = owned.where("own").select("fp", F.col("root").alias("up"))
    state = cut(own.join(up, "fp"))
    while not state.where("up is not null").isEmpty():
        added = state.where("up is not null").groupBy(F.col("up").alias("fp")).agg(F.sum("saved").alias("s"), F.sum("leaves").alias("l"))
        above = state.select(F.col("fp").alias("up"), F.col("up").alias("up2"))
        state = cut(state.join(added, "fp", "left").join(above, "up", "left").select(
            "fp", F.col("up2").alias("up"), (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"),
            (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves")))
    return state.select("fp", "saved", "leaves")


LOCAL_SUMS = "fp binary, up binary, saved long, leaves long, parent_conv long, depth long, conv long, n long"


def _local_sums(t: pa.Table) -> pa.Table:
    """Subtree sums inside one local trie; what describes a node goes with its owner."""
    t = t.sort_by("nid")
    up, depth = t["up"].to_numpy(), t["depth"].to_numpy()
    saved, leaves = t["saved"].to_numpy().copy(), t["leaf"].to_numpy().copy()
    conv = t["conv"].to_pylist()
    order = np.argsort(depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[order])) + 1
    for level in reversed(np.split(order, cuts)):
        level = level[up[level] >= 0]
        np.add.at(saved, up[level], saved[level])
        np.add.at(leaves, up[level], leaves[level])
    own, inner = t["own"].to_pylist(), t["inner"].to_pylist()
    keep = np.flatnonzero(np.array(inner, dtype=bool))
    out = pa.table({
        "fp": t["fp"], "up": pa.array([p if o else None for p, o in zip(t["parent"].to_pylist(), own)], pa.binary()),
        "saved": pa.array(saved), "leaves": pa.array(leaves),
        "parent_conv": pa.array([conv[u] if u >= 0 else None for u in up.tolist()], pa.int64()),
        "depth": pa.array(depth), "conv": pa.array(conv, pa.int64()), "n": t["total"].cast(pa.int64())})
    return out.take(pa.array(keep))


def ends_digest(ends: DataFrame, chunk: int = CHUNK_IDS) -> DataFrame:
    """``(fp, ends_sha256)`` of ``ends(fp, conv)``: SHA-256 of each fingerprint's ids in
    ascending order, in decimal, joined by commas.  Ids are sorted by range and turned into
    pieces of text in parallel; one task then reads a fingerprint's pieces one by one."""
    def pieces(batches):
        key, ids = None, []

        def done():
            return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([ids[0]], pa.int64()),
                                               pa.array([",".join(map(str, ids))], pa.string())], names=["fp", "conv", "ids"])
        out = []
        for b in batches:
            for fp, conv in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if ids and (fp != key or len(ids) >= chunk):
                    out.append(done())
                    ids = []
                key = fp
                ids.append(conv)
                if len(out) >= 4096:
                    yield from _joined(out)
                    out = []
        if ids:
            out.append(done())
        yield from _joined(out)

    def hashed(batches):
        key, state, fps, shas = None, None, [], []
        for b in batches:
            for fp, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if fp != key:
                    if key is not None:
                        fps.append(key)
                        shas.append(state.hexdigest())
                    key, state = fp, hashlib.sha256(ids.encode())
                else:
                    state.update(b"," + ids.encode())
            if fps:
                yield pa.RecordBatch.from_arrays([pa.array(fps, pa.binary()), pa.array(shas)], names=["fp", "ends_sha256"])
                fps, shas = [], []
        if key is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])],
                                             names=["fp", "ends_sha256"])

    parts = ends.repartitionByRange("fp", "conv").sortWithinPartitions("fp", "conv") \
        .mapInArrow(pieces, "fp binary, conv long, ids string")
    return small_batches(parts.repartition("fp").sortWithinPartitions("fp", "conv").select("fp", "ids")) \
        .mapInArrow(hashed, "fp binary, ends_sha256 string")


def _joined(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    if batches:
        yield from pa.Table.from_batches(batches).combine_chunks().to_batches()


def trie(turns: DataFrame, most: int, segment: int = SEGMENT, trie_turns: int = TRIE_TURNS) -> tuple[DataFrame, DataFrame]:
    """``(nodes, ends)`` of the trie of all conversations in ``turns`` (see ``segments``).

    ``nodes``: fp, depth, conv (smallest member), parent_conv, n (members), n_children,
    leaves (childless nodes of the subtree), saved (sum over the subtree of (n - 1) times the
    bytes of a node's last text).  ``ends``: (fp, conv), the node each conversation ends at.
    """
    local = written(small_batches(segments(turns, most, segment).select("conv", "turns", "depth", "start", "last"))
                    .mapInArrow(_local_tries(trie_turns), NODE_ROWS), "conversation-tries")
    ends = local.where("is_end").select("fp", "conv")
    same = Window.partitionBy("fp")             # one row for each local trie that knows the node
    member = F.when(F.col("n") > 0, F.struct("conv", "trie"))
    inner = local.where("not is_end")
    owned = inner.select("trie", "nid", "up", "depth", "fp", "parent", "root", "size", (F.col("n") > 0).alias("inner"),
                         F.sum("n").over(same).alias("total"), F.min(member).over(same).alias("first"), F.max("inside").over(same).alias("kids"),
                         F.max("size").over(same).alias("bytes"))
    own = F.col("inner") & (F.col("first.trie") == F.col("trie"))
    owned = owned.select("trie", "nid", "up", "depth", "fp", "parent", "root", "inner", "total", F.col("first.conv").alias("conv"),
                         own.alias("own"), F.when(own, (F.col("total") - 1) * F.col("bytes")).otherwise(0).alias("saved"),
                         F.when(own & ~F.col("kids"), 1).otherwise(0).cast("long").alias("leaf"))
    if most >= segment:
        owned = written(owned, "conversation-nodes")
        lower = _below(owned)
        owned = owned.join(lower.select("fp", F.col("saved").alias("s"), F.col("leaves").alias("l")), "fp", "left") \
            .withColumn("saved", F.col("saved") + F.when(F.col("own"), F.coalesce("s", F.lit(0))).otherwise(0)) \
            .withColumn("leaf", F.col("leaf") + F.when(F.col("own"), F.coalesce("l", F.lit(0))).otherwise(0)).drop("s", "l")
    sums = owned.groupBy("trie").applyInArrow(_local_sums, LOCAL_SUMS)
    row = F.struct("fp", "saved", "leaves", "parent_conv", "depth", "conv", "n", F.lit(0).cast("long").alias("child"))
    none = [F.lit(None).cast("long").alias(c) for c in ("saved", "leaves", "parent_conv", "depth", "conv", "n")]
    child = F.struct(F.col("up").alias("fp"), *none, F.lit(1).cast("long").alias("child"))
    nodes = sums.select(F.inline(F.when(F.col("up").isNull(), F.array(row)).otherwise(F.array(row, child)))) \
        .groupBy("fp").agg(F.max("depth").alias("depth"), F.max("conv").alias("conv"), F.max("parent_conv").alias("parent_conv"),
                           F.max("n").alias("n"), F.sum("child").alias("n_children"), F.sum("leaves").alias("leaves"),
                           F.sum("saved").alias("saved"))
    return nodes, ends
