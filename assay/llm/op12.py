"""op12: prefix trie of conversations that borrow the first turns of their group's first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm._common import register, table
from assay.llm.convtrie import EMPTY_SHA256, SEGMENT, TRIE_TURNS, digests, ends_digest, numbered, trie

GROUP, HEADS = 5, 9         # conversations of a group; a head has crc32(id) mod HEADS turns

SQL = f"""
WITH t AS MATERIALIZED (
  SELECT conv_id, strlen(coalesce(text, '')) AS nbytes, md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS sym,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS idx
  FROM conversations WHERE conv_id IS NOT NULL),
c AS (
  SELECT conv_id, conv_id - conv_id % {GROUP} AS g, xor(4294967295, list_reduce(
      list_concat([4294967295::BIGINT], list_transform(range(1, length(s) + 1), lambda i: ascii(s[i])::BIGINT)),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                               lambda v, z: xor(v >> 1, 3988292384 * (v & 1))))) % {HEADS} AS h
  FROM (SELECT DISTINCT conv_id, CAST(conv_id AS VARCHAR) AS s FROM t)),
r AS (
  SELECT c.conv_id, t.idx, t.sym, t.nbytes FROM c JOIN t ON t.conv_id = c.g AND t.idx < c.h
  UNION ALL SELECT c.conv_id, t.idx, t.sym, t.nbytes FROM c JOIN t ON t.conv_id = c.conv_id AND t.idx >= c.h),
s AS (
  SELECT c.conv_id, coalesce(l.syms, []) AS syms, coalesce(l.sizes, []) AS sizes FROM c LEFT JOIN
    (SELECT conv_id, list(sym ORDER BY idx) AS syms, list(nbytes ORDER BY idx) AS sizes FROM r GROUP BY conv_id) l USING (conv_id)),
p AS MATERIALIZED (
  SELECT conv_id, d AS depth, md5(array_to_string(syms[1:d], ',')) AS node,
         CASE WHEN d > 0 THEN md5(array_to_string(syms[1:d - 1], ',')) END AS parent,
         CASE WHEN d > 0 THEN sizes[d] ELSE 0 END AS nbytes, d = len(syms) AS ends
  FROM (SELECT *, unnest(range(0, len(syms) + 1)) AS d FROM s)),
n AS MATERIALIZED (
  SELECT depth, node, min(parent) AS parent, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(nbytes) AS saved,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM p GROUP BY depth, node),
k AS (SELECT depth - 1 AS depth, parent AS node, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL),
u AS (
  SELECT a.depth, a.node, sum(n.saved) AS saved_tokens, sum(CASE WHEN k.node IS NULL THEN 1 ELSE 0 END) AS n_leaves
  FROM n JOIN p a ON a.conv_id = n.conv_id AND a.depth <= n.depth LEFT JOIN k ON k.depth = n.depth AND k.node = n.node
  GROUP BY a.depth, a.node)
SELECT n.conv_id, n.depth, up.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n_children, 0) AS n_children,
       CAST(u.n_leaves AS BIGINT) AS n_leaves, CAST(u.saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM n JOIN u ON u.depth = n.depth AND u.node = n.node LEFT JOIN k ON k.depth = n.depth AND k.node = n.node
LEFT JOIN n up ON up.depth = n.depth - 1 AND up.node = n.parent
"""


def with_borrowed_heads(turns: DataFrame) -> DataFrame:
    """Turns of the rebuilt conversations: of the group's first conversation (id - id mod
    ``GROUP``) the first h turns, then the own ones from the h-th on, h being
    crc32(id) mod ``HEADS``; a row of idx -1 stands for every conversation.  A conversation
    meets at most ``HEADS`` - 1 turns of one other."""
    first = F.col("conv") - F.col("conv") % GROUP
    head = F.crc32(F.col("conv").cast("string").cast("binary")) % HEADS
    own = turns.where((F.col("idx") >= head) | (F.col("conv") == first))
    convs = turns.where("idx = 0").select("conv", first.alias("first"), head.alias("head"))
    heads = turns.where((F.col("conv") == first) & (F.col("idx") < HEADS - 1)) \
        .select(F.col("conv").alias("first"), "idx", "sym", "nbytes")
    borrowed = convs.where("conv != first").join(heads, "first").where("idx < head").select("conv", "idx", "sym", "nbytes")
    there = convs.select("conv", F.lit(-1).cast("long").alias("idx"), F.lit(None).cast("binary").alias("sym"),
                         F.lit(None).cast("long").alias("nbytes"))
    return own.unionByName(borrowed).unionByName(there)


def conversation_prefixes(conversations: DataFrame, segment: int = SEGMENT, trie_turns: int = TRIE_TURNS) -> DataFrame:
    turns, most = numbered(digests(conversations))
    nodes, ends = trie(with_borrowed_heads(turns), most, segment, trie_turns)
    out = nodes.join(ends_digest(ends), "fp", "left")
    return out.select(F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
                      F.col("n").alias("n_convs"), "n_children", F.col("leaves").alias("n_leaves"),
                      F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.lit(EMPTY_SHA256)).alias("ends_sha256"))


@register("op12_prefix_trie", SQL)
def op12_prefix_trie(spark, sf_dir):
    return conversation_prefixes(table(spark, sf_dir, "conversations"))
