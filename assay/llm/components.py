"""Connected components of a link table, as Spark jobs.

Alternating star contraction: each round hangs every node's larger neighbours, then its
smaller ones, onto the smallest neighbour, until every component is a star around its
smallest node.  Rounds grow with the logarithm of a component's size; each is one grouped
minimum (combined before the shuffle) and one join, and its result is cut from its lineage
by a checkpoint in the shared folder.  Links never reach the driver, only two numbers per
round that tell whether the table still changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from assay.llm._common import cut


def _with_minimum(links: DataFrame) -> DataFrame:
    """``links(u, v)`` plus ``m``, the smallest of u's neighbours and u itself."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    return links.join(least, "u")


def _large_star(links: DataFrame) -> DataFrame:
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_minimum(both).where("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(links: DataFrame) -> DataFrame:
    down = links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    near = _with_minimum(down)
    hung = near.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return hung.unionByName(near.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` for every node that has a link to another; ``root`` is the smallest
    node of its component.  Null ends and links of a node with itself are ignored."""
    state = cut(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u != v")
                .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    before = None
    while True:
        now = state.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == before:
            break
        before = now
        state = cut(_small_star(_large_star(state)))
    return state.select(F.col("u").alias("node"), F.col("v").alias("root")) \
        .unionByName(state.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
