"""op10: SimHash fingerprint and near-duplicate component of every document."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.llm._common import register, table
from assay.llm.simhash import near_duplicates

SHINGLE_WORDS, MAX_BITS = 3, 2


@register("op10_simhash")
def op10_simhash(spark, sf_dir):
    out = near_duplicates(table(spark, sf_dir, "documents"), shingle=SHINGLE_WORDS, radius=MAX_BITS)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
