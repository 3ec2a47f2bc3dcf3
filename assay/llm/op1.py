"""op1: language of every document, learned from the documents that are not held out."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.llm._common import register, table
from assay.llm.langid import identify, labelled_sample


def fold(doc_id):
    """crc32 of the id's decimal text, modulo 3; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


@register("op1_language_id")
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    sample = labelled_sample(docs.where(fold(F.col("doc_id")) != 1))
    out = identify(docs.select("doc_id", "text"), sample, keep=["doc_id"])
    return out.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"),
                      "lang_pred", "score")
