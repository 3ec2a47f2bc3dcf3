"""op13: toxicity score of every document."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.llm._common import register, table
from assay.llm.toxicity import labelled_sample, score, train

FOLDS, THRESHOLD = 5, 0.5


def held_out(doc_id):
    """Whether nothing may be learned from a row (a row without an id has no label)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


@register("op13_toxicity")
def op13_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", "toxic")
    model = train(*labelled_sample(docs, labels.where(~held_out(F.col("doc_id")))))
    scored = score(docs, model, keep=["doc_id"])
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
