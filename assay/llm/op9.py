"""op9: byte-level BPE ids of every document and the round trip back to bytes."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.llm._common import register, table, tokenizer_path
from assay.llm.bytebpe import round_trip

RANKS = "byte_bpe_50k.tiktoken"


@register("op9_byte_bpe")
def op9_byte_bpe(spark, sf_dir):
    import public_tokenizers
    path = tokenizer_path(RANKS)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, path, public_tokenizers.PATTERN, keep=["doc_id"]).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
