"""op4: all documents packed into sequences of at most 2048 ids along a Hilbert curve."""

from __future__ import annotations

from assay.llm._common import register, table, tokenizer_path
from assay.llm.packing import pack

LENGTH, END_ID = 2048, 1


@register("op4_packing")
def op4_packing(spark, sf_dir):
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), END_ID, LENGTH)
    return pieces.drop("ids")
