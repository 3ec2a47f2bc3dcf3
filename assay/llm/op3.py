"""op3: documents without the passages that an earlier document holds."""

from __future__ import annotations

from assay.llm._common import register, table
from assay.llm.linededup import deduplicate


@register("op3_substring_dedup")
def op3_substring_dedup(spark, sf_dir):
    return deduplicate(table(spark, sf_dir, "documents"), keep=["doc_id", "text"])
