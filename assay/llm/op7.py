"""op7: license phrases and notices in every document."""

from __future__ import annotations

from assay.llm._common import register, table
from assay.llm.licenses import scan


@register("op7_license_scan")
def op7_license_scan(spark, sf_dir):
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text"), keep=["doc_id"])
