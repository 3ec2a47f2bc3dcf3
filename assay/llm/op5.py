"""op5: main text of every page."""

from __future__ import annotations

from assay.llm._common import register, table
from assay.llm.htmltext import extract


@register("op5_html_text")
def op5_html_text(spark, sf_dir):
    return extract(table(spark, sf_dir, "pages"), keep=["page_id", "url"])
