"""op8: vectors of one label whose cosine reaches 0.93, and their components."""

from __future__ import annotations

from assay.llm._common import register, table
from assay.llm.pqdedup import near_duplicates

THRESHOLD = 0.93

SQL = f"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_dot_product(a.e, b.e) / (sqrt(list_dot_product(a.e, a.e)) * sqrt(list_dot_product(b.e, b.e))) >= {THRESHOLD}),
reach(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS low FROM reach GROUP BY a),
d AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT x.vec_id, coalesce(d.n, 0) AS n_links, least(x.vec_id, coalesce(c.low, x.vec_id)) AS component_id,
       x.vec_id = least(x.vec_id, coalesce(c.low, x.vec_id)) AS kept
FROM embeddings x LEFT JOIN c ON c.a = x.vec_id LEFT JOIN d ON d.a = x.vec_id
"""


@register("op8_embedding_dedup", SQL)
def op8_embedding_dedup(spark, sf_dir):
    return near_duplicates(table(spark, sf_dir, "embeddings"), THRESHOLD)
