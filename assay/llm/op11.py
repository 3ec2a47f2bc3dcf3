"""op11: codes of four parts of every vector, their errors and the trained codebooks."""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.llm._common import register, table
from assay.llm.veccodes import ENTRIES, PARTS, ROUNDS, SCALE, encode, train, with_label_error


def oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same rounds as one chain of statements (vectors of one length)."""
    def assigned(i: int) -> str:
        return f"""
a{i} AS MATERIALIZED (
  SELECT p.rid, p.part, min(list_sum(list_transform(list_zip(p.q, b.q), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::HUGEINT
                            * {entries} + b.entry) AS best
  FROM p JOIN b{i} b ON p.part = b.part GROUP BY p.rid, p.part)"""

    def moved(i: int) -> str:
        return f"""
m{i} AS (
  SELECT part, entry, list(m ORDER BY pos) AS q FROM (
    SELECT part, entry, pos, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS m
    FROM (SELECT p.part, a.best % {entries} AS entry, unnest(range(1, len(p.q) + 1)) AS pos, unnest(p.q) AS x
          FROM p JOIN a{i - 1} a ON p.rid = a.rid AND p.part = a.part) GROUP BY part, entry, pos) GROUP BY part, entry),
b{i} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.q, b.q) AS q FROM b{i - 1} b LEFT JOIN m{i} m ON m.part = b.part AND m.entry = b.entry)"""

    steps = [assigned(0)]
    for i in range(1, rounds + 1):
        steps += [moved(i), assigned(i)]
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS rid, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS MATERIALIZED (
  SELECT rid, part, list_slice(q, part * (len(q) // {parts}) + 1, (part + 1) * (len(q) // {parts})) AS q
  FROM v CROSS JOIN (SELECT unnest(range({parts})) AS part)),
b0 AS MATERIALIZED (
  SELECT part, row_number() OVER (PARTITION BY part ORDER BY rid) - 1 AS entry, q FROM p
  WHERE rid <= {entries} AND rid IN (SELECT rid FROM v WHERE vec_id IS NOT NULL)),
{",".join(s.strip() for s in steps)},
books AS (
  SELECT sha256(string_agg(array_to_string(q, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM b{rounds}),
c AS (
  SELECT rid, string_agg(lower(printf('%02x', CAST(best % {entries} AS INTEGER))), '' ORDER BY part) AS code,
         CAST(sum(best // {entries}) AS BIGINT) AS error FROM a{rounds} GROUP BY rid),
r AS (SELECT v.vec_id, v.label, c.code, c.error FROM v JOIN c USING (rid))
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r CROSS JOIN books
"""


@register("op11_vector_codes", oracle())
def op11_vector_codes(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    books = train(vectors, parts=PARTS, entries=ENTRIES, rounds=ROUNDS, scale=SCALE)
    digest = F.lit(None).cast("string")
    for dim in books.books:
        digest = F.when(F.col("dim") == dim, F.lit(books.digest(dim))).otherwise(digest)
    out = with_label_error(encode(vectors.select("vec_id", "label", "embedding"), books))
    code = F.array_join(F.transform("codes", lambda c: F.lower(F.lpad(F.hex(c), 2, "0"))), "")
    return out.select("vec_id", code.alias("code"), "error", "label_error", digest.alias("codebooks_sha256"))
