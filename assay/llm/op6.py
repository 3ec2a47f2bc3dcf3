"""op6: verdict on every page url.

A page's address ends in the number of the document it shows, and ``labels`` judges
documents: a page is a bad outcome when its document is labelled low quality or toxic.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from assay.llm import hostrep as H
from assay.llm._common import register, table

#: Fixed rules: a longer rule wins over a shorter one.
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]
DOCUMENT = r"^/[a-z]+/([0-9]{1,18})(?:$|[./])"


def _rule_sql(what: int) -> str:
    cases = []
    for action, text in sorted(RULES, key=lambda r: -len(r[1])):
        name, _, tail = text.partition("/")
        cases.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{tail}') "
                     f"THEN '{(action, text)[what]}'")
    return "CASE " + " ".join(cases) + " END"


def _level_sql(name: str, source: str, keys: str) -> str:
    """Shrunk means of one level: ``source`` has keys, n, bad, parent."""
    return f"""
{name}_s AS (SELECT 1 / greatest({H.MIN_RHO}, least({H.MAX_RHO}, coalesce(
    (sum(n * (bad / n - parent) * (bad / n - parent)) - sum(parent * (1 - parent)))
    / nullif(sum((n - 1) * parent * (1 - parent)), 0), {H.MAX_RHO}))) - 1 AS s FROM {source} WHERE n > 0),
{name}_m AS (SELECT {keys}, n, bad, s, (bad + s * parent) / (n + s) AS mean FROM {source}, {name}_s)"""


TAIL = ("CASE WHEN len(p) > 2 AND length(p[-1]) = 2 AND p[-2] IN ("
        + ", ".join(f"'{x}'" for x in H.SECOND_LEVEL) + ") THEN 2 ELSE 1 END")

SQL = f"""
WITH rest AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
host0 AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM rest),
base AS (
  SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM host0),
outcome AS (SELECT doc_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 WHEN quality IS NULL AND toxic IS NULL THEN NULL ELSE 0 END) AS bad
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
seen AS (
  SELECT host, bad FROM base LEFT JOIN outcome
    ON doc_id = TRY_CAST(regexp_extract(path, '^/[a-z]+/([0-9]{{1,18}})($|[./])', 1) AS BIGINT)),
hosts0 AS (
  SELECT host, count(bad) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad,
         string_split(regexp_replace(regexp_replace(host, '^.*@', ''), ':[0-9]*$', ''), '.') AS p FROM seen GROUP BY host),
hosts1 AS (SELECT *, {TAIL} AS t FROM hosts0),
hosts AS (SELECT host, n, bad, array_to_string(p[greatest(len(p) - t, 1):], '.') AS domain,
                 array_to_string(p[greatest(len(p) - t + 1, 1):], '.') AS suffix FROM hosts1),
domains AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL),
suffixes AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY suffix),
top AS (SELECT (coalesce(sum(bad), 0) + 0.5) / (coalesce(sum(n), 0) + 1.0) AS parent FROM suffixes),
suffix_p AS (SELECT suffixes.*, parent FROM suffixes, top),
{_level_sql('suffix', 'suffix_p', 'suffix')},
domain_p AS (SELECT d.*, m.mean AS parent FROM domains d JOIN suffix_m m USING (suffix)),
{_level_sql('domain', 'domain_p', 'domain, suffix')},
host_p AS (SELECT h.*, m.mean AS parent FROM hosts h JOIN domain_m m USING (domain, suffix)),
{_level_sql('host', 'host_p', 'host')},
verdicts AS (SELECT host, CASE WHEN mean - {H.Z} * sqrt(mean * (1 - mean) / (n + s + 1)) > {H.MAX_BAD}
  THEN 'block' ELSE 'allow' END AS method FROM host_m)
SELECT page_id, host, path, {_rule_sql(1)} AS rule, coalesce({_rule_sql(0)}, method) AS verdict
FROM base JOIN verdicts USING (host)
"""


@register("op6_url_filter", SQL)
def op6_url_filter(spark, sf_dir):
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1) \
        .when(F.col("quality").isNotNull() | F.col("toxic").isNotNull(), 0)
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("key"), bad.alias("bad"))
    key = F.expr(f"try_cast(regexp_extract(path, '{DOCUMENT}', 1) as bigint)")
    return H.judge(table(spark, sf_dir, "pages"), outcomes, RULES, key)
