"""URL filters: explicit rules first, then an empirical-Bayes host reputation.

Everything is DataFrame and SQL functions.

Reputation.  Labelled page outcomes (bad or not) are counted per host, summed to the
registered domain and the public suffix.  At each level a beta prior centred on the
parent's posterior mean shrinks the child: ``mean = (bad + s * parent) / (n + s)``.  The
strength ``s`` of a level is estimated from the data by moments: with children i of n_i
outcomes, share p_i and parent mean m_i,

    rho = (sum n_i (p_i - m_i)^2 - sum m_i (1 - m_i)) / sum (n_i - 1) m_i (1 - m_i),  s = 1 / rho - 1,

so children that differ no more than chance get a strong prior.  A host is blocked when
the lower bound of its posterior, ``mean - Z * sd``, exceeds ``MAX_BAD``; a host without
outcomes is judged by its domain or suffix alone.  Outcomes are summed per host before the
first shuffle, and everything after works on one row per host, so a host with a third of
all pages is one row there; only three numbers per level reach the driver.

Edge cases: a null url or one without ``://`` has empty host and path and gets the
verdict of the empty host; rules compare with the host as written (lower-cased, a port
stays part of it), the registered domain is taken without user and port; a page without a
label counts no outcome; a url whose host has one label only is its own domain and suffix.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from assay.llm._common import col, written

ALLOW, BLOCK = "allow", "block"
MAX_BAD, Z = 0.5, 1.645
MIN_RHO, MAX_RHO = 0.001, 0.999
#: Second-level names that act as suffixes under a country code (fixed values).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def matched_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict (null without one).  Equal lengths: the
    blocking one, then the one that sorts first."""
    rule = verdict = None
    for action, text in sorted(rules, key=lambda r: (-len(r[1]), r[0] != BLOCK, r[1])):
        name, _, tail = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + tail)
        rule = F.when(fits, text) if rule is None else rule.when(fits, text)
        verdict = F.when(fits, action) if verdict is None else verdict.when(fits, action)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def registered_domain(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    parts = F.split(name, r"\.")
    n = F.size(parts)
    two = (n > 2) & (F.length(F.get(parts, n - 1)) == 2) & F.get(parts, n - 2).isin(*SECOND_LEVEL)
    tail = F.when(two, 2).otherwise(1)
    last = lambda k: F.array_join(F.slice(parts, F.greatest(n - k + 1, F.lit(1)), k), ".")
    return last(tail + 1), last(tail)


def strength(level: DataFrame) -> float:
    """Prior strength of ``level(n, bad, parent)`` by moments."""
    p, m = F.col("bad") / F.col("n"), F.col("parent")
    spread = m * (1 - m)
    s, a, b = level.where("n > 0").agg(F.sum(F.col("n") * (p - m) * (p - m)), F.sum(spread),
                                       F.sum((F.col("n") - 1) * spread)).first()
    rho = (s - a) / b if b else MAX_RHO
    rho = min(MAX_RHO, max(MIN_RHO, rho))
    return 1 / rho - 1


def reputation(pages: DataFrame, max_bad: float = MAX_BAD, z: float = Z) -> DataFrame:
    """One row per host of ``pages(host, bad)`` (``bad`` null, 0 or 1): ``host, n, bad,
    mean, bound, verdict``."""
    domain, suffix = registered_domain(F.col("host"))
    hosts = written(pages.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
                    .withColumn("domain", domain).withColumn("suffix", suffix), "host-outcomes")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = suffixes.agg(F.sum("n"), F.sum("bad")).first()
    top = ((bad or 0) + 0.5) / ((n or 0) + 1.0)

    def shrunk(level: DataFrame, keep: list[str]) -> DataFrame:
        s = F.lit(strength(level))
        return level.select(*keep, "n", "bad", "parent", s.alias("s"),
                            ((F.col("bad") + s * F.col("parent")) / (F.col("n") + s)).alias("mean"))

    suffixes = shrunk(suffixes.withColumn("parent", F.lit(top)), ["suffix"])
    domains = domains.join(suffixes.select("suffix", F.col("mean").alias("parent")), "suffix")
    domains = shrunk(domains, ["domain", "suffix"])
    hosts = hosts.join(domains.select("domain", "suffix", F.col("mean").alias("parent")), ["domain", "suffix"])
    hosts = shrunk(hosts, ["host"])
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("s") + 1))
    return hosts.select("host", "n", "bad", "mean", (F.col("mean") - F.lit(z) * sd).alias("bound")) \
        .withColumn("verdict", F.when(F.col("bound") > max_bad, BLOCK).otherwise(ALLOW))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]], outcome_key: Column,
          url_col: str = "url", keep: tuple[str, ...] = ("page_id",), max_bad: float = MAX_BAD) -> DataFrame:
    """Every page's ``host, path, rule, verdict``.  ``outcomes(key, bad)`` holds labelled
    outcomes; ``outcome_key`` derives a page's key from its ``host`` and ``path``."""
    host, path = url_parts(F.col("_url"))
    base = pages.select(*[col(c).alias(f"_k{i}") for i, c in enumerate(keep)], col(url_col).cast("string").alias("_url")) \
        .withColumn("host", host).withColumn("path", path).drop("_url")
    labelled = base.select("host", outcome_key.alias("key")) \
        .join(outcomes.where("key is not null").groupBy("key").agg(F.max("bad").alias("bad")), "key", "left")
    rep = reputation(labelled.select("host", "bad"), max_bad).select("host", F.col("verdict").alias("_method"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    return base.join(rep, "host").select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(keep)], "host", "path",
                                         rule.alias("rule"), F.coalesce(verdict, F.col("_method")).alias("verdict"))
