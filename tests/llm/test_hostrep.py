import random

import pytest
from pyspark.sql import functions as F

from assay.llm import hostrep as H

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


def brute_parts(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host, tail = rest[:cut], rest[cut:]
    cut = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), tail[:cut]


def brute_rule(host, path):
    fit = [(t, a) for a, t in RULES for n, _, p in [t.partition("/")]
           if (host == n or host.endswith("." + n)) and path.startswith("/" + p)]
    return max(fit, key=lambda x: len(x[0]), default=(None, None))


URLS = ["http://A.Example.ORG/es/1?x#y", "https://example.org/en/12", "https://badexample.org/es/", "http://x.com/fr/", "http://com/de/",
        "http://x.com", "http://x.com?/fr/", "http://x.com#/de/", None, "", "no scheme", "//a/b", "http://", "http:///p", "a://b://c/d",
        "HTTP://ÀB.com/De/", "http://u@h.co.uk:80/x", "http://net/", "http://a\nb.org/\nq", "x" * 50_000 + "://h.org/en/" + "y" * 50_000]


def test_parts_and_rules(spark):
    df = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string").withColumn("host", F.lit("clash")) \
        .withColumn("rule", F.lit(1)).withColumn("html", F.lit(None).cast("string"))
    out = spark.createDataFrame([(1, 1), (None, 1), (1, 0)], "key long, bad int")
    got = {r.page_id: r for r in H.judge(df, out, RULES, F.lit(None).cast("long")).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path = brute_parts(u)
        rule, verdict = brute_rule(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or "allow")
    assert H.judge(df.limit(0), out, RULES, F.lit(None).cast("long")).count() == 0


def test_reputation_shrinks_like_the_formula(spark):
    rng = random.Random(2)
    rate = {"bad.spam.net": 0.95, "new.spam.net": 0.9, "a.fine.net": 0.02, "b.fine.net": 0.05, "c.org": 0.1, "d.org": 0.1}
    rows = [(h, int(rng.random() < p)) for h, p in rate.items() for _ in range(200 if h[0] != "n" else 2)]
    rows += [("x.spam.net", None), ("x.fine.net", None), ("", None)]
    got = {r.host: r for r in H.reputation(spark.createDataFrame(rows, "host string, bad int")).collect()}
    assert got["bad.spam.net"].verdict == "block" and got["a.fine.net"].verdict == "allow"
    assert got["x.spam.net"].mean > 0.7 > 0.2 > got["x.fine.net"].mean and got["x.fine.net"].verdict == "allow"
    n, bad = {}, {}
    for h, b in rows:
        n[h] = n.get(h, 0) + (b is not None)
        bad[h] = bad.get(h, 0) + (b or 0)
    dom = lambda h: ".".join(h.split(".")[-2:])
    suf = lambda h: h.split(".")[-1]

    def level(keys, up, parent):
        out = {}
        for k in keys:
            out[k] = (sum(n[h] for h in n if up(h) == k), sum(bad[h] for h in n if up(h) == k))
        live = [(x, y, parent[k]) for k, (x, y) in out.items() if x]
        s = sum(x * (y / x - m) ** 2 for x, y, m in live)
        a = sum(m * (1 - m) for _, _, m in live)
        b = sum((x - 1) * m * (1 - m) for x, _, m in live)
        w = 1 / min(H.MAX_RHO, max(H.MIN_RHO, (s - a) / b)) - 1
        return {k: (y + w * parent[k]) / (x + w) for k, (x, y) in out.items()}

    top = (sum(bad.values()) + 0.5) / (sum(n.values()) + 1)
    ms = level({suf(h) for h in n}, suf, dict.fromkeys({suf(h) for h in n}, top))
    md = level({dom(h) for h in n}, dom, {dom(h): ms[suf(h)] for h in n})
    mh = level(set(n), lambda h: h, {h: md[dom(h)] for h in n})
    for h in n:
        assert got[h].mean == pytest.approx(mh[h], abs=1e-9)


def test_registered_domain(spark):
    hosts = ["a.b.example.com", "example.com", "localhost", "", "x.co.uk", "y.x.co.uk:8080", "me@z.org"]
    d, s = H.registered_domain(F.col("h"))
    got = spark.createDataFrame([(h,) for h in hosts], "h string").select(d, s).collect()
    assert [tuple(r) for r in got] == [("example.com", "com"), ("example.com", "com"), ("localhost", "localhost"), ("", ""),
                                       ("x.co.uk", "co.uk"), ("x.co.uk", "co.uk"), ("z.org", "org")]


def test_plan_is_native(spark):
    from assay.llm.op6 import op6_url_filter
    df = op6_url_filter(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "html"))
