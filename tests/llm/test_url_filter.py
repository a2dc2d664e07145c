from __future__ import annotations

from tessera.llm import queries, url_filter
from brute import SF_SMALL  # noqa: F401


def _host_path(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    n = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    path = rest[n:]
    m = min([path.find(c) for c in "?#" if c in path] or [len(path)])
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n]), path[:m]


def _rule(host, path, rules):
    best = None
    for said, text in rules:
        own, _, rest = text.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest) and (best is None or len(text) > len(best[1])):
            best = said, text
    return best


def test_rules_and_parts(spark):
    urls = [None, "", "no scheme", "http://", "http://A.Example.NET/en/x?y#z", "https://example.net/en", "http://xnet/", "http://net/",
            "http://b.net?x", "http://example.com/de/1", "http://notexample.com/de/1", "ftp://u:p@h.org:80/fr/?", "http://É.org/fr/a#b?c",
            "http://x://y/z", "http://q.org/FR/"]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    outcomes = spark.createDataFrame([], "url string, bad int")
    got = url_filter.filter_urls(pages, outcomes, page_id="page_id", url="url", rules=queries.URL_RULES).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path = _host_path(urls[r.page_id])
        rule = _rule(host, path, queries.URL_RULES)
        assert (r.host, r.path) == (host, path)
        assert (r.rule, r.verdict) == ((rule[1], rule[0]) if rule else (None, "allow"))


def test_reputation_shrinks_and_blocks(spark):
    bad = [("http://www.spam.example.org/%d" % i, 1) for i in range(40)]
    good = [("http://h%d.good.org/%d" % (h, i), 0) for h in range(20) for i in range(10)]
    outcomes = spark.createDataFrame([*bad, *good, ("http://one.good.org/", 1), ("http://z.org/", None)], "url string, bad int")
    pages = spark.createDataFrame([(1, "http://www.spam.example.org/new"), (2, "http://one.good.org/new"), (3, "http://h1.good.org/new"),
                                   (4, "http://new.good.org/"), (5, "http://new.org/"), (6, "http://new.info/"), (7, None)],
                                  "page_id long, url string")
    got = {r.page_id: r for r in url_filter.filter_urls(pages, outcomes, page_id="page_id", url="url").collect()}
    assert got[1].verdict == "block" and all(got[i].verdict == "allow" for i in range(2, 8))
    assert [got[i].level for i in range(1, 8)] == ["host", "host", "host", "domain", "suffix", "overall", "overall"]
    assert got[3].bad_rate < got[2].bad_rate < 0.6 < got[1].bad_bound < got[1].bad_rate
    assert url_filter.filter_urls(pages.limit(0), outcomes, page_id="page_id", url="url").count() == 0


def test_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF_SMALL}/pages.parquet").select("page_id", "url").collect()}
    got = queries.op8_url_filter(spark, SF_SMALL).collect()
    assert len(got) == len(pages)
    for r in got:
        host, path = _host_path(pages[r.page_id])
        rule = _rule(host, path, queries.URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule and rule[1])
        assert r.verdict == (rule[0] if rule else r.verdict) and r.verdict in ("allow", "block")


def _beta_quantile(a, b, p, steps=4000):
    """By summing the density on a fine grid (for a, b from 1 on)."""
    import math
    top = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    total = 0.0
    for i in range(steps):
        x = (i + 0.5) / steps
        total += math.exp(top + (a - 1) * math.log(x) + (b - 1) * math.log(1 - x)) / steps
        if total >= p:
            return x
    return 1.0


def test_bound_against_the_exact_quantile(spark):
    from pyspark.sql import functions as F
    pairs = [(a, b) for a in (1.0, 1.5, 2.0, 5.0, 20.0, 100.0) for b in (1.0, 1.2, 3.0, 10.0, 80.0)]
    df = spark.createDataFrame(pairs, "a double, b double").select("a", "b", url_filter.lower_bound(F.col("a"), F.col("b"), 1.645).alias("x"))
    for r in df.collect():
        exact = _beta_quantile(r.a, r.b, 0.05)
        assert abs(r.x - exact) < 0.06
        if r.a >= r.b and r.x > 0.5:
            assert r.x - exact < 0.06


def test_repeated_rows_and_long_urls(spark):
    long = "http://a.b.org/" + "x" * 200_000 + "?" + "y" * 1000
    rows = [(1, long), (1, long), (2, "http://" + "h" * 100_000 + ".org/fr/"), (None, "http://b.net/")]
    outcomes = spark.createDataFrame([("http://a.b.org/1", 1)] * 3, "url string, bad int")
    got = url_filter.filter_urls(spark.createDataFrame(rows, "page_id long, url string"), outcomes, page_id="page_id", url="url",
                                 rules=queries.URL_RULES).collect()
    assert len(got) == 4 and sorted((r.page_id is None, len(r.host), len(r.path)) for r in got) == [
        (False, 7, 200_001), (False, 7, 200_001), (False, 100_004, 4), (True, 5, 1)]
    assert {r.rule for r in got} == {None, "org/fr/", "net/"}


def test_suffixes_are_a_parameter(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("x.github.io",), ("x.y.own.zz",)], "h string")
    got = df.select(url_filter.domain_of(F.col("h")).alias("d"), url_filter.domain_of(F.col("h"), ["own.zz"]).alias("o")).collect()
    assert [tuple(r) for r in got] == [("x.github.io", "github.io"), ("own.zz", "y.own.zz")]
