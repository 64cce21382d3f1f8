import re

from ledgerline.llm import url_filter
from ledgerline.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme", "http://", "https://EXAMPLE.net/en/x", "http://a.example.net/en/", "http://example.net/de/",
    "http://xexample.net/en/", "http://net/", "http://net", "http://sub.net/q?x://y", "http://b.org/fr/1#z", "http://b.org/fr",
    "http://example.com/de/?a", "http://www.example.com/de/a?b", "http://example.com:80/de/", "ftp://é.example.net/en/é",
    "http://" + "a." * 300 + "example.net/en/" + "p" * 5000, "http://x.net/\nline", "http://example.com/en/", "http://.net/",
]


def brute(url, rules, default="allow"):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda c: c[0].lower(), m[1]), m[2]) if m else ("", "")
    fits = [(len(h + p), len(h), v == "allow", h + p, v) for h, p, v in rules
            if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")]
    best = max(fits, default=None)
    return host, path, best[3] if best else None, best[4] if best else default


def judged(spark, urls, rules):
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(urls)], "page_id long, url string, host string")
    table = spark.createDataFrame(rules, "host string, path string, verdict string")
    got = url_filter.judge_urls(pages, table, ranges=4, salts=3).collect()
    assert sorted(r["page_id"] for r in got) == list(range(len(urls)))
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got}


def test_rules_against_brute_force(spark):
    got = judged(spark, URLS, URL_RULES)
    assert got == {i: brute(u, URL_RULES) for i, u in enumerate(URLS)}


def test_nested_rules_ties_and_odd_rules(spark):
    rules = [("net", "", "block"), ("example.net", None, "allow"), ("a.example.net", "/en/", "block"), ("a.example.net", "/en", "allow"),
             ("net", "", "block"), (None, "/", "block"), ("", "/", "block"), ("org", "/fr/", "allow"), ("org", "/fr/", "block")]
    clean = [(h, p or "", v) for h, p, v in rules]
    urls = [*URLS, "http://a.example.net/en/1", "http://a.example.net/english", "http://c.a.example.net/", "http://other.net"]
    assert judged(spark, urls, rules) == {i: brute(u, [r for r in clean if r[0]]) for i, u in enumerate(urls)}


def test_no_rules_no_pages_and_repeated_pages(spark):
    assert set(judged(spark, URLS, []).values()) == {(*brute(u, [])[:2], None, "allow") for u in URLS}
    pages = spark.createDataFrame([(1, "http://x.net/")] * 500, "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    out = url_filter.judge_urls(pages, rules)
    assert [r["n"] for r in out.groupBy("verdict").count().withColumnRenamed("count", "n").collect()] == [500]
    assert url_filter.judge_urls(pages.limit(0), rules).count() == 0
    plan = out._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_ranges_are_even_on_sorted_input(spark):
    n, ranges = 60_000, 16
    keyed = spark.range(n, numPartitions=12).selectExpr("format_string('%08d.', id) AS _key")  # each partition a range of its own
    bounds = url_filter._bounds(keyed, ranges, 4000)
    cuts = [0, *(int(b[:-1]) for b in bounds), n]
    assert len(bounds) == ranges - 1 and max(b - a for a, b in zip(cuts, cuts[1:])) < 1.5 * n / ranges
    assert len(url_filter._bounds(keyed.limit(5), ranges, 4000)) <= 5


def test_ranges_and_salts_follow_the_session(spark):
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id long, url string")
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "1000")
        many = sorted(map(str, url_filter.judge_urls(pages, rules).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert many == sorted(map(str, url_filter.judge_urls(pages, rules, ranges=1, salts=1).collect()))
