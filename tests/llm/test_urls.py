import re

from campfin.llm.urls import (HOST_RULES, PATTERN_RULES, file_rules, judge_urls)

URLS = [
    (1, "http://a.example.net/en/5"), (2, "https://A.EXAMPLE.Net/de/5?x=1"),
    (3, "http://example.com/de/1#t"), (4, "http://notexample.com/de/1"),
    (5, "http://b.org/fr/"), (6, "http://spam-farm.example.org/en/1"),
    (7, None), (8, ""), (9, "no scheme/de/"), (10, "http://net"), (11, "http://net/"),
    (12, "://x.net/y://z"), (13, "http://x.net?q=/en/"), (14, "http://cheap-pills.org"),
    (15, "http://a.xxx.org/p"), (16, "http://e.org/ads/pixel"), (17, "http://axxx.org/p"),
    (18, "http://" + "a." * 30000 + "example.com/de/x"), (1, "http://a.example.net/en/5"),
    (None, "http://q.net/"),
]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in HOST_RULES if (host == r.host or host.endswith("." + r.host))
           and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.name), default=None)
    fired = [r for r in PATTERN_RULES if re.search(r.pattern, (url or "").lower())]
    verdict = best.verdict if best else "block" if fired else "allow"
    return host, path, best and best.name, verdict, ",".join(sorted(r.name for r in fired))


def test_brute_force_and_edge_cases(spark):
    df = spark.createDataFrame([(i, u, "x", "y") for i, u in URLS],
                               "page_id long, url string, host string, verdict string")
    got = [tuple(r) for r in judge_urls(df).collect()]
    key = lambda t: str(t[:3])
    assert sorted(got, key=key) == sorted([(i, *brute(u)) for i, u in URLS], key=key)


def test_empty_table(spark):
    assert judge_urls(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_rules_are_filed_under_their_rarest_token():
    index = file_rules(PATTERN_RULES, {"spam": 5, "farm": 2, "cheap": 1, "pills": 3})
    assert [r.name for r in index["farm"]] == ["spam-farm"]
    assert [r.name for r in index["cheap"]] == ["cheap-pills"]
    assert sum(map(len, index.values())) == len(PATTERN_RULES)


def test_no_pattern_rules(spark):
    df = spark.createDataFrame([(1, "http://b.org/fr/")], "page_id long, url string")
    assert judge_urls(df, pattern_rules=()).collect()[0]["verdict"] == "allow"
