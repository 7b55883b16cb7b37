import random

from filelake.llm import url_filter
from filelake.llm.queries import URL_RULES

URLS = [
    None, "", "no scheme/en/", "http://net", "http://net/", "https://WWW.Example.NET/en/25#top", "http://example.net/en", "http://a.b.example.net/de/1?x",
    "http://example.com/de/", "http://m.example.com/DE/", "http://org/fr/x", "http://x.org/fr", "http://notnet/", "http://a.net:80/", "x://y://net/",
    "http://example.net?en/", "http://example.net#/en/", "http://badexample.com/de/1", "//net/", "http:///en/", "http://net/a\nb",
]


def brute(url, rules):
    """Every rule tried on the url; the longest host, then the longest path."""
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = rest[:cut], rest[cut:]
        host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
        path = rest[: min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    if not fits:
        return host, path, None, "allow"
    h, p, v = max(fits, key=lambda r: (len(r[0]), len(r[1]), r[2] == "block"))
    return host, path, h + p, v


def run(spark, urls, rules):
    df = spark.createDataFrame([(i, u, "old", "old") for i, u in enumerate(urls)], "page_id long, url string, host string, rule string")
    rows = url_filter.judge(df, rules).orderBy("page_id").collect()
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in rows]


def test_rules_of_the_query(spark):
    urls = URLS + URLS[:8]
    assert run(spark, urls, URL_RULES) == [brute(u, URL_RULES) for u in urls]


def test_random_rules(spark):
    random.seed(2)
    hosts, segments = ["a", "b.a", "c.b.a", "b", "a.b"], ["", "x", "xy", "y", "x y"]
    paths = ["/".join(["", *random.choices(segments, k=random.randint(0, 3))]) for _ in range(30)] + [""]
    rules = [(random.choice(hosts), random.choice(paths), random.choice(["allow", "block"])) for _ in range(40)]
    urls = [f"h://{random.choice(['', 'w.'])}{random.choice(hosts)}{random.choice(paths)}{random.choice(['', '?q', '#f'])}" for _ in range(300)]
    assert run(spark, urls, rules) == [brute(u, rules) for u in urls]


def test_no_rules_and_no_rows(spark):
    assert {v for *_, v in run(spark, URLS, [])} == {"allow"}
    assert url_filter.judge(spark.createDataFrame([], "page_id long, url string"), URL_RULES).count() == 0
