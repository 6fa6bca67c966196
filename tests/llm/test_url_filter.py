from threadwarden.llm import url_filter

RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"),
    ("com", "/de/", "block"), ("net", "", "block"), ("twice.net", "/a", "allow"), ("twice.net", "/a", "block"), (None, "/x", "block"),
]
URLS = [
    "http://a.example.org/en/12?x", "https://EXAMPLE.org/es/", "http://example.org/es", "http://org/", "http://xorg/", "http://b.com/de/x#y",
    "http://b.com/fr/", "http://com?/fr/", None, "", "no scheme", "://", "http://", "http://net", "http://a.net:80/x", "http://a.net/x",
    "http://twice.net/ab", "http://x.twice.net/", "http://com/de/://org/", "http://a..org/" + "x" * 5000, "http://" + "a." * 3000 + "org/q", "HTTP://U:P@h.com/de/",
]


def brute(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    fits = [(len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in RULES if h and (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fits, default=(0, 0, 0, None, "allow"))
    return host, path, best[3], best[4]


def test_verdicts_equal_brute_force(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    rows = [(i % 20, u, "clash") for i, u in enumerate(URLS + URLS[:3])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, host string")
    got = sorted((tuple(r) for r in url_filter.judge_pages(pages, rules).collect()), key=str)
    assert got == sorted(((i, *brute(u)) for i, u, _ in rows), key=str)


def test_empty_tables(spark):
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.com/de/")], "page_id bigint, url string")
    assert url_filter.judge_pages(pages.limit(0), rules).count() == 0
    assert [tuple(r) for r in url_filter.judge_pages(pages, rules.limit(0), "block").collect()] == [(1, "a.com", "/de/", None, "block")]
