import random

from stockweave.llm import queries, url_filter
from stockweave.llm.url_filter import Rule


def split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = rest[:cut].translate({i: i + 32 for i in range(65, 91)})
    path = rest[cut:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def brute(url, rules, blocked):
    host, path = split(url)
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fits, key=lambda r: len(r.key), default=None)
    listed = any(host == b or host.endswith("." + b) for b in blocked)
    return host, path, rule.key if rule else None, rule.verdict if rule else "block" if listed else "allow"


URLS = [
    None,
    "",
    "no scheme",
    "://",
    "http://",
    "HTTP://WWW.Example.NET/EN/x",
    "http://example.net",
    "http://example.net/en/?q#f",
    "http://notexample.net/en/",
    "http://xnet/",
    "https://a.b.org/fr/1",
    "https://a.b.org/fr",
    "http://u://v.net/x",
    "http://a.spam.test/",
    "http://spam.test?x=/de/",
    "http://xspam.test/",
    "http://é.example.com/de/ü",
    "http://" + "a." * 300 + "net/" + "p" * 5000,
    "http://...net/",
    "http://example.com/de/\nsecond",
]


def judge(spark, urls, rules, blocked, **options):
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, rule string")
    hosts = spark.createDataFrame([(b,) for b in blocked], "host string")
    return {r.page_id: tuple(r)[1:] for r in url_filter.filter_urls(pages, rules, hosts, **options).collect()}


def test_matches_brute_force(spark):
    blocked = ["spam.test", "", None]
    found = judge(spark, URLS * 2, queries.URL_RULES, blocked)
    assert found == {i: brute(u, queries.URL_RULES, blocked[:1]) for i, u in enumerate(URLS * 2)}


def test_shards(spark):
    rnd = random.Random(1)
    hosts = [f"h{rnd.randrange(300)}.test" for _ in range(400)]
    blocked = sorted({rnd.choice(hosts) for _ in range(60)})
    urls = [f"http://{rnd.choice(['', 'www.'])}{h}/en/{i}" for i, h in enumerate(hosts)]
    found = judge(spark, urls, queries.URL_RULES, blocked, max_keys=20)
    assert found == {i: brute(u, queries.URL_RULES, blocked) for i, u in enumerate(urls)}


def test_no_lists_and_no_rows(spark):
    assert judge(spark, ["http://a.net/"], (), []) == {0: ("a.net", "/", None, "allow")}
    assert judge(spark, ["http://a.net/"], (Rule("a.net", "/", "block"),), [])[0][2:] == ("a.net/", "block")
    assert judge(spark, [], queries.URL_RULES, ["a.net"]) == {}


def test_cascade_is_exact_where_filters_are_full(spark, monkeypatch):
    # two bits per key and no spare words: every level lets many wrong keys through
    monkeypatch.setattr(url_filter, "BITS_PER_KEY", 2)
    monkeypatch.setattr(url_filter, "LEAST_WORDS", 1)
    monkeypatch.setattr(url_filter, "PROBES", 1)
    keys = spark.range(3000).selectExpr("cast(id AS string) AS key")
    listed = keys.filter("key % 3 = 0")
    [levels] = url_filter._cascades(keys, listed, 10**6)
    assert len(levels) > 2
    rows = keys.select("key", *url_filter._hashes(keys["key"])).toPandas()
    found = url_filter._listed(rows["h1"].to_numpy(), rows["h2"].to_numpy(), levels)
    assert found.tolist() == [int(k) % 3 == 0 for k in rows["key"]]
