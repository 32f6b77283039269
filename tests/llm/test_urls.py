import random

from pyspark.sql import functions as F

from shoalmark.llm import urlfilter
from shoalmark.llm.queries import URL_RULES

ODD = [None, "", "no host", "http://", "HTTP://A.NET", "http://A.net/x", "x://org/fr/", "http://b.org/fr",
       "http://www.example.net/en/1?a=1", "http://example.net/en", "http://myexample.net/en/", "http://a.net?x",
       "http://example.com/de/#a", "http://e.org/fr/a://b.net/", "http://net/", "http://x.net\n/y/"]


def explained(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    host = "".join(c.lower() if c.isascii() else c for c in rest[:end])
    path = rest[end:]
    path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    best = None
    for verdict, rule in URL_RULES:
        h, p = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return (host, path, best[1], best[0]) if best else (host, path, None, "allow")


def test_rules_equal_brute_force(spark):
    rng = random.Random(3)
    urls = ODD + [
        "http://" + "".join(rng.choices([".", "net", "org", "example", "com", "a"], k=rng.randint(1, 5)))
        + "".join(rng.choices(["/", "en", "de", "fr", "?", "#", "x"], k=rng.randint(0, 5)))
        for _ in range(300)
    ]
    pages = spark.createDataFrame([(i, u, 1) for i, u in enumerate(urls)], "page_id int, url string, host int")
    got = urlfilter.judge(pages, URL_RULES).collect()
    assert len(got) == len(urls)
    for r in got:
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == explained(urls[r["page_id"]])


def test_mined_rules_block_what_the_labels_show(spark):
    rng = random.Random(5)
    hosts = ["good.com", "bad.com", "fine.org"]
    rows = []
    for _ in range(1500):
        host, path = rng.choice(hosts), rng.choice(["buy", "news", "blog"])
        bad = host == "bad.com" and path == "buy" and rng.random() < 0.95
        rows.append((f"http://{host}/{path}/{rng.randint(0, 99)}?id=1", bad or rng.random() < 0.03))
    labelled = spark.createDataFrame([*rows, (None, True), ("http://x.com", None)], "url string, block boolean")
    rules = urlfilter.mine_rules(labelled)
    assert [sorted(r["tokens"]) for r in rules.collect()] == [["host:bad", "path:buy"]]
    asked = ["http://BAD.com/buy/7", "http://bad.com/news", "http://sub.bad.net/buy", None, "http://good.com/buy/1"]
    pages = spark.createDataFrame(list(enumerate(asked + asked)), "page_id int, url string")
    blocked = {r["page_id"] for r in urlfilter.judge(pages, [], rules).where("verdict = 'block'").collect()}
    assert blocked == {0, 2, 5, 7}
    fired = urlfilter.match_rules(pages, rules).select(F.size("rules").alias("n")).collect()
    assert [r["n"] for r in fired] == [1, 1]


def test_no_labels_and_no_pages(spark):
    none = spark.createDataFrame([], "url string, block boolean")
    rules = urlfilter.mine_rules(none)
    assert rules.count() == 0
    pages = spark.createDataFrame([], "page_id int, url string")
    assert urlfilter.judge(pages, URL_RULES, rules).count() == 0
