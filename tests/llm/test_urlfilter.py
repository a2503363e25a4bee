import random

from duelframe.llm import urlfilter


def brute(url, rules):
    host = path = ""
    if url is not None and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        path = rest[cut:]
        path = path[: min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fit = [(len(h + p), len(h), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[3], best[2] if best else "allow"


def test_against_brute_force(spark):
    rng = random.Random(8)
    rules = urlfilter.RULES + [("block", "a.example.com", ""), ("allow", "example.com", "/en/77/x"), ("block", "xample.com", "/"), ("allow", "org", "/es/1")]
    urls = [None, "", "no scheme/en/7", "http://", "HTTPS://EXAMPLE.Com/en/7?x#y", "http://com/en/", "http://example.com", "x://a://b/en/", "http://example.com#/en/7", "http://.com/en/", "http://é.org/es/1\n/z", "http://example.net/de/8" + "a" * 5000]
    for _ in range(400):
        host = rng.choice(["", "www.", "a.", "b.a."]) + rng.choice(["example", "xexample", "other"]) + rng.choice([".com", ".net", ".org", ".COM"])
        urls.append(f"http://{host}/{rng.choice(['en', 'de', 'es', 'EN'])}/{rng.choice(['', '7', '77/x', '8', '1'])}{rng.choice(['', '?a=/en/7', '#z'])}")
    pages = spark.createDataFrame([(i, u, "r", "h") for i, u in enumerate(urls)] + [(3, urls[3], "r", "h"), (None, urls[5], "r", "h")], "page_id long, url string, rule string, host string")
    got = urlfilter.filter_urls(pages, spark.createDataFrame(rules, "verdict string, host string, path string")).collect()
    assert len(got) == len(urls) + 2
    by = {i: brute(u, rules) for i, u in enumerate(urls)} | {None: brute(urls[5], rules)}
    for r in got:
        assert (r.host, r.path, r.rule, r.verdict) == by[r.page_id], urls[r.page_id or 5]


def test_rules_that_clash_and_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    schema = "verdict string, host string, path string"
    rules = spark.createDataFrame([("allow", "A.com", "/x"), ("block", "a.com", "/x"), (None, "com", "/x"), ("block", None, "/"), ("block", "com", None)], schema)
    assert urlfilter.filter_urls(pages, rules).first().verdict == "block"
    assert urlfilter.filter_urls(pages, rules.limit(0)).first().verdict == "allow"
    assert urlfilter.filter_urls(pages.limit(0), rules).count() == 0


def test_hosts_of_thousands_of_labels(spark):
    deep = "a." * 5000
    urls = [f"http://{deep}example.com/en/7", f"http://{deep}com/en/", f"http://{deep}net", f"http://{deep}co.uk/x/y", f"http://{'b.' * 3}x.co.uk/x/y"]
    rules = [*urlfilter.RULES, ("block", "x.co.uk", "/x"), ("allow", "a.a.a.co.uk", "/x/y")]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = urlfilter.filter_urls(pages, spark.createDataFrame(rules, "verdict string, host string, path string")).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: brute(u, rules) for i, u in enumerate(urls)}


def test_hot_and_many_urls_without_a_broadcast(spark, monkeypatch):
    monkeypatch.setattr(urlfilter, "MOST_URLS", 0)
    urls = ["http://example.com/en/7"] * 200 + [None] * 50 + [f"http://x{i}.org/es/{i}" for i in range(40)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = urlfilter.filter_urls(pages, spark.createDataFrame(urlfilter.RULES, "verdict string, host string, path string")).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {i: brute(u, urlfilter.RULES) for i, u in enumerate(urls)}


def test_no_python_in_the_plan(spark):
    plan = urlfilter.op8_url_filters(spark, "/root/testdata/sf0.01")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
