import random

from llm_rows import shipped  # noqa: F401

from loyalspark.llm import url_filter as U
from loyalspark.llm.queries import URL_RULES


def judge(url, rules, default="allow"):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if c.isascii() else c for c in rest[:cut])
        path = rest[cut:]
        path = path[:min([path.find(c) for c in "?#" if c in path] or [len(path)])]
    fits = []
    for action, rule in rules:
        rh, _, rp = rule.partition("/")
        rp = rule[len(rh):]
        if (rh == "" or host == rh or host.endswith("." + rh)) and path.startswith(rp):
            fits.append((len(rule), len(rh), rule, action))
    best = max(fits, default=(0, 0, None, default))
    return host, path, best[2], best[3]


URLS = [None, "", "example.net/en/", "https://example.net", "https://EXAMPLE.net/en/x?q=/fr/", "http://a.example.net/en",
        "http://notexample.net/en/", "http://x.org/fr/a#b", "http://x.org/french/", "http://u@h.net:80/", "ftp://example.com/de/?x",
        "http://example.com/DE/", "x://y://net/", "http://.net/", "http://net/", "http://É.org/fr/", "http://a.net?x://b.org/fr/",
        "http://a.b/c\nd/", "https://example.net/en//"]


def check(spark, urls, rules):
    rows = list(enumerate(urls))
    df = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' AS host", "1 AS rule", "2 AS verdict")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.filter_urls(df, U.rule_frame(spark, rules)).collect()}
    assert got == {i: judge(u, rules) for i, u in rows}


def test_contract_rules(spark):
    check(spark, URLS + URLS, URL_RULES)


def test_many_rules_against_brute_force(spark):
    rnd = random.Random(1)
    hosts = ["net", "org", "a.net", "b.a.net", "x.org", ""]
    paths = ["/", "/a/", "/a/b", "/a/b/", "", "/.*", "/a+b/", "/a/b/c/d/"]
    rules = sorted({(rnd.choice(["allow", "block"]), h + p) for h in hosts for p in paths if rnd.random() < 0.6 and h + p}, key=lambda x: x[1])
    rules = list({r: (a, r) for a, r in rules}.values())
    urls = [f"http://{rnd.choice(['', 'w.', 'b.'])}{rnd.choice(hosts)}{rnd.choice(paths)}{rnd.choice(['', 'z', '?q'])}" for _ in range(300)]
    check(spark, urls, rules)


def test_each_rule_is_indexed_once_under_its_rarest_token(spark):
    index = U.rule_index(U.rule_frame(spark, [*URL_RULES, ("block", "/")])).collect()
    assert {r.rule: r.token for r in index} == {
        "net/": "h:net", "example.net/en/": "p:en", "example.com/de/": "h:com", "org/fr/": "h:org", "/": U.ANY}


def test_beyond_the_broadcast_bound_and_empty_tables(spark, monkeypatch):
    monkeypatch.setattr(U, "MAX_BROADCAST_RULES", 0)
    check(spark, URLS, URL_RULES)
    none = spark.createDataFrame([], "page_id long, url string")
    assert U.filter_urls(none, U.rule_frame(spark, URL_RULES)).count() == 0
    some = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    empty = U.rule_frame(spark, URL_RULES).limit(0)
    assert [r.verdict for r in U.filter_urls(some, empty).collect()] == ["allow"]
