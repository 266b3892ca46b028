"""URL rules against a plain judge, and the index that finds them."""

import random

import pytest
from pyspark.sql import functions as F

from tontine.llm import queries, url_rules


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host_end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    path_end = min([rest.find(c) for c in "?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:host_end])
    return host, rest[host_end:path_end], host + rest[host_end:]


def site_fits(rule, host, path):
    name, slash, rest = rule.partition("/")
    return (host == name or host.endswith("." + name)) and path.startswith(slash + rest)


def pattern_fits(pattern, text):
    """Tries every start; ``*`` by trying every end."""
    text = text.lower()
    plain = lambda c: c.isascii() and c.isalnum()
    host = min([text.find(c) for c in "/?#" if c in text], default=len(text))
    body, starts = pattern.lower(), range(len(text) + 1)
    if body.startswith("||"):
        body, starts = body[2:], [0, *[i + 1 for i in range(host) if text[i] == "."]]
    elif body.startswith("|"):
        body, starts = body[1:], [0]
    at_end = body.endswith("|")
    body = body[: len(body) - at_end]

    def rest(i, j):
        if j == len(body):
            return not at_end or i == len(text)
        c = body[j]
        if c == "*":
            return any(rest(k, j + 1) for k in range(i, len(text) + 1))
        if c == "^":
            if i in (0, len(text)) and rest(i, j + 1):
                return True
            return i < len(text) and not plain(text[i]) and rest(i + 1, j + 1)
        return i < len(text) and text[i] == c and rest(i + 1, j + 1)

    return any(rest(i, 0) for i in starts)


def plain_judge(url, sites, patterns):
    host, path, address = parts(url)
    fitting = [(len(rule), verdict == "block", rule) for rule, verdict in sites if site_fits(rule, host, path)]
    if fitting:
        _, block, rule = max(fitting)
        return host, path, rule, "block" if block else "allow", None
    matching = [(verdict == "allow", pattern) for pattern, verdict in patterns if pattern_fits(pattern, address)]
    if matching:
        allow, pattern = max(matching)
        return host, path, None, "allow" if allow else "block", pattern
    return host, path, None, "allow", None


SITES = [*queries.SITE_RULES, ("a.b", "block"), ("b/x", "allow"), ("example.org/en/10", "allow"), ("c.d/", "block"), ("C.d/", "allow")]
PATTERNS = [
    *url_rules.PATTERNS, ("*secret*page", "block"), ("ow", "block"), ("|start.", "block"), ("^x^", "block"), ("||sub.*/deep|", "block"),
    ("(a+b)[c].$", "block"), ("\\", "allow"), ("", "allow"),
]
URLS = [
    None, "", "no scheme", "://", "http://", "http://org", "http://ORG/", "http://org?x", "http://a.org/", "http://xorg/", "http://org./",
    "http://example.org/es/", "http://a.example.org/es", "http://EXAMPLE.org/en/1", "http://example.org/EN/1", "http://example.org/en/10",
    "http://b.example.org/en/123?q#f", "http://notexample.org/en/1", "http://x.com/fr/", "http://x.com/de/1#top", "http://com/de/",
    "http://a.b", "http://a.b/x", "http://z.a.b?x", "http://a.bc", "http://b/xyz", "http://c.d/1", "http://u@h:80/p", "http://a://b/c",
    "http://h.net/ads/1", "http://h.net/ADS/1", "http://m.casino-win.net/", "http://h.net/casinos", "http://ads.h.net", "http://h.net/pic.JPG",
    "http://h.net/pic.jpg?x", "http://en.wikipedia.org.net/login", "http://en.wikipedia.org", "http://wikipedia.org?login", "http://h.net/login",
    "http://h.net/a secret big page", "http://start.net", "http://x.start.net", "http://sub.h.net/deep", "http://h.net/sub./deep",
    "http://h.net/(a+b)[c].$", "http://h.net/back\\slash", "http://h.net/\nx\n", "http://h.net/é/x", "x://" + "ab." * 20 + "org/es/",
    "http://h.net/" + "login" * 20,
]


def judged(spark, urls, sites, patterns):
    rows = spark.createDataFrame(
        [(i if i % 7 else None, u, "r", "t", 1) for i, u in enumerate(urls)], "page_id long, url string, rule string, tokens string, row int"
    )
    got = url_rules.judge(rows, url_rules.rule_table(spark, sites), url_rules.rule_table(spark, patterns))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "pattern"]
    return got


def expected(urls, sites, patterns):
    return sorted(((i if i % 7 else None, *plain_judge(u, sites, patterns)) for i, u in enumerate(urls)), key=repr)


@pytest.mark.parametrize("patterns", [PATTERNS[:-1], url_rules.PATTERNS, []])
def test_matches_plain_judge(spark, patterns):
    urls = [*URLS, *URLS[::5]] + random.Random(3).choices(URLS[:20], k=40)
    got = sorted(map(tuple, judged(spark, urls, SITES, patterns).collect()), key=repr)
    assert got == expected(urls, SITES, patterns)


def test_empty_pattern_matches_all(spark):
    got = judged(spark, ["http://h.net/", None], [], [("", "block")]).collect()
    assert {r.verdict for r in got} == {"block"}


def test_beyond_the_broadcast_bound(spark, monkeypatch):
    monkeypatch.setattr(url_rules, "BROADCAST_BYTES", 0)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = judged(spark, URLS, SITES, PATTERNS)
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Broadcast" not in plan and "NestedLoop" not in plan and "Cartesian" not in plan
        assert sorted(map(tuple, df.collect()), key=repr) == expected(URLS, SITES, PATTERNS)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def test_long_addresses_are_read_whole(spark):
    urls = ["x://" + "ab." * 20_000 + "org/es/", "http://h.net/" + "a" * 500_000 + "/ads/"]
    got = judged(spark, urls, SITES, url_rules.PATTERNS).select("rule", "verdict", "pattern").collect()
    assert sorted(map(tuple, got), key=repr) == [("org/", "allow", None), (None, "block", "/ads/")]


def test_no_rules_and_no_pages(spark):
    assert {r.verdict for r in judged(spark, URLS, [], []).collect()} == {"allow"}
    assert judged(spark, [], SITES, PATTERNS).count() == 0


def test_rules_are_filed_under_their_rarest_token(spark):
    addresses = spark.createDataFrame([(["", "com", "a"],), (["", "com", "b"],), (["", "com", "b"],)], "tokens array<string>")
    rules = [("com/a/", "block"), ("a.b/", "block"), ("x.com/", "allow"), ("com/never/", "allow")]
    ranked = url_rules._ranked(url_rules.rule_table(spark, rules), url_rules.rule_table(spark, [("part", "block"), ("^com^*", "block")]))
    index = url_rules.indexed(ranked, addresses).join(ranked.select("rank", "rule"), "rank")
    assert {r.rule: r.token for r in index.collect()} == {
        "com/a/": "a", "a.b/": "a", "x.com/": "x", "com/never/": "never", "part": "", "^com^*": "com",
    }


def test_whole_tokens(spark):
    texts = ["||example.org^ads", "abc", "/abc/", "|x*y.z|", "^k=", ".JPG|"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", url_rules.whole_tokens(F.col("t")).alias("w"))
    assert {r.t: r.w for r in df.collect()} == {
        "||example.org^ads": ["example", "org"], "abc": [], "/abc/": ["abc"], "|x*y.z|": ["z"], "^k=": ["k"], ".JPG|": ["jpg"],
    }


def test_no_python_on_the_way(spark):
    plan = queries.op11_url_rules(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
