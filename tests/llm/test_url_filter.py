"""URL rules against a plain loop, on nested rules, odd urls and empty tables."""

import random

from eventlake.llm import url_filter as U

URLS = "page_id bigint, url string, host string"
RULES = "host string, path string, verdict string"


def plain(url, rules, default="allow"):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:n])
    m = next((i for i, c in enumerate(rest[n:]) if c in "?#"), len(rest) - n)
    path = rest[n : n + m]
    fits = [(len(h) + len(p), len(h), v, h + p) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, max(fits)[3], max(fits)[2]) if fits else (host, path, None, default)


def judged(spark, urls, rules, default="allow"):
    df = spark.createDataFrame([(k, u, "clash") for k, u in enumerate(urls)], URLS)
    out = U.judged(df, spark.createDataFrame(rules, RULES), default)
    assert out.columns == ["row", "host", "path", "rule", "verdict"]
    got = sorted((r.row.page_id, r.host, r.path, r.rule, r.verdict) for r in out.collect())
    assert got == [(k, *plain(u, rules, default)) for k, u in enumerate(urls)]


def test_random_urls_and_nested_rules(spark):
    rng = random.Random(5)
    label = lambda: rng.choice(["a", "b", "ab", "example", "org", "com", "ü", ""])
    path = lambda: "".join(rng.choice(["/", "a", "b", "/a", "en", "?", "#x"]) for _ in range(rng.randrange(6)))
    host = lambda n: ".".join(label() for _ in range(rng.randrange(1, n)))
    rules = list({(host(4), p.replace("?", "").replace("#x", "")): "allow" for p in [path() for _ in range(300)]})
    rules = [(h, p, rng.choice(["allow", "block"])) for h, p in rules]
    urls = [f"http://{host(6)}{path()}" for _ in range(3000)] + ["https://b.org/a"] * 500
    judged(spark, urls, rules, "block")


def test_odd_urls(spark):
    rules = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/es/x", "allow"), ("c", "", "block"), ("", "", "block")]
    urls = [None, "", "no scheme", "://", "http://", "http://EXAMPLE.org/es/", "http://wwwexample.org/es/", "http://www.example.org/es/x/y?z", "http://example.org/ES/", "http://example.org?/es/", "ftp://c", "x://a.c#d/e", "http://c:80/", "http://a://c", "http://" + "a." * 3000 + "c/" + "p" * 100_000, "http://org/\nb?"]
    judged(spark, urls + urls[:8], rules)


def test_equal_rules_nulls_and_case(spark):
    df = spark.createDataFrame([(1, "http://X.com/a", "")], URLS)
    rules = spark.createDataFrame([("COM", "/", "allow"), ("com", "/", "block"), (None, "/", "block"), ("x.com", None, None), ("com", None, "allow")], RULES)
    assert [(r.rule, r.verdict) for r in U.judged(df, rules).collect()] == [("com/", "block")]


def test_empty_tables(spark):
    judged(spark, [], [("org", "/", "block")])
    judged(spark, ["http://a.org/"], [])


def test_plan_has_no_python(spark):
    df = U.judged(spark.createDataFrame([(1, "http://a.org/", "")], URLS), spark.sql("select 'org' host, '/' path, 'block' verdict"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
