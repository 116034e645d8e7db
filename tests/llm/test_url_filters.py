"""URL rules against trying every rule on every URL."""

import random

from feedback_loom.llm import queries, url_filters


def by_hand(url, rules, default="allow"):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min((rest.find(c) for c in "/?#" if c in rest), default=len(rest))
        host, rest = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
        path = rest[:min((rest.find(c) for c in "?#" if c in rest), default=len(rest))]
    fitting = [(len(h + p), len(h), h + p, v) for h, p, v in rules
               if (host == h or host.endswith("." + h)) and path.startswith(p) and host]
    best = max(fitting, default=None)
    return host, path, best and best[2], best[3] if best else default


def judged(spark, urls, rules):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    found = url_filters.judged(pages, spark.createDataFrame(rules, "host string, path string, verdict string"))
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found.collect()}


def test_nested_rules_equal_every_rule_on_every_url(spark):
    rng = random.Random(4)
    labels, parts = ["a", "b", "ab", "com", "net", "x-y"], ["/", "/a", "/a/", "/ab", "/a/b", "/b/", ""]
    rules = {(".".join(rng.choice(labels) for _ in range(rng.randint(1, 3))), rng.choice(parts)): rng.choice(["allow", "block"])
             for _ in range(60)}
    rules = [(h, p, v) for (h, p), v in rules.items()]
    urls = [None, "", "no scheme", "http://", "http:///a", "HTTP://A.COM/a?b://c", "x://a.com#/a", "http://com.a/a/b/c", "https://a.com:80/a"]
    urls += ["http://" + ".".join(rng.choice(labels) for _ in range(rng.randint(1, 5))) + rng.choice(parts) + rng.choice(["", "b", "?a=/b", "#a"])
             for _ in range(400)]
    assert judged(spark, urls, rules) == {i: by_hand(u, rules) for i, u in enumerate(urls)}


def test_longest_rule_wins_and_subdomains_follow(spark):
    rules = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow")]
    got = judged(spark, ["http://example.com/en/1", "http://WWW.example.com/en/1", "http://a.www.example.com/en/", "http://myexample.com/en/x"], rules)
    assert [got[i][2] for i in range(4)] == ["example.com/en/", "www.example.com/en/", "www.example.com/en/", "com/"]


def test_empty_tables_null_rules_and_hot_urls(spark):
    assert judged(spark, [], [("com", "/", "block")]) == {}
    got = judged(spark, ["http://a.com/"] * 500 + ["http://b.net/"], [(None, "/", "block"), ("com", None, "block"), ("", "/", "block")])
    assert set(got.values()) == {("a.com", "/", None, "allow"), ("b.net", "/", None, "allow")} and len(got) == 501
    assert judged(spark, ["http://a.com/x"], [("A.com", "/x", "allow"), ("a.com", "/x", "block")])[0][3] == "block"


def test_no_python_runs(spark, folder):
    plan = queries.op5_url_filters(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
