import random
import re

import pytest

from dockside.llm import url_rules

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(url, rules):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.split("[/?#]", rest, maxsplit=1)[0]
        path = re.split("[?#]", rest[len(host):], maxsplit=1)[0]
        host = host.translate(LOW)
    fits = [(len(h) + len(p), h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return (host, path, *max(fits)[1:]) if fits else (host, path, None, "allow")


EDGES = [
    None, "", "no scheme/net/", "http://", "http://net", "http://net/", "http://NET/x", "https://a.b.example.net/en/1?x#y", "http://example.net/en",
    "http://xexample.net/en/", "http://example.net:80/en/", "http://.net/", "http://a..net/", "x://y://z.net/q", "http://foo.org/fr/?a", "http://org/fr/",
    "http://example.com/de/\n/x", "http://example-a.net/", "http://example.com?/de/", "HTTP://WWW.EXAMPLE.COM/de/", "http://ünï.net/é", "http://[::1]/net/",
]


@pytest.mark.parametrize("segment", [1_000_000, 3])
def test_against_all_rules(spark, segment):
    rng = random.Random(5)
    labels = ["a", "b", "a-b", "ab", "com", "net"]
    rules = list(url_rules.RULES)
    for _ in range(30):
        h = ".".join(rng.choices(labels, k=rng.randint(1, 4)))
        p = "/" + "".join(rng.choices(["x/", "y", "x"], k=rng.randint(0, 3)))
        if (h, p) not in [(a, b) for a, b, _ in rules]:
            rules.append((h, p, rng.choice(["allow", "block"])))
    urls = EDGES + ["http://" + ".".join(rng.choices(labels, k=rng.randint(1, 5))) + "/" + "".join(rng.choices(["x/", "y", "x"], k=3)) for _ in range(400)]
    urls += ["http://www.example.net/en/hot"] * 50
    pages = spark.createDataFrame([(k, u, "html", "host", "r") for k, u in enumerate(urls)], "page_id long, url string, html string, host string, rule string")
    got = url_rules.judge(pages, url_rules.rule_table(spark, rules), segment_urls=segment).collect()
    assert len(got) == len(urls)
    for r in got:
        host, path, rule, verdict = plain(urls[r.page_id], rules)
        assert (r.host, r.path, r.verdict) == (host, path, verdict)
        if r.rule != rule:  # of equally long rules either may be named
            assert len(r.rule) == len(rule)


def test_edges(spark):
    rules = url_rules.rule_table(spark)
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(none, rules).count() == 0
    twice = spark.createDataFrame([(None, "http://a.net/"), (None, "http://a.net/"), (1, None)], "page_id long, url string")
    assert sorted(r.verdict for r in url_rules.judge(twice, rules).collect()) == ["allow", "block", "block"]
    no_rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert {r.verdict for r in url_rules.judge(twice, no_rules, default="block").collect()} == {"block"}
    contrary = url_rules.rule_table(spark, [("net", "/", "allow"), ("net", "/", "block")])
    assert sorted(r.verdict for r in url_rules.judge(twice, contrary).collect()) == ["allow", "block", "block"]


def test_no_python_in_the_plan(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    plan = url_rules.judge(pages, url_rules.rule_table(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
