import random

import pytest
from helpers import connection, have_data, same

from kindred.llm import url_filter
from kindred.llm.url_filter import RULES, DigestArray, Rule, judge_urls


def judged(spark, urls, rules=None):
    df = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    out = judge_urls(df, [Rule(*r) for r in (RULES if rules is None else rules)]).orderBy("page_id").collect()
    return [(r["host"], r["path"], r["rule"], r["verdict"]) for r in out]


def test_longest_rule_wins(spark):
    assert judged(spark, ["http://a.example.com/en/71?q#f", "http://example.com/en/8", "http://EXAMPLE.net/de/8", "x://de.net/de/8", "http://other.org/en/", None, "no scheme", "http://", "http://badexample.com/en/7"]) == [
        ("a.example.com", "/en/71", "example.com/en/7", "allow"),
        ("example.com", "/en/8", "com/en/", "block"),
        ("example.net", "/de/8", "example.net/de/8", "block"),
        ("de.net", "/de/8", "net/de/", "allow"),
        ("other.org", "/en/", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("badexample.com", "/en/7", "com/en/", "block"),
    ]


def test_against_all_rules(spark):
    r = random.Random(2)
    hosts, paths = ["a", "b.a", "c.b.a", "d.a", "a.b", ""], ["", "/", "/x", "/x/y", "/é"]
    rules = [(h, p, r.choice(["block", "allow"])) for h in hosts[:5] for p in paths if r.random() < 0.5]
    urls = [f"http://{h}{p}{e}" for h in hosts for p in paths for e in ("", "?a", "#b")]
    for u, (host, path, rule, verdict) in zip(urls, judged(spark, urls, rules), strict=True):
        fits = [(len(h + p), len(h), h, p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        best = max(fits, default=None)
        assert (rule, verdict) == ((best[2] + best[3], best[4]) if best else (None, "allow")), u


def test_collisions_are_confirmed(tmp_path, monkeypatch):
    monkeypatch.setattr(url_filter, "digest", lambda text: 7)
    rules = [Rule("a", "/x", "block"), Rule("b", "/y", "allow"), Rule("c", "", "block")]
    with open(tmp_path / "f", "wb") as f:
        DigestArray.write(f, rules)
    array = DigestArray(str(tmp_path / "f"))
    assert array.judge(["a", "b", "zz", "c"], ["/x", "/y", "/x", "/q"]) == (["a/x", "b/y", None, "c"], ["block", "allow", None, "block"])


def test_very_long_and_repeated_urls(spark):
    long = "http://a.example.com/en/7" + "x" * 200_000
    assert judged(spark, [long, long, "http://" + "a." * 3000 + "org/es/"]) [0][2:] == ("example.com/en/7", "allow")
    df = spark.createDataFrame([(1, "http://a.org/es/1", 5, "z"), (1, "http://a.org/es/1", 5, "z"), (None, None, 5, "z")], "page_id long, url string, judged int, host string")
    out = judge_urls(df, [Rule(*r) for r in RULES])
    assert out.columns == ["page_id", "url", "judged", "host", "path", "rule", "verdict"]
    assert sorted(map(tuple, out.select("page_id", "host", "verdict").collect()), key=str) == [(1, "a.org", "block")] * 2 + [(None, "", "allow")]


def test_empty(spark):
    assert judged(spark, []) == []
    assert judged(spark, ["http://a/b"], []) == [("a", "/b", None, "allow")]


def test_large_lists_take_the_join(spark):
    df = spark.createDataFrame([(1, "http://w.a.b/x/y", "k"), (2, None, "k")], "page_id long, url string, rule string")
    rules = [Rule("b", "/x", "block"), Rule("a.b", "/x/y", "allow"), Rule("b", "/x", "block")]
    assert sorted(map(tuple, judge_urls(df, rules, limit=1).select("page_id", "rule", "verdict").collect())) == [(1, "a.b/x/y", "allow"), (2, None, "allow")]


@pytest.mark.skipif(not have_data(), reason="no test tables")
def test_query(spark, sf):
    same(url_filter.op2_url_filter(spark, sf), connection(sf), url_filter.OP2_SQL)
