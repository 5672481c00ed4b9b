import random

import pytest

from quakeframe.llm import redirects
from quakeframe.llm.components import components


def slow_components(links):
    parent = {}
    for a, b in links:
        if a is not None and b is not None:
            for x in (a, b):
                parent.setdefault(x, x)
    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        if a is not None and b is not None:
            x, y = sorted((root(a), root(b)))
            parent[y] = x
    return {x: root(x) for x in parent}


@pytest.mark.parametrize("shape", ["random", "path", "star", "few"])
def test_components(spark, shape):
    rng = random.Random(shape)
    links = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)], "path": [(i, i + 1) for i in range(120)],
        "star": [(7, i) for i in range(500)], "few": [(1, 1), (2, None), (3, 4), (4, 3), (4, 3)],
    }[shape]
    found = components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == slow_components(links) and len(found) == len(slow_components(links))
    assert components(spark.createDataFrame([], "a string, b string")).collect() == []


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "h", 1) for i, (u, h) in enumerate(rows)], "page_id long, url string, html string, host string, node int")


def link(url):
    return f'<head><LINK href="{url}" rel="canonical"></head>'


def test_rules_and_aliases(spark):
    rows = [
        ("http://Example.ORG/es/x?y#z", ""), ("https://a.example.org/en/12", None), ("http://b.org", ""), ("http://b.org/", ""), ("http://notexample.org/es/", ""),
        ("http://c.com/de/1", ""), ("http://c.com/fr/1", ""), ("http://alias.net/1", link("http://c.com/de/1")), ("http://alias.net/2", link("/1")),
        ("http://both.net/1", link("http://c.com/de/9") + '<meta content="0; url=https://ok.org/" http-equiv=refresh>'), ("http://free.net/", link("//free.net/x")),
        ("http://c.com/fr/2", link("http://c.com/de/2")), (None, link("http://c.com/de/1")), ("c.com/de/", link("http://c.com/de/1")), ("http://c.com/de/1", ""),
        ("http://dir.net/a/b", link("c")), ("http://dir.net/a/c", '<meta http-equiv="Refresh" content="5;URL=http://x.com/de/">'),
    ]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in redirects.judged(pages(spark, rows), redirects.default_rules(spark)).collect()}
    assert found == {
        0: ("example.org", "/es/x", "example.org/es/", "block"), 1: ("a.example.org", "/en/12", "example.org/en/1", "block"), 2: ("b.org", "", None, "allow"),
        3: ("b.org", "/", "org/", "allow"), 4: ("notexample.org", "/es/", "org/", "allow"), 5: ("c.com", "/de/1", "com/de/", "block"), 6: ("c.com", "/fr/1", "com/fr/", "allow"),
        7: ("alias.net", "/1", None, "block"), 8: ("alias.net", "/2", None, "block"), 9: ("both.net", "/1", None, "allow"), 10: ("free.net", "/", None, "allow"),
        11: ("c.com", "/fr/2", "com/fr/", "allow"), 12: ("", "", None, "allow"), 13: ("", "", None, "allow"), 14: ("c.com", "/de/1", "com/de/", "block"),
        15: ("dir.net", "/a/b", None, "block"), 16: ("dir.net", "/a/c", None, "block"),
    }


def test_no_pages_and_no_rules(spark):
    rules = redirects.default_rules(spark)
    assert redirects.judged(pages(spark, []), rules).collect() == []
    found = redirects.judged(pages(spark, [("http://c.com/de/", None)]), rules.limit(0)).collect()
    assert [(r.rule, r.verdict) for r in found] == [(None, "allow")]


def test_character_references_in_targets(column):
    texts = ["a?b=1&amp;c=2", "a&#38;b&#x26;c&#038;d", "&amp;lt;", "&#38;lt;", "&lt;&gt;&quot;&apos;", "caf&#233;&#xE9;&#X1F600;", "a&copy=1&b", "&#0;&#55296;", "", None]
    assert column(texts, "string", redirects.decoded) == [
        "a?b=1&c=2", "a&b&c&d", "&lt;", "&lt;", "<>\"'", "caf\u00e9\u00e9\U0001f600", "a&copy=1&b", "&#0;&#55296;", "", None]


def test_dot_segments_in_targets(column):
    ends = ["/a/b/c/./../../g", "/a/../../../b", "/a/.", "/a/..", "/..", "/a//../b", "/a/.b/..c/d.", "/a/./b?x=/../y#/./z", "?x=/../y", ""]
    expected = ["/a/g", "/b", "/a/", "/", "/", "/a/b", "/a/.b/..c/d.", "/a/b?x=/../y#/./z", "?x=/../y", ""]
    assert column(["http://h" + e for e in ends], "string", redirects.without_dots) == ["http://h" + e for e in expected]


def test_aliases_meet_by_references_and_dots(spark):
    rows = [("http://x.com/blocked/p?a=1&b=2", None), ("http://y.net/q", '<link rel="canonical" href="http://x.com/blocked/p?a=1&amp;b=2">'),
            ("http://x.com/open/deep/r", '<link rel="canonical" href="../.././blocked/s">'), ("http://z.net/t", None)]
    rules = spark.createDataFrame([("x.com", "/blocked/", "block")], redirects.RULE_SCHEMA)
    found = {r.page_id: r.verdict for r in redirects.judged(pages(spark, rows), rules).collect()}
    assert found == {0: "block", 1: "block", 2: "block", 3: "allow"}
    links = {(r.a, r.b) for r in redirects.alias_links(pages(spark, rows)).collect()}
    assert links == {("y.net/q", "x.com/blocked/p?a=1&b=2"), ("x.com/open/deep/r", "x.com/blocked/s")}


def test_targets_without_a_path(spark):
    """A query keeps the page's path, a fragment or nothing is the page itself, other schemes are no links."""
    page = "http://a.net/x/page?y=1"
    targets = {"?y=2": "a.net/x/page?y=2", "#top": "a.net/x/page?y=1", "mailto:me@a.net": None, "javascript:void(0)": None, "other": "a.net/x/other", "HTTPS://b.org/": "b.org/"}
    for target, expected in targets.items():
        found = [r.b for r in redirects.alias_links(pages(spark, [(page, link(target))])).collect()]
        assert found == ([expected] if expected else []), target
    rows = [(page, link("?y=2")), ("http://c.com/de/1", link("#a")), ("http://a.net/x/", ""), ("http://c.com/de/x?q", link("http://a.net/x/page?y=2"))]
    verdicts = {r.page_id: r.verdict for r in redirects.judged(pages(spark, rows), redirects.default_rules(spark)).collect()}
    assert verdicts == {0: "block", 1: "block", 2: "allow", 3: "block"}
