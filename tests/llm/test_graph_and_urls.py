"""Connected components against union-find; operator 1."""

import random

import pytest

from godown.llm import url_filter
from godown.llm.components import components


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)] + [(100 + i, 101 + i) for i in rng.sample(range(40), 40)]
    edges += [(500, 600 + i) for i in range(30)] + [(7, 7), (None, 3)]
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x
    for a, b in edges:
        if a is not None:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: find(n) for n in parent if find(n) != n}


def page(url, html=""):
    return (url, html)


def test_rules_and_aliases(spark):
    link = '<link rel="canonical" href="%s">'
    pages = [
        page("http://a.example.com/en/1"),                                   # blocked by its rule
        page("http://www.example.com/en/1"),                                 # the longer rule allows
        page("HTTP://A.NET/es/x?utm_source=f#t"),                            # blocked
        page("http://mirror.org/x", link % "https://a.net/es/x"),            # alias of a blocked page
        page("https://www.mirror.org/x#top"),                                # alias of the alias
        page("http://far.org/y", '<META http-equiv="refresh" content="0; URL=http://mirror.org/x">'),
        page("http://rel.org/d/a", "<link href='/b' rel='canonical'>"),
        page("http://rel.org/b", link % "http://a.net/fr/z"),
        page("http://a.net/fr/z"),
        page("http://both.org/1", link % "http://b.net/fr/1"),
        page("http://b.net/fr/1", link % "http://good.com/1"),               # explicit allow in the component
        page("http://good.com/1"),
        page(None), page("no scheme"), page(""), page("http://com"), page("http://x.com:80/p"), page("http://notcom/"),
    ]
    rows = spark.createDataFrame([(i, u, h, "clash") for i, (u, h) in enumerate(pages)], "page_id long, url string, html string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(rows).collect()}
    assert got[0] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[1] == ("www.example.com", "/en/1", "www.example.com/en/", "allow")
    assert got[2] == ("a.net", "/es/x", "net/es/", "block")
    assert [got[i][2:] for i in (3, 4, 5, 6, 7)] == [(None, "block")] * 5
    assert got[8][2:] == ("net/fr/", "block")
    assert got[9][2:] == (None, "allow") and got[10][2:] == ("net/fr/", "block") and got[11][2:] == ("com/", "allow")
    assert got[12] == got[13] == got[14] == ("", "", None, "allow")
    assert got[15] == ("com", "", None, "allow") and got[16][2] is None and got[17][2] is None


def test_redirect_table_and_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "http://a.org/1", None), (1, "http://a.org/1", None), (2, "http://b.net/es/", None)], "page_id long, url string, html string")
    to = spark.createDataFrame([("http://a.org/1", "http://c.org/"), ("http://c.org/", "http://b.net/es/")], "src_url string, dst_url string")
    got = sorted((r["page_id"], r["verdict"]) for r in url_filter.judge(rows, redirects=to).collect())
    assert got == [(1, "block"), (1, "block"), (2, "block")]
    assert url_filter.judge(rows.limit(0)).count() == 0
