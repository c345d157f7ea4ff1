"""Operator 12: wrappers accept what they were inferred from; main text on given and invented templates."""

from __future__ import annotations

import copy
import html
import json
import random
import re

import pytest

from conftest import SF_SMALL
from godown.llm import html_wrappers as W
from godown.llm import queries


def pattern(items):
    """The wrapper as a regular expression over token streams."""
    out = ""
    for k, q, sub in items:
        one = "#" if k == "#" else pattern(sub) if k == "(" else f"<{re.escape(k)}>{pattern(sub)}</{re.escape(k)}>"
        out += f"(?:{one}){'' if q == '1' else q}"
    return out


def stream(items):
    return "".join("#" if k == "#" else f"<{k}>{stream(sub)}</{k}>" for k, q, sub in items)


def random_items(r, depth=0):
    out = []
    for _ in range(r.randrange(1, 5 if depth else 4)):
        if r.random() < 0.3 or depth == 3:
            if not out or out[-1][0] != "#":
                out.append(["#", "1", []])
        else:
            out += [[k, "1", random_items(r, depth + 1)] for k in r.choice(["p", "d", "pp", "dt", "dtdt", "u"])]
    return out


@pytest.mark.parametrize("seed", range(40))
def test_wrapper_accepts_its_pages(seed):
    r = random.Random(seed)
    pages = [random_items(r) for _ in range(r.randrange(1, 6))]
    shapes = [json.dumps(W.folded(copy.deepcopy(p))) for p in pages]
    wrapper = json.loads(W.wrapper_of(shapes))
    assert not re.search(r"(?<!\\)\|", pattern(wrapper))                         # union-free
    for p, s in zip(pages, shapes):
        assert re.fullmatch(pattern(json.loads(s)), stream(p))
        assert re.fullmatch(pattern(wrapper), stream(p)), (stream(p), pattern(wrapper))
        at = W.slots_of_shape(wrapper, json.loads(s))
        paths, own = [x for x, _ in W.slots(wrapper)], [x for x, _ in W.slots(json.loads(s))]
        assert [paths[k] for k in at if k >= 0] == [own[i] for i, k in enumerate(at) if k >= 0]


def test_mismatches_become_optional_repeated_and_grouped():
    page = lambda s: json.dumps(W.blank(W.parse(s)[0]))
    got = json.loads(W.wrapper_of([page("<h1>a</h1><p>b</p>"), page("<h1>a</h1><h2>x</h2><p>b</p><p>c</p>"),
                                   page("<h1>a</h1><dl><dt>1<dd>2<dt>3<dd>4</dl><p>b</p>")]))
    assert [(W.name_of(x), x[1]) for x in got] == [("h1", "1"), ("dl", "?"), ("h2", "?"), ("p", "+")]
    assert [(W.name_of(x), x[1]) for x in got[1][2]] == [("(dt dd)", "+")]


@pytest.mark.parametrize("page, texts", [
    ("<p>a<p>b</p>c", ["a", "b", "c"]), ("<ul><li>a<li>b<ul><li>c</ul>d</ul>", ["a", "b", "c", "d"]),
    ("a<br>b  <b>c</b>d &amp;&nbsp;e &#x41;&notareference;", ["a b cd & e A¬areference;"]),
    ("<table><tr><td>a<td>b<tr><th>c</table>d", ["a", "b", "c", "d"]), ("x < y <3 &lt;p&gt;", ["x < y <3 <p>"]),
    ("<script>var t='</p>';</script><p>a</p><style>p{}</style><!-- <p>no</p> -->b<![CDATA[c]]>", ["a", "b"]),
    ("<script>a</scripty></script>b", ["b"]), ("<p title='a>b' class=x>c", ["c"]), ("<p title=\"a>b", ["b"]), ("a<p", ["a"]),
    ("<div><p>a</div>b</p>", ["a", "b"]), ("<b><p>a</b>b</p>", ["ab"]), ("<!-- open <p>a", []), ("<script>open", []),
    ("<select><option>a<option>b</select>", ["a", "b"]), ("</p></div>a", ["a"]), ("", []), ("<P>A</P><Br/>B", ["A", "B"]),
])
def test_parse(page, texts):
    assert W.parse(page)[1] == texts


def test_deep_and_long_pages():
    items, texts, _ = W.parse("<div>" * 5000 + "a<p>b" + "</div>" * 5000 + "c")
    assert texts == ["a", "b", "c"] and len(json.dumps(items)) < 10_000
    items, texts, _ = W.parse("<p>word</p>" * 20_000 + '<a href="x' * 2000)
    assert len(texts) >= 20_000
    W.wrapper_of([json.dumps(W.blank(items)), json.dumps(W.blank(W.parse("<p>a</p><h2>b</h2>")[0]))])


ARTICLE = """<html><head><title>{t}</title><style>p{{}}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a href=/>Home</a>
<li><a href=/b>B</a></ul></nav>{notice}<main><article><header><h1>{t}</h1></header>{body}<div class="share-buttons">Share</div>
<section class="comments"><h2>Comments</h2><p>{c}</p></section></article></main><aside><p>{c}</p></aside>
<form><label>Mail</label><input><button>Go</button></form><script>x("</p>")</script><footer>&copy; {c}</footer></body></html>"""
DIVS = """<html><body><div class="top">Old site</div><table><tr><td><a href=1>One</a> <a href=2>Two</a></td>
<td><div><h2>{t}</h2>{body}</div></td></tr></table><div>Imprint</div></body></html>"""


def made_pages(seed=4):
    r = random.Random(seed)
    word = lambda: r.choice(["tree", "rock", "über", "1 < 2", "&", "sea"]) + str(r.randrange(999))
    pages, expected = [], {}
    for i in range(60):
        template, host = (ARTICLE, "A.example.com") if i % 3 else (DIVS, "b.example.com")
        title, blocks = " ".join(word() for _ in range(4)), [" ".join(word() for _ in range(r.randrange(5, 60))) for _ in range(r.randrange(1, 7))]
        body = "".join(f"<p>{html.escape(b)}</p>" if r.random() < 0.8 else f"<ul><li>{html.escape(b)}</ul>" for b in blocks)
        notice = '<div class="cookie-notice">We use cookies</div>' if r.random() < 0.5 else ""
        page = template.format(t=html.escape(title), body=body, c=word().replace("<", ""), notice=notice)
        pages.append((i, f"https://{host}/{i}?x", page))
        expected[i] = "\n\n".join([title, *blocks])
    return pages, expected


def test_made_templates(spark):
    pages, expected = made_pages()
    got = W.main_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert {r["page_id"]: r["text"] for r in got.collect()} == expected


def test_rounds_of_few_shapes_and_joins_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(W, "FAN", 3)
    monkeypatch.setattr(W, "BROADCAST_BYTES", 0)
    pages, expected = made_pages(9)
    got = W.main_text(spark.createDataFrame(pages, "page_id long, url string, html string"))
    assert {r["page_id"]: r["text"] for r in got.collect()} == expected


def test_edges(spark):
    page = "<article><p>a</p>  <p>b\n c</p></article><footer>f</footer>"
    rows = [(1, "http://h/x", page), (1, "http://h/x", page), (None, "http://h/y", page), (2, None, page), (3, "no host", None),
            (4, "http://h/z", ""), (5, "http://h/q", "plain"), (6, "http://H", "<article>" + "long " * 50_000 + "</article>"), (7, "u://", "<p>\U0001F600")]
    df = spark.createDataFrame([(*r, 1, "s", [True]) for r in rows], "page_id long, url string, html string, slot int, host string, main array<boolean>")
    got = sorted(((r.page_id, r.url, r.text) for r in W.main_text(df).collect()), key=str)
    text = {1: "a\n\nb c", None: "a\n\nb c", 2: "a\n\nb c", 3: "", 4: "", 5: "plain", 6: ("long " * 50_000).strip(), 7: "\U0001F600"}
    expected = sorted(((i, u, text[i]) for i, u, _ in rows), key=str)
    assert got == expected
    assert W.main_text(df.where("false")).count() == 0


def test_query_on_given_pages(spark):
    """The given template: heading and paragraphs of the article, by a plain split."""
    got = {r.page_id: r for r in queries.QUERIES["op12_wrapper_text"](spark, SF_SMALL).collect()}
    pages = spark.read.parquet(f"{SF_SMALL}/pages.parquet").collect()
    assert len(got) == len(pages) > 0
    for p in pages:
        inner = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", p.html, re.S)[1]
        inner = re.sub(r"</?b>", "", inner).replace("<br>", " ")
        blocks = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner))
        text = "\n\n".join(b for b in blocks if b)
        assert (got[p.page_id].url, got[p.page_id].text, got[p.page_id].n_chars) == (p.url, text, len(text))
