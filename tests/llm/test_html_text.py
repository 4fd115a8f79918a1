import html
import re
import time

import pytest
from webloom.llm import html_text
from webloom.llm.html_text import Page, extract, vote

from .helpers import CLASHES, load

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body>
<header><h1>Site name</h1></header><nav><a href=/>Home</a></nav><div class="cookie-notice">We use cookies</div>
<div id=main class="content c7"><article><h1>Title &amp; more</h1><!-- note -->
<p>Hello   <b>world</b> &#8217;s<br>line&nbsp;two <p title="a>b">Second a<b>b</b>c <a href="x">link</a>.
<div class="ad">Buy this</div><ul><li>one<li>two</ul><form><p>Subscribe</form><aside>Side</aside></article>
<section class="comments"><p>A reader's opinion that is quite long, long enough to look like text.</p></section></div>
<footer>&copy; foot</footer></body></html>"""
TEXT = "Title & more\n\nHello world ’s line two\n\nSecond abc link.\n\none\n\ntwo"


def pages(spark, rows):
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.selectExpr("*", *[f"'x' as `{c}`" for c in [*CLASHES, "host", "path", "paths", "votes", "text", "n_chars"]])


def test_article_only():
    page = Page(PAGE)
    assert page.text([]) == TEXT
    assert page.best()[0][0] == "/html/body/div.c.content/article"


@pytest.mark.parametrize("source, text", [
    ("", ""), ("plain  text", "plain text"), ("<p>a<p>b", "a\n\nb"), ("<div><p>x", "x"), ("a < b &lt; c", "a < b < c"),
    ("<script>x", ""), ("<!-- x", ""), ('<article class="comment">x</article><p>y</p>', "y"), ("<p>a</p", "a</p"),
    ("<table><tr><td>A<td>B</table>", "A\n\nB"), ("<div hidden>x</div><div>y</div>", "y"), ("&#x41;&Eacute;&unknown;", "AÉ&unknown;"),
])
def test_fragments(source, text):
    assert Page(source).text([]) == text


@pytest.mark.parametrize("limit", [32 << 20, 0])
def test_host_votes_decide(spark, monkeypatch, limit):
    monkeypatch.setattr(html_text, "BROADCAST_BYTES", limit)
    usual = "<body><div class=story><p>{}</p></div><div class=extra><p>short</p></div></body>"
    odd = "<body><div class=story><p>brief</p></div><div class=extra><p>{}</p></div></body>"
    rows = [(i, f"http://www.h.com/{i}", usual.format("long text " * 20)) for i in range(9)] + [(10, "https://h.com:80/x", odd.format("longer text " * 20))]
    assert [(r.host, r.paths[0]) for r in vote(pages(spark, rows)).collect()] == [("h.com", "/body/div.story")]
    got = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}
    assert got[10] == ("longer text " * 20).strip() and got[0] == ("long text " * 20).strip()


def test_two_templates_on_one_host(spark):
    long, other = "long text " * 20, "other text " * 20
    first = f"<html><body><main><article><p>{long}</p></article></main><div class=box><p>box</p></div></body></html>"
    second = f"<html><body><div class=story><p>{other}</p></div><div class=box><p>box</p></div><main><article><p>tiny</p></article></main></body></html>"
    third = f"<html><body><div class=story><p>{other}</p></div><div class=box><p>box</p></div></body></html>"
    rows = [(i, f"http://h/{i}", first) for i in range(12)] + [(20 + i, f"http://h/{i}", (second, third)[i % 2]) for i in range(4)]
    got = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}
    assert set(got[i] for i in range(12)) == {long.strip()}
    assert {got[i] for i in range(20, 24)} == {other.strip()}


def test_many_templates_on_one_host(spark):
    rows = [
        (10 * k + i, f"http://h/{k}/{i}", f"<body><div class=box><p>box box</p></div><div class=kind-{'abcdefgh'[k]}><p>{f'text {k} ' * 30}</p></div><div>foot</div></body>")
        for k in range(8) for i in range(9 - k)
    ]
    got = {r.page_id: r.text for r in extract(pages(spark, rows)).collect()}
    assert got == {i: f"text {i // 10} " * 29 + f"text {i // 10}" for i, *_ in rows}


@pytest.mark.parametrize("name, kept", [
    *[(n, True) for n in ("content has-sidebar", "no-comments", "with-banner", "related-to-x", "article-tags", "share-price-report", "sidebar", "byline")],
    *[(n, False) for n in ("comments", "comment-list", "disqus")],
])
def test_names_of_containers(name, kept):
    text = Page(f'<body><p>little</p><div class="{name}"><p>{"the article itself " * 30}</p></div></body>').text([])
    assert ("the article itself" in text) == kept


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "sidebar-left", "cookie-banner", "newsletter-signup", "related-posts", "share-buttons", "ad", "ad-slot-2", "user-comments"])
def test_names_of_what_is_no_article(name):
    source = f'<body><div class=story><p>{"the article itself " * 30}</p><div class="{name}"><p>not the article</p></div></div></body>'
    assert Page(source).text([]) == ("the article itself " * 30).strip()


@pytest.mark.parametrize("unit", ['<a "', "<a '", '<a b="', "<a b=\"' ", "<", "<p x='>", '"<a>'])
@pytest.mark.parametrize("end", ["", ">", '">', "'"])
def test_broken_tags_take_linear_time(unit, end):
    began = time.perf_counter()
    Page("<p>text</p>" + unit * (400_000 // len(unit)) + end).text([])
    assert time.perf_counter() - began < 5


PART = "<p>" + "words of a part " * 20 + "</p>"


@pytest.mark.parametrize("source", [
    f"<body><article><h1>Title</h1><p>lead</p><section>{PART}</section><section>{PART}</section></article><div>box</div></body>",
    f"<body><article><h1>Title</h1><p>lead</p><table><tr><td>{PART}</td><td>{PART}</td></tr></table></article><div>box</div></body>",
    f"<body><div class=page><h1>Title</h1><p>lead</p><div class=part>{PART}</div><div class=part>{PART}</div></div><div>box</div></body>",
])
def test_titles_and_leads_stay_with_divided_articles(source):
    page = Page(source)
    for paths in ([], [page.best()[0][0]]):
        assert page.text(paths).split("\n\n") == ["Title", "lead", *["words of a part " * 19 + "words of a part"] * 2]


def test_edges(spark):
    rows = [(1, None, None), (2, "nonsense", ""), (None, "http://a.b/", PAGE), (4, "http://a.b/", PAGE), (4, "http://a.b/", PAGE), (5, "http://c/", "<p>" + "wörd " * 100_000)]
    got = extract(pages(spark, rows)).collect()
    assert sorted((r.page_id or 0, r.n_chars) for r in got) == [(0, len(TEXT)), (1, 0), (2, 0), (4, len(TEXT)), (4, len(TEXT)), (5, 499_999)]
    assert extract(pages(spark, [])).count() == 0


def test_pages_of_the_tables(spark):
    df = load(spark, "pages")
    source = {r.page_id: r.html for r in df.collect()}
    for r in extract(df).collect():
        body = re.search(r"<article>(.*)</article>", source[r.page_id], re.S)[1]
        blocks = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", b.replace("<br>", " ")))).strip() for b in re.split(r"</?(?:p|h1)>", body)]
        assert r.text == "\n\n".join(b for b in blocks if b)
