"""Feeds and pages as a parser with a tree reads them."""

import xml.etree.ElementTree as ET
from email.utils import parsedate_to_datetime

import pytest

from chroniq.functions import html
from chroniq.schemas import FEEDS
from chroniq.sources import feeds

DATE = "<pubDate>Mon, 01 Jan 2024 10:00:00 +0000</pubDate>"
LATER = "<pubDate>Tue, 02 Jan 2024 10:00:00 +0000</pubDate>"


def rss(*items):
    return "<rss><channel>" + "".join(f"<item>{i}</item>" for i in items) + "</channel></rss>"


ONE = f"<title>a</title><link>l</link>{DATE}"
BODIES = [
    rss(f"<title>a</title><title>b</title><link>l</link>{DATE}"),
    rss(f"<title>a</title><link>l1</link><link>l2</link>{DATE}{LATER}"),
    rss(f"<title>one <b>two</b> three</title><link>l</link>{DATE}"),
    rss(f"<title><b>two</b> three</title><link>l<x/>m</link>{DATE}"),
    rss(f"<title/><title>x</title><link>l</link>{DATE}"),
    rss(f"<title>a &lt; b</title><link>l?a=1&amp;b=2</link>{DATE}"),
    rss(f"<title>a<!-- c -->b<?p q?>c</title><link>l</link>{DATE}"),
    rss(f"<title><![CDATA[x <b> y ]] ]]></title><link>l</link>{DATE}"),
    rss(f"<title><![CDATA[x <Item>]]> and <i>more</i></title><link>l</link>{DATE}"),
    rss(f"<title>p <title>q</title> r</title><link>l</link>{DATE}"),
    rss(f"<title>a</title><link></link><link>z</link>{DATE}", f"<title>k</title><link>m</link>{DATE}"),
    rss(f"<title>a</title><link>l</link>{DATE}<author><title>no</title></author>"),
    rss(f"<author><title>no</title></author><title>a</title><link>l</link>{DATE}"),
    rss(ONE) + "<x/>",
    rss(ONE) + rss(),
    rss(ONE) + "<!-- </rss> -->\n<?end?> ",
    rss(ONE) + " junk",
    f"<rss><channel><ITEM>{ONE}</ITEM><item><Title>t</Title><title>u</title><link>v</link>{DATE}</item></channel></rss>",
    f"<rss><Channel><item>{ONE}</item></Channel></rss>",
    f"<?xml version='1.0'?><!DOCTYPE rss [<!ENTITY e 'x'>]><rss version='2.0'><channel><item>{ONE}</item></channel></rss>",
    f"<feed xmlns='http://x'><channel><item>{ONE}</item></channel></feed>",
    f"<rss xmlns:a='u'><channel><a:link>no</a:link><item><a:title>z</a:title><title>a</title><a:link>q</a:link><link>l</link>{DATE}</item></channel></rss>",
    f"<a><b><channel><item>{ONE}</item></channel></b></a>",
    f"<channel><item>{ONE}</item></channel>",
    f"<rss><channel><wrap><item>{ONE}</item></wrap></channel></rss>",
    f"<rss><channel><item><title>a <b>x</i></title><link>l</link>{DATE}</item></channel></rss>",
    "<rss/>",
    "<rss></rss>",
    "",
    "x",
]


def by_tree(text):
    try:
        root = ET.fromstring(text)
    except ET.ParseError:
        return "rss_parse_error"
    channel = root.find("channel")
    channel = root.find(".//channel") if channel is None else channel
    if channel is None:
        return "rss_no_channel"
    items = [(n, i.findtext("pubDate"), i.findtext("link"), (i.findtext("title") or "").strip()) for n, i in enumerate(channel.findall("item"))]
    if not items:
        return "rss_no_items"

    def when(text):
        return int(parsedate_to_datetime(text).timestamp()) if text else None

    if when(items[0][1]) is None:
        return "rss_bad_first_date"
    return [(n, when(d), link, title) for n, d, link, title in items if when(d) and link]


def test_feeds_are_read_as_a_tree(spark):
    frame = spark.createDataFrame([(str(n), 200, b) for n, b in enumerate(BODIES)], FEEDS)
    got = {int(r.lang): r.error_context or [tuple(i) for i in r["items"]] for r in feeds.parse_feeds(frame).collect()}
    assert got == dict(enumerate(map(by_tree, BODIES)))


@pytest.fixture
def article(ev):
    return lambda *pages: ev(lambda h: html.container_text(h, "div", "article_content"), *pages)


def test_containers_end_with_what_is_around_them(article):
    start = '<div class="x article_content">'
    cases = {
        f"<section>{start}a<div>b</section><p>after</p>": "ab",  # closed by its parent
        f"<section>{start}a<div>b</section><p>after</p></div></div>": "ab",  # end tags come too late
        f"<ul><li>{start}a<li>b</ul>c": "ab",
        f"{start}a<br>b<img src=x>c<hr/>d</div>e": "abcd",  # void elements
        f"{start}<p>a<p>b</div>c": "ab",  # unclosed elements
        f"{start}a</i></span>b</div>c": "ab",  # end tags of nothing
        f"<body>{start}a<div>b</div>c</body>d": "abc",
        f"<body>{start}never closed <b>at all": "never closed at all",
        f"<table><tr><td>{start}a<td>b</table>c": "ab",
        f"<section>{start}a<script>'</section>'</script>b</div></section>c": "a'</section>'b",
        f"<section>{start}a<!-- </section> -->b</div></section>c": "ab",
        f"<div><section>{start}<DIV>a</DIV>b</SECTION>c</div>": "ab",
        f"<section><p>x</section>{start}a</div>b": "a",
        "<section><div>a</section>": None,
    }
    assert article(*cases) == list(cases.values())


def test_an_article_element_is_closed_by_the_page(ev):
    pages = ["<main><article>a<p>b</main>c", "<p class=k>a<div>b</div>", "<li class=k>a<li>b"]
    assert ev(lambda h: html.container_text(h, "article"), pages[0]) == ["ab"]
    assert ev(lambda h: html.container_text(h, "p", "k"), pages[1]) == ["a"]
    assert ev(lambda h: html.container_text(h, "li", "k"), pages[2]) == ["a"]


def test_references_without_a_semicolon(ev):
    cases = {
        "&copy 2020": "© 2020",
        "&notit;": "¬it;",
        "&notin;": "∉",
        "&ampamp;": "&amp;",
        "&lt&gt": "<>",
        "&AMP &QUOT": '& "',
        "&Eacutes &nothing &unknown": "És ¬hing &unknown",
        "a & b &; &#65 &#x42;": "a & b &; A B",
    }
    assert ev(html.decode_entities, *cases) == list(cases.values())
    address = {"/x?a=1&copy=2&lt=3": "/x?a=1&copy=2&lt=3", "/x?a&amp;b": "/x?a&b", "/x?a&amp b": "/x?a& b", "&copyx": "&copyx"}
    assert ev(lambda v: html.decode_entities(v, attribute=True), *address) == list(address.values())
