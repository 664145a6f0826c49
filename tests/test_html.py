"""Page record extraction: one hand-made page per layout case."""

import time

import pytest

from rentscope.sources.html import LINK_LIST_LAYOUT, LISTING_LAYOUT, extract_page_records, page_records

PRIMARY = ('<li class="cl-static-search-result"><a href="/a"><div class="title"> 2 bed </div>'
           '<div class="price">$1,500</div><div class="location">Dallas, TX</div></a></li>')
FALLBACK = ('<div class="result-info"><a class="titlestring" href="/b">Loft &amp; more</a>'
            '<span class="priceinfo">$900</span><span class="meta"> Plano </span></div>')


def run(spark, pages, layout=None):
    df = spark.createDataFrame(pages, "page_id bigint, url string, html string")
    out = extract_page_records(df) if layout is None else extract_page_records(df, layout)
    return [r.asDict() for r in out.orderBy("page_id", "pos").collect()]


def test_primary_layout(spark):
    rows = run(spark, [(1, "u", f"<ul>{PRIMARY}{PRIMARY}</ul>")])
    assert len(rows) == 2
    assert rows[0] | {} == {"page_id": 1, "pos": 0, "title": "2 bed", "price": 1500,
                            "price_raw": "$1,500", "location": "Dallas, TX", "link": "/a"}


def test_fallback_layout(spark):
    rows = run(spark, [(1, "u", FALLBACK)])
    assert rows == [{"page_id": 1, "pos": 0, "title": "Loft & more", "price": 900,
                     "price_raw": "$900", "location": "Plano", "link": "/b"}]


def test_fallback_only_when_primary_absent(spark):
    rows = run(spark, [(1, "u", PRIMARY * 2 + FALLBACK * 3), (2, "u", FALLBACK * 3)])
    assert [r["page_id"] for r in rows] == [1, 1, 2, 2, 2]


def test_missing_fields_kept(spark):
    rows = run(spark, [(1, "u", '<li class="cl-static-search-result"><div class="title">T</div></li>')])
    assert rows == [{"page_id": 1, "pos": 0, "title": "T", "price": None, "price_raw": None,
                     "location": None, "link": None}]


def test_empty_page(spark):
    assert run(spark, [(1, "u", "<html><body><p>none</p></body></html>")]) == []


def test_text_nodes_stripped_and_joined(spark):
    html = '<li class="cl-static-search-result"><div class="title"> a <b> b </b><!-- c --> </div></li>'
    assert run(spark, [(1, "u", html)])[0]["title"] == "ab"


def test_link_list_layout(spark):
    rows = run(spark, [(1, "u", "<ul><li><a href='/x?a=1&amp;b=2'>X</a></li><li>no link</li></ul>")],
               LINK_LIST_LAYOUT)
    assert [(r["title"], r["link"]) for r in rows] == [("X", "/x?a=1&b=2"), (None, None)]


def test_character_references(spark):
    html = ('<li class="cl-static-search-result"><div class="title">Caf&#233; &#x2019;n&#39; '
            '&copy; &amp;lt; &middot;</div></li>')
    assert run(spark, [(1, "u", html)])[0]["title"] == "Café ’n' © &lt; ·"


def title_of(spark, fragments):
    rows = run(spark, [(i, "u", f'<li class="cl-static-search-result"><div class="title">{f}</div></li>')
                       for i, f in enumerate(fragments)])
    return [r["title"] for r in rows]


def test_invalid_and_named_references(spark):
    got = title_of(spark, ["a&#xD800;b", "a&#x110000;b", "a&#0;b", "ok &#65;&#x42;", "&eacute;&bull;&frac12;",
                           "&#0000000065;", "a &#38;lt; b"])
    assert got == ["a\ufffdb", "a\ufffdb", "a\ufffdb", "ok AB", "\u00e9\u2022\u00bd", "A", "a &lt; b"]


def test_nested_blocks_with_the_same_tag(spark):
    html = ('<div class="result-info"><div class="title">T</div><div class="price">$900</div>'
            '<div><div class="location">Plano</div></div><a href="/x">more</a></div>')
    assert run(spark, [(1, "u", html)]) == [{"page_id": 1, "pos": 0, "title": "T", "price": 900, "price_raw": "$900",
                                             "location": "Plano", "link": "/x"}]
    html = ('<li class="cl-static-search-result"><ul><li>x<li>y</ul><div class="title">T</div></li>'
            '<div class="title">outside</div>')
    assert [r["title"] for r in run(spark, [(1, "u", html)])] == ["T"]


def test_implied_end_tags_comments_and_scripts(spark):
    one = '<li class="cl-static-search-result"><div class="title">T{}</div><a href="/{}">'
    html = ("<ul>" + one.format(1, 1) + "<!-- " + one.format(9, 9) + " -->" + "<script>" + one.format(8, 8) + "</script>"
            + one.format(2, 2) + one.format(3, 3) + "</ul>")
    assert [(r["title"], r["link"]) for r in run(spark, [(1, "u", html)])] == [("T1", "/1"), ("T2", "/2"), ("T3", "/3")]


def test_stray_tags_and_quoted_brackets(spark):
    html = ('</div></li><li class="x cl-static-search-result y" title="a > b"></span><div class=title>T <b>u</i></b>'
            "</div><a name=n>no</a><a HREF='/q?a=1&amp;b=2'>l</a>")
    assert [(r["title"], r["link"]) for r in run(spark, [(1, "u", html), (2, "u", None), (3, "u", "")])] == [("Tu", "/q?a=1&b=2")]


BROKEN = ['<div class="result-info">', "<!-- ", '<li class="cl-static-search-result"><ul>', '<a href="', "<a href='", "<p ",
          "<![CDATA[", "&#", "&#9", "<", "</", "</p", "<?", "<!", "<p/=", "<script>", "<title>", "<a b=\" c='"]


@pytest.mark.parametrize("piece", BROKEN)
def test_large_unclosed_page_is_linear(piece):
    began = time.time()
    page_records(piece * (5_000_000 // len(piece)), LISTING_LAYOUT)
    assert time.time() - began < 60


def test_implied_end_tags_do_not_scan_the_stack():
    began = time.time()
    page_records("<p><div>" + "<b>" * 200_000 + "<p></p>" * 200_000, LISTING_LAYOUT)
    assert time.time() - began < 60


def test_broken_constructs_end_where_the_standard_says(spark):
    block = '<li class="cl-static-search-result"><div class="title">T{}</div></li>'
    cases = {
        "unclosed comment": (block.format(1) + "<!-- " + block.format(2), ["T1"]),
        "comment ends": ("<!-->" + block.format(1) + "<!--->" + block.format(2) + "<!-- --!>" + block.format(3), ["T1", "T2", "T3"]),
        "unclosed value": (block.format(1) + '<a href="' + "<b>" + block.format(2).replace('"', ""), ["T1"]),
        "value ends later": ('<a href="' + block.format(1) + ">" + block.format(2), ["T2"]),
        "unclosed tag": (block.format(1) + "<p " + "x", ["T1"]),
        "tag swallows the next": ("<p " + block.format(1) + block.format(2), ["T2"]),
        "no tags": (block.format("<3 < 4 </ 5>6<"), ["T<3 < 46<"]),
        "declarations": ("<!doctype html><?xml v?><![CDATA[x]]>" + block.format(1), ["T1"]),
        "script": ("<script>" + block.format(1) + "</scripts></script >" + block.format(2), ["T2"]),
        "title": ("<title>" + block.format(1) + "</title>" + block.format(2), ["T2"]),
        "number": (block.format("&#" + "9" * 6000 + ";&#" + "0" * 6000 + "65;&#x" + "F" * 6000 + ";"), ["T\ufffdA\ufffd"]),
    }
    rows = run(spark, [(i, "u", html) for i, (html, _) in enumerate(cases.values())])
    for i, (name, (_, titles)) in enumerate(cases.items()):
        assert [r["title"] for r in rows if r["page_id"] == i] == titles, name


def test_references_in_attributes(spark):
    values = ["/q?a=1&amp;b=2", "/q?a&copy=1&copy;&copyx&copy", "&#65;&#x42;&#" + "9" * 6000, "&nosuch;&", "a&AMP;b&lt"]
    rows = run(spark, [(i, "u", f"<li><a href='{v}'>x</a></li>") for i, v in enumerate(values)], LINK_LIST_LAYOUT)
    assert [r["link"] for r in rows] == ["/q?a=1&b=2", "/q?a&copy=1\u00a9&copyx\u00a9", "AB\ufffd", "&nosuch;&", "a&b<"]


# --- text extraction vs the tokenizer alone on random fragments ---

from html.parser import HTMLParser  # noqa: E402

from hypothesis import given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402


class _Texts(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts = []

    def handle_data(self, data):
        self.parts.append(data)


def _stdlib_get_text(fragment):
    p = _Texts()
    p.feed(fragment)
    p.close()
    return "".join(t.strip() for t in p.parts if t.strip())


_PIECES = st.sampled_from(["a", "Bc", " ", "  ", "\t", "\n", "x y", "&amp;", "&lt;", "&gt;", "&quot;",
                           "&nbsp;", "&#233;", "&#x2019;", "&copy;", "<b>", "</b>", "<br>", "<br/>",
                           "<span class=\"k\">", "</span>", "<!-- note -->", "1", "é"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(_PIECES, max_size=12).map("".join), min_size=1, max_size=40))
def test_text_matches_stdlib_parser(spark, fragments):
    assert title_of(spark, fragments) == [_stdlib_get_text(f) for f in fragments]
