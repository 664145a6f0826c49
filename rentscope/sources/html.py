"""Listing records from fetched web pages (a ``pages(page_id, url, html)``
table).

A *layout* names the record blocks of a page and, inside a block, where
each field lives.  Block selectors are alternatives per page: the first
selector that finds at least one block on that page wins (the reference
takes ``li.cl-static-search-result`` and falls back to ``div.result-info``
only on pages with none).  Inside a block each field takes the first
element matching its first selector that is present at all; the text is
every text node stripped and concatenated (``get_text(strip=True)``); a
missing field is null and the record is kept.  ``link`` is the ``href`` of
the first ``<a>`` carrying one.

Nesting needs a stack, which built-in functions cannot express in linear
time, so a tokenizer of our own walks every page once inside ``mapInArrow``
(map-only, no shuffle).  It only moves forward: whatever a tag, comment or
quoted value runs into is consumed with it, and one that never ends takes the
rest of the page, as the HTML standard has it (an unclosed tag is dropped, an
unclosed comment says nothing).  So no place is looked at again and a page
costs time in proportion to its length, whatever is broken in it.  Text parts
of a page are kept in one list and an element is a range of it, so nested and
unclosed elements cost nothing extra, unless fields nest in each other and the
texts asked for do as well.  Comments, scripts and styles carry no text;
``title`` and ``textarea`` hold text alone; end tags that HTML leaves out
(``li``, ``p``, ``td`` ...) are implied; all named and numeric references are
decoded in one pass, in attributes by the attributes' rule (``&copy=`` stays).
Only pages that hold a block's class name at all (a JVM-side test) are handed
to Python.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass, field
from html import unescape
from html.entities import html5

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rentscope.functions.text import parse_price

# Elements without content, and elements whose end tag is
# implied when one of the named elements opens (up to an enclosing barrier).
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select"}),
    "td": ({"td", "th"}, {"table"}), "th": ({"td", "th"}, {"table"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "p": ({"p"}, {"div", "li", "td", "section", "article"}),
}
SILENT = frozenset(("script", "style"))
# elements whose content holds no tags: everything up to their own end tag
RAW_END = {t: re.compile(rf"</{t}(?=[\t\n\r\f />])", re.I) for t in (*SILENT, "title", "textarea")}

_TAG_NAME = re.compile(r"[A-Za-z][^\t\n\r\f />]*+")
_BETWEEN = re.compile(r"[\t\n\r\f /]*+")
_ATTRIBUTE = re.compile(r"=?[^\t\n\r\f />=]*+")
_EQUALS = re.compile(r"[\t\n\r\f ]*+=[\t\n\r\f ]*+")
_BARE_VALUE = re.compile(r"[^\t\n\r\f >]*+")
_COMMENT_END = re.compile(r"--!?>")
_LONG_NUMBER = re.compile(r"&#0*+([0-9]{8,}+);?+")
_ZEROS = re.compile(r"&#0++(?=[0-9])")
_ATTRIBUTE_NAME = re.compile(r"&([A-Za-z][A-Za-z0-9]*+)(;?+)(?!=)")


@dataclass(frozen=True)
class Sel:
    """``tag`` with (optionally) ``cls`` among its classes."""
    tag: str
    cls: str | None = None


@dataclass(frozen=True)
class PageLayout:
    blocks: tuple[Sel, ...]
    title: tuple[Sel, ...] = field(default_factory=tuple)
    price: tuple[Sel, ...] = field(default_factory=tuple)
    location: tuple[Sel, ...] = field(default_factory=tuple)

    def selectors(self) -> tuple[Sel, ...]:
        return tuple(dict.fromkeys((*self.blocks, *self.title, *self.price, *self.location)))


# The listing-site layout (primary, then fallback).
LISTING_LAYOUT = PageLayout(
    blocks=(Sel("li", "cl-static-search-result"), Sel("div", "result-info")),
    title=(Sel("div", "title"), Sel("a", "titlestring")),
    price=(Sel("div", "price"), Sel("span", "priceinfo")),
    location=(Sel("div", "location"), Sel("span", "meta")),
)
# A plain link list: every <li> is a record titled by its first <a>.
LINK_LIST_LAYOUT = PageLayout(blocks=(Sel("li"),), title=(Sel("a"),))


class _Element:
    """Place of an element in document order, and its range of text parts."""
    __slots__ = ("opened", "closed", "first", "last")

    def __init__(self, opened: int, first: int):
        self.opened, self.first, self.closed, self.last = opened, first, None, None


def _decoded(text: str) -> str:
    """All references decoded; a number too large for any character is U+FFFD."""
    if "&" not in text:
        return text
    if "&#" in text:
        text = _ZEROS.sub("&#", _LONG_NUMBER.sub("\ufffd", text))
    return unescape(text)


def _decoded_value(text: str) -> str:
    """An attribute's value: numbers, whole names with ``;``, and old names
    without it unless a letter, digit or ``=`` follows."""
    if "&" not in text:
        return text

    def named(m: re.Match) -> str:
        return html5.get(m[1] + m[2], m[0])
    if "&#" not in text:
        return _ATTRIBUTE_NAME.sub(named, text)
    parts = re.split("(&#[0-9]++;?+|&#[xX][0-9A-Fa-f]++;?+)", text)
    return "".join(_decoded(x) if i % 2 else _ATTRIBUTE_NAME.sub(named, x) for i, x in enumerate(parts))


class _Page:
    """One walk over a page: elements per selector, links, text parts."""

    def __init__(self, selectors: tuple[Sel, ...]):
        self.by_tag: dict[str, list[Sel]] = {}
        for s in selectors:
            self.by_tag.setdefault(s.tag, []).append(s)
        self.found: dict[Sel, list[_Element]] = {s: [] for s in selectors}
        self.links: list[tuple[int, str]] = []
        self.parts: list[str] = []
        self.node: list[str] = []
        self.stack: list[tuple[str, _Element]] = []
        self.open: dict[str, list[int]] = {}  # places on the stack, per tag
        self.clock = 0

    def _end_node(self) -> None:
        if self.node:
            text = _decoded("".join(self.node)).strip()
            if text:
                self.parts.append(text)
            self.node = []

    def _pop(self) -> str:
        tag, element = self.stack.pop()
        self.open[tag].pop()
        self.clock += 1
        element.closed, element.last = self.clock, len(self.parts)
        return tag

    def _deepest(self, tags) -> int:
        return max((self.open[t][-1] for t in tags if self.open.get(t)), default=-1)

    def _started(self, tag: str, values: dict[str, str]) -> None:
        self._end_node()
        ends, barrier = IMPLIED_END.get(tag, ((), ()))
        at = self._deepest(ends)
        if at > self._deepest(barrier):
            while len(self.stack) > at:
                self._pop()
        self.clock += 1
        element = _Element(self.clock, len(self.parts))
        for s in self.by_tag.get(tag, ()):
            if s.cls is None or s.cls in values.get("class", "").split():
                self.found[s].append(element)
        if tag == "a" and "href" in values:
            self.links.append((self.clock, values["href"]))
        if tag in VOID:
            element.closed = element.opened
            element.last = element.first
        else:
            self.open.setdefault(tag, []).append(len(self.stack))
            self.stack.append((tag, element))

    def _ended(self, tag: str) -> None:
        self._end_node()
        if self.open.get(tag):
            while self._pop() != tag:
                pass

    def _attributes(self, html: str, at: int) -> tuple[dict[str, str], int]:
        """A tag's attributes (of a repeated one the first) from after its name,
        and the place after its ``>``; -1 where the page ends within the tag."""
        values: dict[str, str] = {}
        size = len(html)
        while True:
            at = _BETWEEN.match(html, at).end()
            if at == size:
                return values, -1
            if html[at] == ">":
                return values, at + 1
            name = _ATTRIBUTE.match(html, at)
            at, value = name.end(), ""
            equals = _EQUALS.match(html, at)
            if equals:
                at = equals.end()
                quote = html[at:at + 1]
                if quote in ("'", '"'):
                    end = html.find(quote, at + 1)
                    if end < 0:
                        return values, -1
                    value, at = html[at + 1:end], end + 1
                else:
                    bare = _BARE_VALUE.match(html, at)
                    value, at = bare[0], bare.end()
            values.setdefault(name[0].lower(), value)

    def walk(self, html: str) -> "_Page":
        at, size = 0, len(html)
        while 0 <= at < size:
            at = self._text(html, at) if html[at] != "<" else self._markup(html, at)
        self._end_node()
        while self.stack:
            self._pop()
        return self

    def _text(self, html: str, at: int) -> int:
        end = html.find("<", at)
        end = len(html) if end < 0 else end
        self.node.append(html[at:end])
        return end

    def _markup(self, html: str, at: int) -> int:
        """Consumes what begins with the ``<`` at ``at``; the place after it, -1
        at the end of the page."""
        tag = _TAG_NAME.match(html, at + 1)
        if tag:
            name = tag[0].lower()
            values, end = self._attributes(html, tag.end())
            if end < 0:
                self._end_node()
                return -1
            self._started(name, {k: _decoded_value(v) for k, v in values.items() if k in ("class", "href")})
            return self._raw(html, end, name) if name in RAW_END else end
        following = html[at + 1:at + 2]
        if following == "/":
            tag = _TAG_NAME.match(html, at + 2)
            if tag:
                _, end = self._attributes(html, tag.end())
                self._ended(tag[0].lower()) if end >= 0 else self._end_node()
                return end
            if at + 2 == len(html):
                self.node.append("</")
                return -1
        elif following not in ("!", "?") or not following:
            self.node.append("<")
            return at + 1
        self._end_node()
        if html.startswith("<!--", at):
            if html.startswith((">", "->"), at + 4):
                return html.index(">", at + 4) + 1
            close = _COMMENT_END.search(html, at + 4)
            return close.end() if close else -1
        return html.find(">", at + 2) + 1 or -1

    def _raw(self, html: str, at: int, name: str) -> int:
        close = RAW_END[name].search(html, at)
        end = close.start() if close else len(html)
        if name not in SILENT:
            self.node.append(html[at:end])
        return end

    def text(self, selectors: tuple[Sel, ...], block: _Element) -> str | None:
        for s in selectors:
            elements = self.found[s]
            k = bisect_left(elements, block.opened + 1, key=lambda e: e.opened)
            if k < len(elements) and elements[k].opened < block.closed:
                return "".join(self.parts[elements[k].first:elements[k].last])
        return None

    def link(self, block: _Element) -> str | None:
        k = bisect_left(self.links, (block.opened + 1,))
        return self.links[k][1] if k < len(self.links) and self.links[k][0] < block.closed else None


def page_records(html: str, layout: PageLayout) -> list[tuple]:
    """``(pos, title, price_raw, location, link)`` of every record of a page."""
    page = _Page(layout.selectors()).walk(html)
    blocks = next((page.found[s] for s in layout.blocks if page.found[s]), [])
    return [(pos, page.text(layout.title, b), page.text(layout.price, b), page.text(layout.location, b), page.link(b))
            for pos, b in enumerate(blocks)]


def extract_page_records(pages: DataFrame, layout: PageLayout = LISTING_LAYOUT) -> DataFrame:
    """``pages(page_id, url, html)`` -> one row per record:
    ``(page_id, pos, title, price, price_raw, location, link)``."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                rows = page_records(batch.column("html")[i].as_py(), layout)
                if rows:
                    pos, *texts = zip(*rows)
                    yield pa.record_batch([pa.array([batch.column("page_id")[i].as_py()] * len(rows), pa.int64()),
                                           pa.array(pos, pa.int32()), *(pa.array(c, pa.string()) for c in texts)],
                                          ["page_id", "pos", "title", "price_raw", "location", "link"])
    may_match = F.lit(False)
    for s in layout.blocks:
        may_match = may_match | (F.contains("html", F.lit(s.cls)) if s.cls else F.lower("html").contains(f"<{s.tag}"))
    fields = (pages.select(F.col("page_id").cast("bigint"), "html").filter(may_match)
              .mapInArrow(run, "page_id bigint, pos int, title string, price_raw string, location string, link string"))
    return fields.select("page_id", "pos", "title", parse_price("price_raw").alias("price"),
                         "price_raw", "location", "link")
