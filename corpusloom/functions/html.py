"""One parse per page: an Arrow UDF that returns everything later steps read.

Only what needs the element tree happens here. Cleaning, hashing, maps,
language rules and link filters are Spark expressions on the result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from html import unescape
from html.entities import html5
from html.parser import HTMLParser
from itertools import accumulate
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as boilerplate, content and text.
BOILERPLATE_TAGS = frozenset(
    ("script", "style", "nav", "header", "footer", "aside", "form", "button", "input",
     "select", "textarea")
)
BOILERPLATE_CLASSES = (
    "nav", "navigation", "menu", "sidebar", "footer", "header", "ad", "advertisement",
    "popup", "modal",
)
CONTENT_CLASSES = ("content", "main", "article", "post", "body", "text")
TEXT_TAGS = frozenset(("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote"))
SKIPPED_SCHEMES = ("javascript:", "mailto:", "tel:", "#")

VOID_TAGS = frozenset(
    ("area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param",
     "source", "track", "wbr")
)
OPAQUE_TAGS = frozenset(("script", "style", "template"))

PAGE_TYPE = pa.struct(
    [
        ("title", pa.string()),
        ("main_text", pa.string()),
        ("html_lang", pa.string()),
        ("canonical_url", pa.string()),
        (
            "metas",
            pa.list_(
                pa.struct(
                    [
                        ("name", pa.string()),
                        ("property", pa.string()),
                        ("http_equiv", pa.string()),
                        ("itemprop", pa.string()),
                        ("content", pa.string()),
                    ]
                )
            ),
        ),
        ("links", pa.list_(pa.string())),
        ("json_ld", pa.list_(pa.string())),
        (
            "microdata",
            pa.list_(
                pa.struct(
                    [
                        ("itemtype", pa.string()),
                        (
                            "properties",
                            pa.list_(
                                pa.struct([("name", pa.string()), ("value", pa.string())])
                            ),
                        ),
                    ]
                )
            ),
        ),
        ("error", pa.string()),
    ]
)
PAGE_DDL = (
    "struct<title:string,main_text:string,html_lang:string,canonical_url:string,"
    "metas:array<struct<name:string,property:string,http_equiv:string,itemprop:string,"
    "content:string>>,links:array<string>,json_ld:array<string>,"
    "microdata:array<struct<itemtype:string,"
    "properties:array<struct<name:string,value:string>>>>,error:string>"
)


# Start tags that end an open element of some kind, unless one of a fence stands between.
BLOCKS = frozenset("article aside body div footer form header html main nav section table td th".split())
IMPLIED = {
    "p": ({"p"}, BLOCKS | {"li", "dd", "ul", "ol", "dl"}),
    "li": ({"li"}, frozenset({"ul", "ol"})),
    "dt": ({"dt", "dd"}, frozenset({"dl"})),
    "dd": ({"dt", "dd"}, frozenset({"dl"})),
    "option": ({"option"}, frozenset({"select"})),
    "tr": ({"tr"}, frozenset({"table"})),
    "td": ({"td", "th"}, frozenset({"table", "tr"})),
    "th": ({"td", "th"}, frozenset({"table", "tr"})),
}


class Element:
    """A tag, its attributes and its children (elements and strings, in order)."""

    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str]):
        self.tag, self.attrs, self.children = tag, attrs, []


class Outline:
    """All elements of a tree in document order, each with the interval of the strings it holds.

    Every node is visited once. Strings are stripped and not empty. Those of an opaque element are
    held by it and by what is inside, not by the elements around it, so they
    stand in a list of their own.
    """

    def __init__(self, root: Element, most: int):
        """``most`` bounds the characters that are taken from the outline, nested copies included."""
        self.left = most
        self.elements: list[Element] = []
        # By element: where it ends in document order, its list of strings, and its interval there.
        self.ends: list[int] = []
        self.held: list[tuple[list[str], int, int]] = []
        # Strings of a list and their total lengths so far.
        lists: list[tuple[list[str], list[int]]] = [([], [0])]
        self.totals = {id(lists[0][0]): lists[0][1]}
        stack: list[tuple[Element | str, int]] = [(child, -1) for child in reversed(root.children)]
        while stack:
            node, number = stack.pop()
            strings, totals = lists[-1]
            if isinstance(node, str):
                if text := node.strip():
                    strings.append(text)
                    totals.append(totals[-1] + len(text))
            elif number < 0:
                number = len(self.elements)
                if node.tag in OPAQUE_TAGS:
                    lists.append(([], [0]))
                    strings, totals = lists[-1]
                    self.totals[id(strings)] = totals
                self.elements.append(node)
                self.ends.append(0)
                self.held.append((strings, len(strings), 0))
                stack.append((node, number))
                stack.extend((child, -1) for child in reversed(node.children))
            else:
                own, start, _ = self.held[number]
                self.held[number] = own, start, len(own)
                self.ends[number] = len(self.elements)
                if node.tag in OPAQUE_TAGS:
                    lists.pop()

    def spend(self, characters: int) -> None:
        self.left -= characters
        if self.left < 0:
            raise ValueError("elements nested in each other hold too much text")

    def text(self, number: int, separator: str) -> str:
        """The strings of an element, with ``separator`` between."""
        strings, start, end = self.held[number]
        totals = self.totals[id(strings)]
        self.spend(totals[end] - totals[start] + len(separator) * (end - start))
        return separator.join(strings[start:end])

    def tagged(self, *tags: str) -> list[int]:
        return [n for n, e in enumerate(self.elements) if e.tag in tags]


class TreeBuilder(HTMLParser):
    """Nests tags as written; an end tag closes up to its nearest open namesake.

    Text up to the next tag or comment is one string. Entities end at the first
    character that no name can hold; unknown ones stay as text.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=False)
        self.root = Element("", {})
        self.open = [self.root]
        # Depths of the open elements by tag, so that none is searched for.
        self.depths: dict[str, list[int]] = {}
        self.text: list[str] = []

    def end_text(self) -> None:
        if self.text:
            self.open[-1].children.append("".join(self.text))
            self.text = []

    def deepest(self, tags) -> int:
        """Depth of the nearest open element with one of ``tags``, 0 if there is none."""
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def close_from(self, depth: int) -> None:
        while len(self.open) > depth:
            self.depths[self.open.pop().tag].pop()

    def close_implied(self, tag: str) -> None:
        """End an open element that cannot hold ``tag``, such as a paragraph in a paragraph."""
        ends, fence = IMPLIED[tag]
        depth = self.deepest(ends)
        if depth and depth >= self.deepest(fence):
            self.close_from(depth)

    def handle_starttag(self, tag, attrs):
        self.end_text()
        if tag in IMPLIED:
            self.close_implied(tag)
        node = Element(tag, {name: value or "" for name, value in attrs})
        self.open[-1].children.append(node)
        if tag not in VOID_TAGS:
            self.depths.setdefault(tag, []).append(len(self.open))
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.close_from(len(self.open) - 1)

    def handle_endtag(self, tag):
        self.end_text()
        if depth := self.deepest((tag,)):
            self.close_from(depth)

    def handle_data(self, data):
        self.text.append(data)

    def handle_entityref(self, name):
        self.text.append(html5.get(f"{name};", f"&{name}"))

    def handle_charref(self, name):
        self.text.append(unescape(f"&#{name};"))

    def handle_comment(self, data):
        self.end_text()

    handle_decl = handle_pi = unknown_decl = handle_comment


def parse(html: str) -> Element:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    builder.end_text()
    return builder.root


def class_test(names: tuple[str, ...], whole: bool):
    if whole:
        wanted = frozenset(names)
        return lambda value: not wanted.isdisjoint(value.lower().split())
    return re.compile("|".join(names), re.I).search


def drop_boilerplate(root: Element, whole_class: bool) -> None:
    unwanted = class_test(BOILERPLATE_CLASSES, whole_class)
    stack = [root]
    while stack:
        node = stack.pop()
        node.children = [
            child
            for child in node.children
            if isinstance(child, str)
            or not (child.tag in BOILERPLATE_TAGS or unwanted(child.attrs.get("class", "")))
        ]
        stack.extend(child for child in node.children if isinstance(child, Element))


def whole_text(node: Element) -> str:
    """All strings of an element as they stand, but for those of opaque ones inside it."""
    out, stack = [], list(reversed(node.children))
    while stack:
        child = stack.pop()
        if isinstance(child, str):
            out.append(child)
        elif child.tag not in OPAQUE_TAGS:
            stack.extend(reversed(child.children))
    return "".join(out).strip()


def main_text(page: Outline) -> str:
    """Text of main/article elements, else of content divs, else of text tags."""
    found = page.tagged("main", "article")
    if not found:
        content = class_test(CONTENT_CLASSES, False)
        found = [n for n in page.tagged("div") if content(page.elements[n].attrs.get("class", ""))]
    if found:
        return "\n\n".join(page.text(n, " ") for n in found)
    texts = (page.text(n, "") for n in page.tagged(*TEXT_TAGS))
    return "\n".join(text for text in texts if len(text) > 10)


def json_ld(page: Outline) -> list[str]:
    scripts = (page.elements[n] for n in page.tagged("script"))
    texts = (
        "".join(c for c in e.children if isinstance(c, str))
        for e in scripts if e.attrs.get("type") == "application/ld+json"
    )
    return [text for text in texts if text]


def microdata(page: Outline) -> list[dict]:
    """Every item with the properties below it, those of items inside it included."""
    places = [n for n, e in enumerate(page.elements) if "itemprop" in e.attrs]
    values = [
        {"name": e.attrs["itemprop"], "value": e.attrs.get("content") or page.text(n, "")}
        for n, e in ((n, page.elements[n]) for n in places)
    ]
    sizes = [0, *accumulate(len(v["name"]) + len(v["value"]) for v in values)]
    items = []
    for n, item in enumerate(page.elements):
        if "itemtype" in item.attrs:
            first, last = bisect_right(places, n), bisect_left(places, page.ends[n])
            page.spend(sizes[last] - sizes[first] + last - first if last > first else 0)
            if last > first:
                items.append({"itemtype": item.attrs["itemtype"], "properties": values[first:last]})
    return items


def links(page: Outline, base: str) -> list[str]:
    """Link targets resolved against the page, in document order."""
    found = []
    for n in page.tagged("a"):
        href = page.elements[n].attrs.get("href")
        if href is None or href.startswith(SKIPPED_SCHEMES):
            continue
        try:
            found.append(urljoin(base, href))
        except ValueError:
            continue
    return found


# Pages whose parts are held as Python objects at once.
PAGES_AT_ONCE = 64
# Characters that a page may yield for each of its own, and beyond that; nested containers repeat their text.
YIELD, LEAST_YIELD = 16, 1 << 20
EMBEDDED = ("links", "json_ld", "microdata")


def read_page(
    html: str, url: str, after_cleanup: bool, whole_class: bool, wanted: frozenset[str] | None = None
) -> dict:
    """The ``wanted`` parts of a page, all by default. A page whose nested elements repeat their text
    beyond all measure raises a ValueError.
    """
    root, most = parse(html), YIELD * len(html) + LEAST_YIELD

    def asked(*names: str) -> bool:
        return wanted is None or not wanted.isdisjoint(names)

    def embedded(page: Outline) -> dict:
        made = {}
        if asked("links"):
            made["links"] = links(page, url)
        if asked("json_ld"):
            made["json_ld"] = json_ld(page)
        if asked("microdata"):
            made["microdata"] = microdata(page)
        return made

    page = {}
    if asked("title") or not after_cleanup:
        raw = Outline(root, most)
        if asked("title"):
            page["title"] = next((whole_text(raw.elements[n]) for n in raw.tagged("title")), "")
        if not after_cleanup:
            page.update(embedded(raw))
    if not after_cleanup and not asked("main_text", "html_lang", "canonical_url", "metas"):
        return page
    drop_boilerplate(root, whole_class)
    clean = Outline(root, most)
    if after_cleanup:
        page.update(embedded(clean))
    if asked("main_text"):
        page["main_text"] = main_text(clean)
    page["html_lang"] = next((clean.elements[n].attrs.get("lang") for n in clean.tagged("html")), None)
    page["canonical_url"] = next(
        (
            e.attrs.get("href") for e in (clean.elements[n] for n in clean.tagged("link"))
            if "canonical" in e.attrs.get("rel", "").split()
        ),
        None,
    )
    page["metas"] = [
        {key.replace("-", "_"): clean.elements[n].attrs.get(key)
         for key in ("name", "property", "http-equiv", "itemprop", "content")}
        for n in clean.tagged("meta")
    ]
    return page


def page_parts(
    html: Column,
    url: Column,
    after_cleanup: bool = False,
    whole_class: bool = False,
    wanted: tuple[str, ...] | None = None,
) -> Column:
    """Struct of page parts. Links and structured data come from the page as
    fetched, or from what is left after boilerplate removal (``after_cleanup``).
    Parts that are not ``wanted`` are null or as cheap as they come. A batch is
    read in slices, so that few of its pages are Python objects at a time.
    """
    parts = None if wanted is None else frozenset(wanted)

    def rows(html_slice: pa.Array, url_slice: pa.Array) -> pa.Array:
        found = []
        for html, url in zip(html_slice, url_slice):
            try:
                text = html.as_py()
                found.append(None if text is None else read_page(text, url.as_py() or "", after_cleanup, whole_class, parts))
            except Exception as problem:  # noqa: BLE001 - one page must not end the job
                found.append({"error": f"{type(problem).__name__}: {problem}"[:1000]})
        return pa.array(found, type=PAGE_TYPE)

    @F.arrow_udf(PAGE_DDL)
    def extract(html_batch: pa.Array, url_batch: pa.Array) -> pa.Array:
        starts = range(0, len(html_batch), PAGES_AT_ONCE)
        slices = [rows(html_batch.slice(i, PAGES_AT_ONCE), url_batch.slice(i, PAGES_AT_ONCE)) for i in starts]
        return pa.concat_arrays(slices) if slices else pa.array([], type=PAGE_TYPE)

    # Non-deterministic keeps the optimizer from copying the parse into filters.
    return extract.asNondeterministic()(html, url)
