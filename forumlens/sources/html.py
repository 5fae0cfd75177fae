"""Fields out of stored web pages.

``page_fields`` covers ordinary pages with regular expressions inside the JVM.
``listing_posts`` and ``thread_comments`` need nested elements, so they parse each page in a
narrow Arrow-batched map.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens.functions.text import collapse, replace_in_order

ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]

# Field -> pattern with one group.
FIELDS = {
    "title": r"(?is)<title[^>]*>(.*?)</title>",
    "heading": r"(?is)<h1[^>]*>(.*?)</h1>",
    "article": r"(?is)<article[^>]*>(.*?)</article>",
}
LINK = r"(?i)<a\s[^>]*?href=\"([^\"]*)\""
NEXT_TAG = r"(?i)(<a\s[^>]*?rel=\"next\"[^>]*>)"


def plain(markup: Column) -> Column:
    """Element text, tags replaced by a space, the common entities resolved."""
    no_code = F.regexp_replace(markup, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    return collapse(replace_in_order(F.regexp_replace(no_code, r"<[^>]*>", " "), ENTITIES, pad=False))


def page_fields(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    next_href = F.regexp_extract(F.regexp_extract(html, NEXT_TAG, 1), r"href=\"([^\"]*)\"", 1)
    return pages.select(
        *[c for c in pages.columns if c != html],
        F.element_at(F.split(url, "/"), -1).alias("post_id"),
        plain(F.regexp_extract(html, FIELDS["title"], 1)).alias("title"),
        plain(F.regexp_extract(html, FIELDS["heading"], 1)).alias("heading"),
        plain(F.regexp_extract(html, FIELDS["article"], 1)).alias("body"),
        F.regexp_extract_all(html, F.lit(LINK), F.lit(1)).alias("links"),
        F.when(next_href.startswith("http"), next_href).alias("next_link"),
    )


# Class names of the stored forum pages.
LIST_BLOCK = "custom-message-list all-discussions"
BODY = "body-text"
AUTHOR_INFO = "custom-tile-author-info"
CATEGORY_INFO = "custom-tile-category-content"
REPLIES = "custom-tile-replies"
THREAD = "lia-component-message-list-detail-with-inline-editors"
MESSAGES = "linear-message-list message-list"
MESSAGE = "lia-quilt-row lia-quilt-row-message-main"

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}


class _Element:
    def __init__(self, tag: str, attrs: dict[str, str]) -> None:
        self.tag, self.attrs, self.items = tag, attrs, []

    def walk(self) -> Iterator[_Element]:
        for item in self.items:
            if isinstance(item, _Element):
                yield item
                yield from item.walk()

    def find(self, tag: str, classes: str = "") -> _Element | None:
        wanted = set(classes.split())
        return next(
            (e for e in self.walk() if e.tag == tag and wanted <= set(e.attrs.get("class", "").split())), None
        )

    def text(self) -> str:
        parts = (i.text() if isinstance(i, _Element) else i.strip() for i in self.items)
        return " ".join(p for p in parts if p)


class _Tree(HTMLParser):
    """Forgiving element tree: a stray end tag is ignored, an open element ends with its parent."""

    def __init__(self, markup: str) -> None:
        super().__init__(convert_charrefs=True)
        self.root = _Element("", {})
        self.open = [self.root]
        self.feed(markup)
        self.close()

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        element = _Element(tag, {k: v or "" for k, v in attrs})
        self.open[-1].items.append(element)
        if tag not in VOID:
            self.open.append(element)

    def handle_endtag(self, tag: str) -> None:
        depth = next((i for i in range(len(self.open) - 1, 0, -1) if self.open[i].tag == tag), 0)
        if depth:
            del self.open[depth:]

    def handle_data(self, data: str) -> None:
        self.open[-1].items.append(data)


def _inner(element: _Element | None, *path: tuple[str, str], default: str = "") -> str:
    for tag, classes in path:
        element = element.find(tag, classes) if element is not None else None
    return element.text() if element is not None else default


def _listed(markup: str) -> list[dict]:
    """Posts of one discussion list; entries without a second heading link are skipped."""
    root = _Tree(markup).root
    block = root.find("div", LIST_BLOCK)
    after = next((e for e in root.walk() if e.tag == "a" and "next" in e.attrs.get("rel", "").split()), None)
    link = after.attrs.get("href", "") if after is not None else ""
    rows = []
    for article in (e for e in block.walk() if e.tag == "article") if block is not None else ():
        heading = article.find("h3")
        anchors = [e for e in heading.walk() if e.tag == "a"] if heading is not None else []
        if len(anchors) < 2 or "href" not in anchors[1].attrs:
            continue
        side = article.find("aside")
        rows.append(
            {
                "href": anchors[1].attrs["href"],
                "post_id": anchors[1].attrs["href"].split("/")[-1],
                "title": anchors[1].text(),
                "content": _inner(article, ("p", BODY)),
                "author": _inner(side, ("div", AUTHOR_INFO), ("a", ""), ("span", "")),
                "raw_date": _inner(side, ("div", CATEGORY_INFO), ("time", "")),
                "n_comments": _inner(article, ("li", REPLIES), ("b", ""), default="0"),
                "next_link": link if link.startswith("http") else None,
            }
        )
    return rows


def _commented(markup: str) -> list[dict]:
    section = _Tree(markup).root.find("div", THREAD)
    messages = section.find("div", MESSAGES) if section is not None else None
    found = []
    for child in messages.items if messages is not None else ():
        if isinstance(child, _Element) and child.tag == "div":
            main = child.find("div", MESSAGE)
            if main is not None:
                found.append(main.text())
    return [{"comments": found}]


def _parsed(pages: DataFrame, key: str, html: str, parse: Callable[[str], list[dict]], fields: str) -> DataFrame:
    names = [f.split()[0] for f in fields.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [{key: k, **row} for k, page in zip(batch[key], batch[html]) for row in parse(page or "")]
            yield pd.DataFrame(rows, columns=[key, *names])

    key_type = pages.schema[key].dataType.simpleString()
    return pages.select(key, html).mapInPandas(run, f"`{key}` {key_type}, {fields}")


def listing_posts(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    fields = (
        "href string, post_id string, title string, content string, author string, "
        "raw_date string, n_comments string, next_link string"
    )
    return _parsed(pages, key, html, _listed, fields)


def thread_comments(pages: DataFrame, key: str = "page_id", html: str = "html") -> DataFrame:
    return _parsed(pages, key, html, _commented, "comments array<string>")
