"""What a page tells: main text, images, handles and published date.

The expressions cover pages of known shape inside the JVM; parse_pages covers any page with one parse in Python.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_BODY, MAX_BODY, MAX_IMAGES = 100, 8000, 5
# Containers of main text in order of trust, and the signals of a published date.
BODY_SELECTORS = (".tt_article_useless_p_margin", ".entry-content", ".article_view", ".contents_style", "article")
PUBLISHED_META = ("article:published_time", "og:regDate", "datePublished")
PUBLISHED_CLASSES = ("blog_date", "se_publishDate", "article-date")
# Paths of the site that are no accounts, and endings of file names.
NO_HANDLES = ("p", "reel", "reels", "explore", "accounts", "stories", "share")
FILE_ENDINGS = ("js", "css", "json", "png", "jpg", "jpeg", "gif", "svg", "ico", "html")
HANDLE = r"""(?:^|[/."'\s])(?:www\.)?instagram\.com/([A-Za-z0-9_.]{2,30})"""


def page_flag(body: Column) -> Column:
    """ok for a main text of MIN_BODY characters or more, else empty_body."""
    return F.when(F.length(body) >= MIN_BODY, "ok").otherwise("empty_body")


def article_text(html: Column) -> Column:
    """Text of the first article element, one line per piece between tags; null if shorter than MIN_BODY, cut at MAX_BODY."""
    inner = F.regexp_extract(html, r"(?s)<article[^>]*>(.*?)</article>", 1)
    inner = F.regexp_replace(inner, r"(?s)<(script|style)[^>]*>.*?</(script|style)>", "")
    lines = F.filter(F.transform(F.split(F.regexp_replace(inner, r"<[^>]+>", "\n"), "\n"), lambda x: F.btrim(x)), lambda x: x != "")
    text = F.array_join(lines, "\n")
    return F.when(F.length(text) >= MIN_BODY, F.substring(text, 1, MAX_BODY))


def image_urls(html: Column) -> Column:
    """src, else data-src, of images with absolute addresses: distinct in order, at most MAX_IMAGES."""
    tags = F.regexp_extract_all(html, F.lit(r"<img\b[^>]*>"), F.lit(0))
    of = lambda t: F.coalesce(*(F.nullif(F.regexp_extract(t, rf'\s{a}="\s*([^"]*?)\s*"', 1), F.lit("")) for a in ("src", "data-src")))
    return F.slice(F.array_distinct(F.filter(F.transform(tags, of), lambda u: u.rlike(r"\Ahttps?://"))), 1, MAX_IMAGES)


def og_image(html: Column) -> Column:
    return F.nullif(F.btrim(F.regexp_extract(html, r'<meta property="og:image" content="([^"]*)"', 1)), F.lit(""))


def handles(html: Column) -> Column:
    """Accounts named in a page: lower case without final dots, no file names, no reserved paths, distinct in order."""
    found = F.transform(F.regexp_extract_all(html, F.lit(HANDLE), F.lit(1)), lambda h: F.rtrim(F.lower(h), F.lit(".")))
    real = lambda h: ~F.regexp_extract(h, r"([^.]*)\z", 1).isin(*FILE_ENDINGS) & ~h.isin(*NO_HANDLES)
    return F.array_distinct(F.filter(found, real))


def published(html: Column) -> Column:
    """The published date of pages of known shape: meta names by priority, JSON-LD, classes, then time elements; as it stands there."""
    signals = [rf'<meta (?:property|name)="{name}" content="\s*([^"]*?)\s*"' for name in PUBLISHED_META]
    signals += [r'"datePublished"\s*:\s*"\s*([^"]*?)\s*"', rf'class="(?:{"|".join(PUBLISHED_CLASSES)})"[^>]*>\s*([^<]*?)\s*<', r'<time[^>]*\sdatetime="\s*([^"]*?)\s*"', r"<time[^>]*>\s*([^<]*?)\s*<"]
    return F.coalesce(*(F.nullif(F.regexp_extract(html, s, 1), F.lit("")) for s in signals))


_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())


class _Node:
    def __init__(self, tag: str, attrs: dict[str, str], parent: _Node | None):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.items: list[_Node | str] = []

    def walk(self) -> Iterator[_Node]:
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(x for x in reversed(node.items) if isinstance(x, _Node))

    def pieces(self) -> Iterator[str]:
        """Stripped texts below, those of scripts and styles aside unless this is one."""
        todo: list = [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                if x.strip():
                    yield x.strip()
            elif x is self or x.tag not in ("script", "style", "template"):
                todo.extend(reversed(x.items))


class _Tree(HTMLParser):
    """A forgiving tree: an end tag closes the nearest open element of its name, or nothing."""

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.root = self.at = _Node("", {}, None)
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        node = _Node(tag, {k: v or "" for k, v in reversed(attrs)}, self.at)
        self.at.items.append(node)
        if tag not in _VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if self.at.tag == tag and tag not in _VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        node = self.at
        while node.parent is not None and node.tag != tag:
            node = node.parent
        if node.parent is not None:
            self.at = node.parent

    def handle_data(self, data):
        self.at.items.append(data)


def _matches(node: _Node, selector: str) -> bool:
    return selector[1:] in node.attrs.get("class", "").split() if selector[0] == "." else node.tag == selector


def _ld_date(node) -> str | None:
    """datePublished anywhere in JSON-LD, outer before inner."""
    todo = [node]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            if x.get("datePublished"):
                return str(x["datePublished"]).strip()
            todo.extend(reversed(list(x.values())))
        elif isinstance(x, list):
            todo.extend(reversed(x))
    return None


def _published(nodes: list[_Node]) -> str | None:
    metas = [n for n in nodes if n.tag == "meta"]
    for name in PUBLISHED_META:
        for key in ("property", "name"):
            first = next((m for m in metas if m.attrs.get(key) == name), None)
            if first is not None:
                if first.attrs.get("content", "").strip():
                    return first.attrs["content"].strip()
                break
    for n in nodes:
        if n.tag == "script" and n.attrs.get("type") == "application/ld+json":
            try:
                found = _ld_date(json.loads("".join(x for x in n.items if isinstance(x, str)) or "{}"))
            except ValueError:
                continue
            if found:
                return found
    first = next((n for n in nodes if set(n.attrs.get("class", "").split()) & set(PUBLISHED_CLASSES)), None)
    if first is not None and (text := "".join(first.pieces())):
        return text
    first = next((n for n in nodes if n.tag == "time"), None)
    if first is not None:
        return (first.attrs.get("datetime") or "".join(first.pieces())).strip() or None
    return None


def _fallback(nodes: list[_Node]) -> str | None:
    """Paragraphs outside navigation and footers, for pages without a known container. An approximation of boilerplate removal of our own."""

    def inside(n: _Node) -> bool:
        while n is not None:
            if n.tag in ("nav", "footer", "header", "aside", "form"):
                return True
            n = n.parent
        return False

    text = "\n".join(t for n in nodes if n.tag == "p" and not inside(n) and (t := " ".join(n.pieces())))
    return text if len(text) >= MIN_BODY else None


def parse_page(html: str | None, base_url: str | None = "") -> dict:
    """body, poster_image_url, image_urls, instagram_candidates and published_at of one page."""
    html = html or ""
    nodes = list(_Tree(html).root.walk())
    body, images = None, []
    for selector in BODY_SELECTORS:
        node = next((n for n in nodes if n.tag and _matches(n, selector)), None)
        if node is not None and len(text := "\n".join(node.pieces())) >= MIN_BODY:
            body = text
            for img in (n for n in node.walk() if n.tag == "img"):
                src = (img.attrs.get("src") or img.attrs.get("data-src") or "").strip()
                url = urljoin(base_url or "", src) if src else ""
                if url.startswith(("http://", "https://")) and url not in images and len(images) < MAX_IMAGES:
                    images.append(url)
            break
    body = body or _fallback(nodes)
    og = next((n.attrs["content"].strip() for n in nodes if n.tag == "meta" and n.attrs.get("property") == "og:image" and n.attrs.get("content")), None)
    names: list[str] = []
    for m in re.finditer(HANDLE, html):
        h = m[1].lower().rstrip(".")
        if h.rsplit(".", 1)[-1] not in FILE_ENDINGS and h not in NO_HANDLES and h not in names:
            names.append(h)
    return {"body": body[:MAX_BODY] if body else None, "poster_image_url": og, "image_urls": images, "instagram_candidates": names, "published_at": _published(nodes)}


PARSED = "body string, poster_image_url string, image_urls array<string>, instagram_candidates array<string>, published_at string"


def parse_pages(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """pages with a struct column `page` of all that one parse gives. Null html gives nulls and empty lists."""

    @F.pandas_udf(f"struct<{PARSED.replace(' string', ':string').replace(' array', ':array').replace(', ', ',')}>")
    def parse(html: pd.Series, url: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([parse_page(h, u) for h, u in zip(html, url, strict=True)], columns=["body", "poster_image_url", "image_urls", "instagram_candidates", "published_at"])

    return pages.withColumn("page", parse(F.col(html_col), F.col(url_col)))
