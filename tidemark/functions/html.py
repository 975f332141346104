"""Article parser: HTML to a typed article with ordered blocks and classified images.

Runs in Arrow batches; only the standard library's tokenizer is used.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
SKIP = frozenset("script style template noscript svg iframe button form nav footer aside".split())
BLOCKS = {"p": "paragraph", "li": "list_item", "blockquote": "quote", "pre": "code", "figcaption": "caption", "table": "table", **{f"h{k}": "heading" for k in range(1, 7)}}
NOISE_CLASS = re.compile(r"(?:^|[\s_-])(?:ad|ads|advert|advertisement|promo|related|share|social|newsletter|sidebar|breadcrumb|comments?)(?:$|[\s_-])", re.I)
ARTICLE_TYPES = frozenset({"NewsArticle", "Article", "ReportageNewsArticle", "OpinionNewsArticle", "BlogPosting"})
ARCHIVED_ROLES = frozenset({"lead", "body", "gallery"})
LEAST_BODY, SHORT_BODY = 200, 1000
PAYWALL = re.compile(r"subscribe to (?:continue|read|unlock)|already a subscriber|sign in to read", re.I)

SCHEMA = (
    "struct<headline string, description string, published_at string, modified_at string, language string, canonical string,"
    " section string, authors array<string>, content_type string, status string, warnings array<string>, plain_text string,"
    " blocks array<struct<position int, kind string, level int, text string, asset string>>,"
    " images array<struct<asset string, url string, role string, alt string, caption string, keep boolean>>>"
)
ARROW = pa.struct(
    [(n, pa.string()) for n in ("headline", "description", "published_at", "modified_at", "language", "canonical", "section")]
    + [("authors", pa.list_(pa.string())), ("content_type", pa.string()), ("status", pa.string()), ("warnings", pa.list_(pa.string())), ("plain_text", pa.string())]
    + [("blocks", pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("level", pa.int32()), ("text", pa.string()), ("asset", pa.string())])))]
    + [("images", pa.list_(pa.struct([("asset", pa.string()), ("url", pa.string()), ("role", pa.string()), ("alt", pa.string()), ("caption", pa.string()), ("keep", pa.bool_())])))]
)


class Node:
    __slots__ = ("attrs", "children", "parent", "tag")

    def __init__(self, tag: str, attrs: dict, parent: Node | None) -> None:
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def walk(self) -> Iterator[Node]:
        """Elements in document order, without recursion."""
        todo = [self]
        while todo:
            node = todo.pop()
            yield node
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def text(self, skip: frozenset = frozenset()) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag == "br":
                out.append(" ")
            elif x.tag not in SKIP and x.tag not in skip:
                todo.extend(reversed(x.children))
        return clean("".join(out))


def clean(text: str) -> str:
    return " ".join(text.split())


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)
        self.depth = 0

    def handle_starttag(self, tag, attrs):
        if tag in BLOCKS or tag in ("div", "section", "article", "ul", "ol", "figure", "main"):
            p = self.at
            while p.tag in ("b", "i", "em", "strong", "span", "a", "p") and p.tag != "p":
                p = p.parent
            if p.tag == "p" or (tag == "li" and p.tag == "li"):
                self.at = p.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        p = self.at
        while p is not None and p.tag != tag:
            p = p.parent
        if p is not None and p.parent is not None:
            self.at = p.parent

    def handle_data(self, data):
        self.at.children.append(data)


def objects(value) -> Iterator[dict]:
    """JSON objects, depth first."""
    todo = [value]
    while todo:
        x = todo.pop()
        if isinstance(x, dict):
            yield x
            todo.extend(reversed(list(x.values())))
        elif isinstance(x, list):
            todo.extend(reversed(x))


def linked_article(root: Node) -> dict:
    """The first article object of the page's JSON-LD."""
    for node in root.walk():
        if node.tag == "script" and "ld+json" in node.attrs.get("type", ""):
            try:
                data = json.loads("".join(c for c in node.children if isinstance(c, str)))
            except (ValueError, RecursionError):
                continue
            for x in objects(data):
                kinds = x.get("@type")
                if ARTICLE_TYPES & set(kinds if isinstance(kinds, list) else [kinds] if isinstance(kinds, str) else []):
                    return x
    return {}


def _strings(x) -> list[str]:
    if isinstance(x, str):
        return [clean(x)] if x.strip() else []
    if isinstance(x, dict):
        return _strings(x.get("name") or x.get("url") or x.get("@id"))
    return [s for v in x for s in _strings(v)] if isinstance(x, list) else []


def _first(*values) -> str | None:
    for v in values:
        if found := _strings(v):
            return found[0]
    return None


def _body(root: Node) -> Node:
    """The first kind of container that is there, the longest of its kind."""
    kinds = (
        lambda n: n.attrs.get("itemprop") == "articleBody",
        lambda n: n.tag == "article",
        lambda n: n.tag == "main" or n.attrs.get("role") == "main",
        lambda n: n.tag == "body",
    )
    nodes = list(root.walk())
    for kind in kinds:
        if hits := [n for n in nodes if kind(n)]:
            return max(hits, key=lambda n: len(n.text()))
    return root


def _noisy(node: Node) -> bool:
    return node.tag in SKIP or bool(NOISE_CLASS.search(f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}"))


def _role(node: Node, caption: str | None, first: bool) -> str:
    w = node.attrs.get("width", "")
    url = node.attrs.get("src", "").lower()
    if re.search(r"logo|icon|avatar|pixel|spacer|placeholder", url) or (w.isdigit() and int(w) < 80):
        return "decoration"
    return "lead" if first else "body" if caption or (w.isdigit() and int(w) >= 400) or not w else "inline"


def identity(url: str) -> str:
    """Name of an image across renditions: host and path without sizes and query."""
    u = urlsplit(url)
    path = re.sub(r"(?<=[/_-])\d{1,4}x\d{1,4}(?=[/._-]|$)", "", u.path)
    return "urlsha256:" + hashlib.sha256(f"{(u.hostname or '').lower()}{path}".encode("utf-8", "replace")).hexdigest()


def extract(body: Node, base: str) -> tuple[list[dict], list[dict]]:
    blocks: list[dict] = []
    images: dict[str, dict] = {}
    seen: set[str] = set()
    todo = [body]
    while todo:
        node = todo.pop()
        if node is not body and _noisy(node):
            continue
        if node.tag == "img" and (src := node.attrs.get("src") or node.attrs.get("data-src")):
            url = urljoin(base, src.strip())
            if url.startswith(("http://", "https://")):
                figure = node
                while figure is not None and figure.tag != "figure":
                    figure = figure.parent
                caption = next((n.text() for n in figure.walk() if n.tag == "figcaption"), None) if figure else None
                asset = identity(url)
                if asset not in images:
                    role = _role(node, caption, not any(i["role"] == "lead" for i in images.values()))
                    images[asset] = {"asset": asset, "url": url, "role": role, "alt": clean(node.attrs.get("alt", "")) or None, "caption": caption, "keep": role in ARCHIVED_ROLES}
                    if images[asset]["keep"]:
                        blocks.append({"kind": "image", "level": None, "text": caption, "asset": asset})
            continue
        if node.tag in BLOCKS:
            inner = [n for n in node.walk() if n is not node and n.tag in BLOCKS]
            if not inner or node.tag in ("table", "pre"):
                text = node.text()
                key = text.casefold()
                if text and key not in seen:
                    seen.add(key)
                    kind = BLOCKS[node.tag]
                    blocks.append({"kind": kind, "level": int(node.tag[1]) if kind == "heading" else None, "text": text, "asset": None})
                todo.extend(n for n in reversed(list(node.walk())) if n.tag == "img")
                continue
        todo.extend(c for c in reversed(node.children) if isinstance(c, Node))
    for k, b in enumerate(blocks):
        b["position"] = k
    return blocks, list(images.values())


def parse(html: str, url: str | None) -> dict:
    tree = _Tree()
    tree.feed(html)
    tree.close()
    root, meta, canonical, title, language = tree.root, {}, None, None, None
    for n in root.walk():
        if n.tag == "meta" and (name := n.attrs.get("property") or n.attrs.get("name")):
            meta.setdefault(name.lower(), n.attrs.get("content", ""))
        elif n.tag == "link" and "canonical" in n.attrs.get("rel", "").lower():
            canonical = canonical or n.attrs.get("href")
        elif n.tag == "title" and title is None:
            title = n.text()
        elif n.tag == "html":
            language = n.attrs.get("lang")
    data = linked_article(root)
    base = url if url and url.startswith("http") else "https://localhost/"
    body = _body(root)
    blocks, images = extract(body, base)
    if not any(b["kind"] == "paragraph" for b in blocks) and isinstance(data.get("articleBody"), str):
        extra = [clean(x) for x in re.split(r"\n+", data["articleBody"]) if x.strip()]
        blocks += [{"kind": "paragraph", "level": None, "text": x, "asset": None, "position": len(blocks) + k} for k, x in enumerate(extra)]
    h1 = next((n.text() for n in root.walk() if n.tag == "h1"), None)
    headline = _first(data.get("headline"), meta.get("og:title"), h1, title)
    plain = "\n".join(b["text"] for b in blocks if b["kind"] in ("paragraph", "list_item", "quote", "code", "table") and b["text"])
    authors = list({a.casefold(): a for a in reversed([*_strings(data.get("author")), *_strings(meta.get("author"))])}.values())[::-1]
    kinds = " ".join(_strings(data.get("@type")))
    kept = [i for i in images if i["keep"]]
    content = "opinion" if "Opinion" in kinds or (url and "/opinion/" in url) else "gallery" if len(kept) >= 4 and len(plain) < SHORT_BODY else "liveblog" if "LiveBlog" in kinds else "article"
    warnings = [w for w, bad in (("no-headline", not headline), ("no-published-date", not _first(data.get("datePublished"), meta.get("article:published_time"))), ("short-body", len(plain) < SHORT_BODY), ("paywall", len(plain) < SHORT_BODY and bool(PAYWALL.search(plain)))) if bad]
    status = "failed" if not headline or not plain else "partial" if len(plain) < LEAST_BODY and content != "gallery" or "paywall" in warnings else "complete"
    return {
        "headline": headline,
        "description": _first(data.get("description"), meta.get("og:description"), meta.get("description")),
        "published_at": _first(data.get("datePublished"), meta.get("article:published_time")),
        "modified_at": _first(data.get("dateModified"), meta.get("article:modified_time")),
        "language": language or None,
        "canonical": urljoin(base, canonical) if canonical else None,
        "section": _first(data.get("articleSection"), meta.get("article:section")),
        "authors": authors,
        "content_type": content,
        "status": status,
        "warnings": warnings,
        "plain_text": plain,
        "blocks": blocks,
        "images": images,
    }


def _article(html: pa.Array, url: pa.Array) -> pa.Array:
    return pa.array([None if h is None else parse(h, u) for h, u in zip(html.to_pylist(), url.to_pylist())], ARROW)


def article(html: Column, url: Column) -> Column:
    """Column of pages (and their addresses) to articles; null pages stay null."""
    return F.arrow_udf(_article, SCHEMA)(html, url)


def normalized_block(text: str) -> str:
    return clean(text).casefold()
