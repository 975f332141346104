"""News articles: HTML to a typed article by the rules of its publisher (`functions.html` is the generic parser).

Runs in Arrow batches; only the standard library's tokenizer is used.  What differs between publishers is data
(`SITES`): elements and texts that are chrome, marks of a cut text, suffixes that aren't prose.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.html import NOISE_CLASS, VOID, _first, _strings, clean, identity, objects

SKIP = frozenset("script style template noscript svg button form nav footer aside".split())
SELECTED = frozenset("p pre h2 h3 h4 h5 h6 blockquote ul ol figure table iframe".split())
FLOW = frozenset("div section article ul ol figure main p pre h1 h2 h3 h4 h5 h6 blockquote table hr li".split())
NOISE_TEXT = frozenset({".", "##", "advertisement", "advertiser content", "sponsored content"})
ARTICLE_TYPES = frozenset({"NewsArticle", "Article", "ReportageNewsArticle", "OpinionNewsArticle", "BlogPosting", "LiveBlogPosting"})
TEXT_KINDS = frozenset({"paragraph", "heading", "quote", "list", "table"})
ARCHIVED_ROLES = frozenset({"lead", "body", "gallery", "chart", "infographic"})
LEAST_BODY, GALLERY_IMAGES, QUOTE_REACH = 100, 3, 3

SCHEMA = (
    "struct<headline string, description string, published_at string, modified_at string, language string, canonical string,"
    " section string, authors array<string>, content_type string, status string, warnings array<string>, plain_text string, has_button boolean,"
    " blocks array<struct<position int, kind string, level int, text string, asset string>>,"
    " images array<struct<asset string, url string, role string, alt string, caption string, keep boolean>>>"
)
ARROW = pa.struct(
    [(n, pa.string()) for n in ("headline", "description", "published_at", "modified_at", "language", "canonical", "section")]
    + [("authors", pa.list_(pa.string())), ("content_type", pa.string()), ("status", pa.string()), ("warnings", pa.list_(pa.string())), ("plain_text", pa.string()), ("has_button", pa.bool_())]
    + [("blocks", pa.list_(pa.struct([("position", pa.int32()), ("kind", pa.string()), ("level", pa.int32()), ("text", pa.string()), ("asset", pa.string())])))]
    + [("images", pa.list_(pa.struct([("asset", pa.string()), ("url", pa.string()), ("role", pa.string()), ("alt", pa.string()), ("caption", pa.string()), ("keep", pa.bool_())])))]
)


@dataclass(frozen=True)
class Site:
    """A publisher's chrome and marks, as patterns; a user adds rows of the same form.

    drop: of elements, over "tag#id class data-testid"; texts: of whole blocks that go; tail: of a block that goes with
    all that follow; suffix: of text ends that aren't prose; cut: of the page's text where the article is cut off;
    cut_short: the same for articles under `short` characters; roadblock: of elements that stand where it is cut off;
    keep_buttons: whether text in buttons is prose; short_record: whether a single paragraph that the description
    repeats is a whole article."""

    drop: str = ""
    texts: tuple[str, ...] = ()
    tail: tuple[str, ...] = ()
    suffix: tuple[str, ...] = ()
    cut: tuple[str, ...] = ()
    cut_short: tuple[str, ...] = ()
    short: int = 1000
    roadblock: str = ""
    keep_buttons: bool = False
    short_record: bool = False


_SIGN_UP = r"sign up for (?:our|the|weekly updates on) .*(?:newsletter|from the times)"
SITES = {
    "bloomberg": Site(
        drop=r"terminal-tout|no-print|adblock|entry-tags|accordion.*ddop|relatedposttitle",
        texts=(r"related stor(?:y|ies)\b", r"read the full article at\s+https?://", r"disclaimer:\s*this page contains affiliate links", r"for more on .{1,120},\s*read this next", r"watch this next$", r"(?:~{3,}|-{3,})$", r"want to receive this post in your inbox", r"for even more: subscribe to", r"sign up to receive .*newsletter", r"subscribe to bloomberg benchmark"),
        suffix=(r"\s*\{\s*[A-Z0-9 ]{2,80}<\s*GO\s*>\s*\}\s*$", r"\s*For Related (?:News\s*(?:&|and)\s*)?Information\s*:.*$"),
        short_record=True,
    ),
    "reuters": Site(
        drop=r"rich-share|image_expand-button|slideshow_expand-button|pagination-v2__container|socialtools",
        texts=(r"read more:$", r"[_^]{3,}$", r"register now for free unlimited access to reuters\.com", r"the company and law firm names shown above are generated"),
        suffix=(r"\s*copyright(?:\s+(?:19|20)\d{2})?\s*,?\s*business\s+wire.*$", r"\s*copyright\s+\d{4},\s*market\s+wire,.*$", r"\s*\(c\)\s*reuters\s+(?:19|20)\d{2}\.\s*all\s+rights\s+reserved.*$", r"\s*(?:copyright|©)\s*(?:19|20)\d{2}[\s,.].{0,750}?all\s+rights\s+reserved\.?.*$"),
        keep_buttons=True,
    ),
    "nyt": Site(
        drop=r"^figure\S* (?:.* )?byline|comments-button|ad-slide-skip",
        texts=(r"supported by$", r"share full article$", r"subscriber support helps make times journalism", r"\(?want to get .*briefing by email\?", r"sign up here to get (?:this newsletter|the briefing)", r"if you are not a subscriber to this newsletter", r"browse our full range of times newsletters", r"the times is committed to publishing a diversity of letters", r"follow the new york times opinion section on", r"for newspaper delivery questions", r"_{2,}$", r"read more:?$", rf"\[?\s*(?:enjoying this article\?\s*)?{_SIGN_UP}", r"\(?this article is part of the .+ newsletter\."),
    ),
    "wsj": Site(
        drop=r"coupon-list|savingsunited|snippetsignin|author-links|author-info|mobile-modal-author|byline-wrap|article__byline|automated-news|editors-picks|share-bottom|printsummary|article-news-front|authoringcontainer|content-carousel|olympics-carousel|-jrstrap|-jrnextarticle|-jrmorearticles|theme-nav-wrapper",
        texts=(r"[.​﻿]$", r"copyright ©.*dow jones & company", r"already a member\? sign in", r"listen(?: to article)?$", r"\(\d+\s+min(?:ute)?s?\)$", r"buy side from wsj expert recommendations", r"to explore and search through all our recipes", r"[—-]for more wsj.*newsletter", r"stay informed$", r"get a coronavirus briefing.*sign up here", r"[_=—–-]+$", r"share your thoughts$"),
        tail=(r"to read the full story", r"already a subscriber\? log in"),
        cut=(r"to read the full story", r"continue reading your article with a wsj membership", r"subscribe to wsj to read the rest of this article"),
        roadblock=r"articleroadblock",
    ),
    "ft": Site(
        drop=r"article-info__byline|o-message__content-main|insidearticleshare|ftlabsaudioplayerholder|component-share__button|story-package",
        texts=(r"\.$", r"see acast\.com/privacy for privacy", r"recommended\s*\*", r"follow @financialtimesfashion on instagram", r"the ft is offering a free \d+-day trial", r"read more:$", r"stay briefed with our coronavirus newsletter", r"sign up to scoreboard"),
        tail=(r"promoted content$", r"follow the topics in this ", r"get alerts on .* when a new story is published$"),
        cut=(r"您已阅读.*剩余.*订阅以继续探索完整内容",),
    ),
    "nikkei": Site(cut=(r"会員限定です。電子版に登録すると続きをお読みいただけます。", r"残り\s*[\d,]+\s*文字"), cut_short=(r"この記事は会員限定です。登録すると続きをお読みいただけます。", r"有料登録すると続きをお読みいただけます。", r"(?:…|\.\.\.)\s*\Z"), short=2000),
    "ap": Site(texts=(r"\.$",)),
}
NO_SITE = Site()


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

    def text(self, skip: frozenset = SKIP) -> str:
        out, todo = [], [self]
        while todo:
            x = todo.pop()
            if isinstance(x, str):
                out.append(x)
            elif x.tag == "br":
                out.append(" ")
            elif x.tag not in skip:
                todo.extend(reversed(x.children))
        return clean("".join(out))

    def name(self) -> str:
        """What a site's patterns for elements see."""
        a = self.attrs
        return f"{self.tag}#{a.get('id', '')} {a.get('class', '')} {a.get('data-testid', '')}".lower()


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root", {}, None)

    def handle_starttag(self, tag, attrs):
        if tag in FLOW:
            p = self.at
            while p.tag in ("b", "i", "em", "strong", "span", "a"):
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


def tree(html: str) -> Node:
    t = _Tree()
    t.feed(html)
    t.close()
    return t.root


def linked_data(root: Node) -> Iterator[dict]:
    """The objects of the page's JSON-LD; scripts that aren't JSON are left out."""
    for node in root.walk():
        if node.tag == "script" and "ld+json" in node.attrs.get("type", ""):
            try:
                yield from objects(json.loads("".join(c for c in node.children if isinstance(c, str))))
            except (ValueError, RecursionError):
                continue


def linked_article(root: Node) -> dict:
    for x in linked_data(root):
        kinds = x.get("@type")
        if ARTICLE_TYPES & set(kinds if isinstance(kinds, list) else [kinds] if isinstance(kinds, str) else []):
            return x
    return {}


def _body(root: Node) -> Node | None:
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
    return root if any(n.tag in SELECTED for n in nodes) else None


def image_urls(node: Node, base: str) -> list[str]:
    """Addresses of an image, the widest of its source set first."""
    sized = []
    for part in re.split(r",\s+", node.attrs.get("srcset") or node.attrs.get("data-srcset") or ""):
        bits = part.split()
        if bits:
            n = re.match(r"[\d.]+", bits[1]) if len(bits) > 1 else None
            sized.append((-float(n[0]) if n else 0.0, len(sized), bits[0]))
    found = [u for _, _, u in sorted(sized)] + [node.attrs[k].strip() for k in ("src", "data-src", "data-original") if node.attrs.get(k)]
    out = []
    for u in found:
        try:
            full = urljoin(base, u)
        except ValueError:
            continue
        if full.startswith(("http://", "https://")):
            out.append(full)
    return list(dict.fromkeys(out))


#: Role of an image by what its classes, ids and address say, the first that matches.
IMAGE_ROLES = (
    ("tracking", r"pixel|tracking|spacer|transparent"),
    ("advertisement", r"advert|sponsor|promo"),
    ("recommendation", r"recommend|related"),
    ("avatar", r"avatar"),
    ("logo", r"logo"),
    ("icon", r"newsletter|subscribe|paywall|cookie|icon"),
)


def image_role(node: Node, container: Node, url: str) -> str:
    size = [int(x) if (x := node.attrs.get(k, "")).isdigit() else None for k in ("width", "height")]
    if None not in size and max(size) <= 2:
        return "tracking"
    context = f"{container.name()} {node.name()} {url}".lower()
    for role, pattern in IMAGE_ROLES:
        if re.search(pattern, context):
            return role
    if None not in size and max(size) <= 64:
        return "icon"
    return "infographic" if "infographic" in context else "chart" if re.search("chart|graphic|interactive", context) else "body"


class Extractor:
    """Blocks and images of an article's body, in document order."""

    def __init__(self, base: str, site: Site) -> None:
        self.base, self.site = base, site
        self.drop = re.compile(site.drop) if site.drop else None
        self.skip = SKIP - {"button"} if site.keep_buttons else SKIP
        self.blocks: list[dict] = []
        self.images: dict[str, dict] = {}

    def block(self, kind: str, text: str | None = None, level: int | None = None, asset: str | None = None) -> None:
        self.blocks.append({"kind": kind, "level": level, "text": text, "asset": asset})

    def image(self, node: Node, container: Node) -> None:
        found = image_urls(node, self.base)
        if not found:
            return
        asset = identity(found[0])
        if asset in self.images:
            return
        caption = next((n.text(self.skip) for n in container.walk() if n.tag == "figcaption" or "caption" in n.attrs.get("class", "").lower()), None)
        role = image_role(node, container, found[0])
        self.images[asset] = {"asset": asset, "url": found[0], "role": role, "alt": clean(node.attrs.get("alt", "")) or None, "caption": caption or None, "keep": role in ARCHIVED_ROLES}
        if role in ARCHIVED_ROLES:
            self.block("image", caption or None, asset=asset)

    def chrome(self, node: Node) -> bool:
        return node.tag in self.skip or bool(NOISE_CLASS.search(f"{node.attrs.get('class', '')} {node.attrs.get('id', '')}")) or bool(self.drop and self.drop.search(node.name()))

    def run(self, body: Node) -> None:
        todo = [body]
        while todo:
            node = todo.pop()
            if node is not body and self.chrome(node):
                continue
            tag = node.tag
            if node is not body and tag in SELECTED | {"img", "hr", "audio"}:
                if tag == "figure" and not any(n.tag == "img" for n in node.walk()):
                    pass  # a layout shell around prose
                elif tag == "p" and not node.text(self.skip) and any(n.tag in ("img", "iframe") for n in node.walk()):
                    pass  # a shell around media
                else:
                    self.take(node, tag)
                    continue
            todo.extend(c for c in reversed(node.children) if isinstance(c, Node))

    def take(self, node: Node, tag: str) -> None:
        if tag in ("p", "pre", "blockquote", "table") or tag[0] == "h" and tag[1:].isdigit():
            if text := node.text(self.skip):
                kind = {"p": "paragraph", "pre": "paragraph", "blockquote": "quote", "table": "table"}.get(tag, "heading")
                self.block(kind, text, int(tag[1]) if kind == "heading" else None)
        elif tag in ("ul", "ol"):
            items = [t for c in node.children if isinstance(c, Node) and c.tag == "li" and (t := c.text(self.skip))]
            if items:
                self.block("list", "\n".join(items))
        elif tag in ("figure", "img"):
            self.image(next(n for n in node.walk() if n.tag == "img"), node)
        elif tag == "hr":
            self.block("divider")
        else:
            source = node.attrs.get("src") or next((n.attrs.get("src") for n in node.walk() if n.tag == "source"), None)
            if source:
                self.block("embed", urljoin(self.base, source.strip()))

    def cleaned(self) -> list[dict]:
        """The blocks without chrome, repeated texts and contained quotes, numbered."""
        site, out = self.site, []
        for b in self.blocks:
            if b["kind"] in TEXT_KINDS:
                if any(re.match(p, b["text"], re.I) for p in site.tail):
                    break
                if b["text"].casefold() in NOISE_TEXT or any(re.match(p, b["text"], re.I) for p in site.texts):
                    continue
                for p in site.suffix:
                    b["text"] = re.sub(p, "", b["text"], flags=re.I | re.S)
                if not b["text"]:
                    continue
            out.append(b)
        seen: set[tuple] = set()
        once = []
        for b in out:
            key = (b["kind"] in TEXT_KINDS, clean(b["text"]).casefold() if b["text"] else "", b["asset"])
            if b["kind"] in TEXT_KINDS and key in seen:
                continue
            seen.add(key)
            once.append(b)
        kept = [b for i, b in enumerate(once) if not (b["kind"] == "quote" and any(o["kind"] == "paragraph" and b["text"].casefold() in o["text"].casefold() for o in once[max(0, i - QUOTE_REACH) : i + QUOTE_REACH + 1] if o is not b))]
        for k, b in enumerate(kept):
            b["position"] = k
        return kept


def content_type(kind: object, url: str, blocks: list[dict], images: list[dict]) -> str:
    """By the linked data's type, the address, and a gallery's shape: few texts, and captions that outweigh them."""
    u = url.casefold()
    if kind == "LiveBlogPosting" or re.search(r"/live(?:/|$)", u):
        return "liveblog"
    for mark, name in (("newsletter", "newsletter"), ("transcript", "transcript"), ("podcast", "audio"), ("opinion", "opinion"), ("video", "video"), ("/watching/", "interactive"), ("interactive", "interactive"), ("/features/", "interactive")):
        if mark in u:
            return name
    shown = [b for b in blocks if b["kind"] == "image"]
    texts = [b for b in blocks if b["kind"] in TEXT_KINDS]
    words, captions = (sum(len(b["text"] or "") for b in x) for x in (texts, shown))
    if shown and len(texts) <= 2 and (len(shown) >= GALLERY_IMAGES and words < LEAST_BODY or captions >= LEAST_BODY and captions >= words):
        return "gallery"
    return "article"


def _short_record(site: Site, blocks: list[dict], plain: str, description: str | None) -> bool:
    if not site.short_record or not description or not 80 <= len(plain) < 120 or sum(b["kind"] == "paragraph" for b in blocks) != 1:
        return False
    a, b = (set(re.findall("[a-z0-9]+", t.casefold())) for t in (description, plain))
    return len(a) >= 8 and len(a & b) >= 0.9 * len(a) and not plain.endswith(("...", "…"))


def _cut_off(site: Site, root: Node, plain: str) -> bool:
    if site.roadblock and any(re.search(site.roadblock, n.name()) for n in root.walk()):
        return True
    if not (site.cut or site.cut_short):
        return False
    page = root.text(frozenset({"script", "style"}))
    return any(re.search(p, page, re.I | re.S) for p in site.cut) or (0 < len(plain) < site.short and any(re.search(p, page, re.I) or re.search(p, plain) for p in site.cut_short))


def parse(html: str, url: str | None, publisher: str | None = None) -> dict:
    root, meta, canonical, title, language = tree(html), {}, None, None, None
    site = SITES.get(publisher or "", NO_SITE)
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
    found = Extractor(base, site)
    if body is not None:
        found.run(body)
    blocks = found.cleaned()
    if not any(b["kind"] == "paragraph" for b in blocks) and isinstance(data.get("articleBody"), str):
        extra = [clean(x) for x in re.split(r"\n+", data["articleBody"]) if x.strip()]
        blocks += [{"kind": "paragraph", "level": None, "text": x, "asset": None, "position": len(blocks) + k} for k, x in enumerate(extra)]
    shown = {b["asset"] for b in blocks if b["asset"]}
    images = [i for i in found.images.values() if not i["keep"] or i["asset"] in shown]
    if (lead := _first(data.get("image"), meta.get("og:image"))) and (lead := urljoin(base, lead)).startswith("http"):
        asset = identity(lead)
        same = next((i for i in images if i["asset"] == asset), None)
        if same:
            same["role"], same["keep"] = "lead", True
        else:
            images.insert(0, {"asset": asset, "url": lead, "role": "lead", "alt": None, "caption": None, "keep": True})
    h1 = next((n.text() for n in root.walk() if n.tag == "h1"), None)
    headline = _first(data.get("headline"), meta.get("og:title"), h1, title)
    description = _first(data.get("description"), meta.get("og:description"), meta.get("description"))
    published = _first(data.get("datePublished"), meta.get("article:published_time"))
    plain = "\n".join(b["text"] for b in blocks if b["kind"] in TEXT_KINDS and b["text"])
    authors = list({a.casefold(): a for a in reversed([*_strings(data.get("author")), *_strings(meta.get("author"))])}.values())[::-1]
    kind = content_type(data.get("@type"), url or "", blocks, images)
    short = len(plain) < LEAST_BODY and kind not in ("gallery", "video", "audio", "interactive") and not _short_record(site, blocks, plain, description)
    tests = (
        ("body-too-short", short),
        ("missing-headline", not headline),
        ("truncated-body", _cut_off(site, root, plain)),
        ("incomplete-gallery", kind == "gallery" and sum(i["keep"] for i in images) < GALLERY_IMAGES),
        ("missing-published-at", not published),
        ("article-body-not-found", not blocks),
    )
    warnings = [name for name, bad in tests if bad]
    partial = {"body-too-short", "missing-headline", "truncated-body", "incomplete-gallery"} & set(warnings)
    return {
        "headline": headline,
        "description": description,
        "published_at": published,
        "modified_at": _first(data.get("dateModified"), meta.get("article:modified_time")),
        "language": language or None,
        "canonical": urljoin(base, canonical) if canonical else None,
        "section": _first(data.get("articleSection"), meta.get("article:section")),
        "authors": authors,
        "content_type": kind,
        "status": "unsupported" if not blocks else "partial" if partial else "complete",
        "warnings": warnings,
        "plain_text": plain,
        "has_button": bool(body) and any(n.tag == "button" for n in body.walk()),
        "blocks": blocks,
        "images": images,
    }


def _article(html: pa.Array, url: pa.Array, publisher: pa.Array) -> pa.Array:
    return pa.array([None if h is None else parse(h, u, p) for h, u, p in zip(html.to_pylist(), url.to_pylist(), publisher.to_pylist())], ARROW)


def article(html: Column, url: Column, publisher: Column | None = None) -> Column:
    """Column of pages (and their addresses) to articles; null pages stay null.  publisher: whose rules of SITES hold."""
    return F.arrow_udf(_article, SCHEMA)(html, url, F.lit(None).cast("string") if publisher is None else publisher)


def _evidence(html: pa.Array) -> pa.Array:
    out = []
    for page in html.to_pylist():
        if page is None:
            out.append(None)
            continue
        root, best = tree(page), (0, 0)
        nodes = list(root.walk())
        marked = [n for n in nodes if {"article__content-body", "article-body"} & set(n.attrs.get("class", "").split())]
        marked = marked or [n for n in nodes if n.attrs.get("id") in ("article-body", "storyContent") or "article-body" in (n.attrs.get("data-trackable"), n.attrs.get("data-testid"))]
        for n in marked:
            best = max(best[0], len(n.text(frozenset()))), max(best[1], sum(x.tag == "img" and any(x.attrs.get(k) for k in ("src", "data-src", "srcset")) for x in n.walk()))
        told = [len(clean(x["articleBody"])) for x in linked_data(root) if isinstance(x.get("articleBody"), str)]
        out.append({"characters": max([best[0], *told]), "images": best[1]})
    return pa.array(out, pa.struct([("characters", pa.int32()), ("images", pa.int32())]))


def evidence(html: Column) -> Column:
    """struct(characters, images) of what pages mark as the article's body; null pages stay null."""
    return F.arrow_udf(_evidence, "struct<characters int, images int>")(html)


def _visible(html: pa.Array) -> pa.Array:
    return pa.array([None if h is None else tree(h).text(frozenset({"script", "style", "template"})) for h in html.to_pylist()], pa.string())


def visible_text(html: Column) -> Column:
    """All text of a page but scripts and styles."""
    return F.arrow_udf(_visible, "string")(html)

