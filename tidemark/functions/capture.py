"""Quality of a news capture by its publisher's marks (`functions.quality` has the generic ones), and of its article."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.quality import ARTICLE_MARKS, _any, is_noise

HTML_MARKS = ("<!doctype html", "<html", "<article", "application/ld+json")
BODY_MARKS = ("story-body", "article__content-body", 'id="storycontent"', 'id="article-body"', 'data-testid="article-body"', 'data-trackable="article-body"', '"articlebody"')
ERROR_MARKS = ("class='missing-404'", 'class="missing-404"', "cannot be crawled or displayed due to robots.txt", "this url has been excluded from the wayback machine", "wayback machine doesn't have that page archived")
SERVER_MARKS = ("<h1>welcome to nginx!</h1>", "<title>iis windows server</title>", "<title>welcome to nginx!</title>", "<title>apache2 ubuntu default page", "<title>apache http server test page", "<title>test page for the nginx http server")
SHELLS = {
    "authentication": ("sign in to continue", "log in to continue", "/auth/login?", "/lire_ui/", 'id="myaccountauth"', "<title>sign in - ", "<title>log in - ", 'sourceapp" content="nyt-lire"'),
    "challenge": ("verify you are human", "are you a robot?", "<title>client challenge</title>", "distil_r_captcha", 'id="distil_ident_block"', "we've detected unusual activity", "terms of service violation", "javascript is disabled in your browser", "a required part of this site couldn", "checking if the site connection is secure"),
    "subscription": (
        "subscribe to unlock this article", "to read the full story, subscribe or sign in", "barrier-grid__article-title", 'id="barrier-page"', 'class="wsj-snippet-login"', "window.zephr.outcomes['paywall']", "<title>try ft for free", "<title>register to read",
        "<title>subscribe to read", "<title>subscribe to a slice of the ft", "<title>become an ft subscriber to read", "join over 300,000 finance professionals", "discover all the plans currently available in your country", "during your trial you will have complete digital access to ft.com",
    ),
    "redirect": ("window.location=fullurl", "window.location = fullurl", "<title>ny times advertisement</title>"),
}
#: Texts that are a subscription shell only together.
SUBSCRIPTION_SETS = (("continue reading", "wsj subscription", "already a subscriber"), ("already a subscriber", "log in to keep reading", "bloomberg"))
SNIPPET_MARK = '"issnippetview":true'
CUT_NOTICE = ("您已阅读", "剩余", "订阅以继续探索完整内容")
LOGIN_PATH = r"/auth/(?:login|enter-email)|/account/login|/glogin|/sign-?in"
CHALLENGE_PATH = r"/access-error/|/tosv2\.html"
BARRIER_URL = r"authorised=false|iab=barrier-app|classification=conditional_standard"
EMPTY_ARTICLE = (r'"headline"\s*:\s*""', r'"datepublished"\s*:\s*""', r'"url"\s*:\s*"https?://(?:www\.)?wsj\.com/articles/"')
ACCEPTED = (200, 206)
SUBSTANTIAL, TINY, PLACEHOLDER, LARGE, HALF = 2048, 512, 100_000, 2_000_000, 1_000_000
LEAST_EVIDENCE, LEAST_IMAGES = 100, 3


def _all(text: Column, marks: tuple[str, ...]) -> Column:
    out = F.lit(True)
    for m in marks:
        out &= F.contains(text, F.lit(m))
    return out


def signals(html: Column, status: Column, content_type: Column, url: Column, evidence: Column | None = None) -> Column:
    """struct of the tests.  Sizes are in bytes.  Of pages over 2 MB the first and the last million bytes are tested, as
    the scores that are to be matched do.  evidence: `functions.articles.evidence` of the page, where pages of the paper
    whose bodies are cut are to be told by their length."""
    raw = html.cast("binary")
    n = F.octet_length(html)
    text = lambda b: F.decode(b, "UTF-8")
    seen = F.lower(F.when(n <= LARGE, html).otherwise(F.concat(text(F.substring(raw, 1, HALF)), text(F.substring(raw, -HALF, HALF)))))
    at = F.lower(F.coalesce(url, F.lit("")))
    plain = F.coalesce(F.try_url_decode(at), at)
    looks = F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("html")) | _any(seen, HTML_MARKS)
    article, body = _any(seen, ARTICLE_MARKS), _any(seen, BODY_MARKS)
    cut = _all(seen, CUT_NOTICE)
    if evidence is not None:
        paper = plain.rlike(r"https?://(?:[^/?#]+\.)?ft\.com(?:[/?#]|$)") & F.contains(plain, F.lit("/content/"))
        cut |= paper & article & body & F.coalesce((evidence["characters"] < LEAST_EVIDENCE) & (evidence["images"] < LEAST_IMAGES), F.lit(False))
    subscription = F.contains(seen, F.lit(SNIPPET_MARK))
    empty = F.lit(True)
    for pattern in EMPTY_ARTICLE:
        empty &= seen.rlike(pattern)
    walled = plain.rlike(BARRIER_URL) | _any(seen, SHELLS["subscription"])
    for marks in SUBSCRIPTION_SETS:
        walled |= _all(seen, marks)
    teaser = F.contains(plain, F.lit("bloomberg.com/")) & (F.contains(seen, F.lit("teaser-body__")) | _all(seen, ("body-content", "teaser-content__")))
    return F.struct(
        F.coalesce(status.isin(*ACCEPTED), F.lit(False)).alias("accepted"),
        looks.alias("looks_html"),
        (n >= SUBSTANTIAL).alias("substantial"),
        article.alias("article_mark"),
        body.alias("body_mark"),
        _any(seen, ERROR_MARKS).alias("archive_error"),
        (~article & (_any(seen, SHELLS["authentication"]) | at.rlike(LOGIN_PATH))).alias("authentication"),
        (~article & (_any(seen, SHELLS["challenge"]) | at.rlike(CHALLENGE_PATH))).alias("challenge"),
        (subscription | empty | (~body & walled)).alias("subscription"),
        (~body & _any(seen, SHELLS["redirect"])).alias("redirect"),
        cut.alias("truncated"),
        teaser.alias("teaser"),
        ((n <= PLACEHOLDER) & _any(seen, SERVER_MARKS)).alias("placeholder"),
        (looks & (n < TINY) & ~article & ~body).alias("tiny"),
        n.cast("bigint").alias("bytes"),
    )


SHELL_NAMES = ("authentication", "challenge", "subscription", "redirect", "truncated", "teaser", "placeholder", "tiny")


def score(s: Column) -> Column:
    """0 to 100: status 35, html 25, size 15, article mark 15, no error page 10; a shell costs 60."""
    points = F.lit(0)
    for name, n in (("accepted", 35), ("looks_html", 25), ("substantial", 15), ("article_mark", 15)):
        points += F.when(s[name], n).otherwise(0)
    points += F.when(s["archive_error"], 0).otherwise(10)
    shell = F.lit(False)
    for name in SHELL_NAMES:
        shell |= s[name]
    return F.when(shell, F.greatest(F.lit(0), points - 60)).otherwise(points).cast("int")


def rejections(s: Column) -> Column:
    """Every failed test by name, in order."""
    tests = [(~s["accepted"], "http-status"), (~s["looks_html"], "not-html"), (s["archive_error"], "archive-error"), *((s[n], f"{n}-shell") for n in SHELL_NAMES), (~s["article_mark"] & ~s["body_mark"], "no-article-mark")]
    return F.array_compact(F.array(*(F.when(c, name) for c, name in tests)))


def first_rejection(s: Column) -> Column:
    return F.try_element_at(rejections(s), F.lit(1))


def response_verdict(status: Column, url: Column, html: Column) -> Column:
    """struct(blocked, available, reason) of one fetched page."""
    s = signals(html, status, F.lit("text/html"), url)
    reason = F.when(status.isin(401, 403, 429), "blocked").when(status == 404, "missing").when(s["challenge"], "challenge").when(s["archive_error"], "archive-error").when(s["accepted"] & s["looks_html"], "available").otherwise("unusable")
    return F.struct(reason.isin("blocked", "challenge").alias("blocked"), (reason == "available").alias("available"), reason.alias("reason"))


NOTICE = r"\barticle was published in error\b|\binadvertently published on this page\b|\b(?:article|feature) (?:has been|was) removed because of a copyright dispute\b"


def is_notice(headline: Column, plain: Column, description: Column | None = None) -> Column:
    """Whether headline, description or any of the text says that the publisher withdrew the article."""
    parts = [headline, plain] if description is None else [headline, description, plain]
    return F.lower(F.concat_ws(" ", *parts)).rlike(NOTICE)


#: Interface texts by publisher: patterns of one block, and blocks that are only noise together.
PUBLISHER_NOISE = {
    "ap": ((r"^\.$",), ()),
    "bloomberg": ((r"^watch this next$", r"^related stories:*$", r"^sign up to receive the brexit bulletin.*departure from the eu", r"^subscribe to bloomberg benchmark.*(?:pocketcast|itunes)", r"sign up to receive.*green daily.*newsletter", r"^for even more: subscribe to bloomberg all access", r"^want to receive this post in your inbox.*sign up for.*newsletter"), ()),
    "ft": ((r"stay briefed with our coronavirus newsletter", r"^\.$", r"^sign up to scoreboard.*must-read weekly briefing"), ()),
    "nyt": ((r"^sign up for weekly updates on .* from the times\.$",), ()),
    "reuters": ((r"all rights reserved.*(?:copyright|\(c\) reuters|market ?wire|business wire)", r"(?:copyright|\(c\) reuters|market ?wire|business wire).*all rights reserved", r"republication or redistribution ofreuters content"), ()),
    "wsj": ((r"^buy side from wsj expert recommendations on products and services", r"sign up for our.*newsletter"), (("free resources", "live updates", "daily video briefing"),)),
}


def publisher_noise(publisher: Column, blocks: Column) -> Column:
    """Whether normalised blocks hold interface texts of their publisher."""
    out = F.lit(False)
    for name, (patterns, sets) in PUBLISHER_NOISE.items():
        hit = F.exists(blocks, lambda b, p="|".join(f"(?:{x})" for x in patterns): b.rlike(f"(?s){p}"))
        for texts in sets:
            hit |= F.size(F.array_intersect(blocks, F.array(*map(F.lit, texts)))) == len(texts)
        if name == "wsj":
            near = lambda i: F.array_join(F.slice(blocks, i + 1, F.lit(3)), " ")
            hit |= F.exists(F.transform(blocks, lambda b, i: (b == "stay informed") & F.contains(near(i), F.lit("get a coronavirus briefing")) & F.contains(near(i), F.lit("sign up here"))), lambda x: x)
        out = F.when(publisher == name, hit).otherwise(out)
    return F.coalesce(out, F.lit(False))


NONTEXT = ("interactive", "video", "audio", "gallery")
CONTROL_PUBLISHERS = ("ap", "bloomberg", "nyt", "wsj")
PLACEHOLDER_IMAGES = ("social-default", "og-ft-logo", "r-generic-hdr.png", "rcom-default.png", "wsj-social-share", "wsj_logo_black_social", "wsj_profile_lg", "wsjsection.")
PAYWALL_PHRASES = ("already a subscriber", "subscribe to read", "subscribe to continue", "sign in to continue", "unlock this article", "bloomberg professional service subscriber")


def paywall_shell(characters: Column, plain: Column) -> Column:
    """A short text whose beginning asks for a subscription."""
    return (characters < 1000) & _any(F.lower(F.substring(plain, 1, 1500)), PAYWALL_PHRASES)


def issues(a: Column, publisher: Column, captured: Column, address: Column) -> Column:
    """What is wrong with a parsed article (struct of `functions.articles.SCHEMA`), by name and in order; a null article
    couldn't be parsed.  captured: the capture's address; address: the one that the parser gave the article."""
    texts = F.filter(F.transform(a["blocks"], lambda b: F.trim(F.regexp_replace(F.coalesce(b["text"], F.lit("")), r"\s+", " "))), lambda t: t != "")
    low = F.transform(texts, F.lower)
    told = F.lower(F.trim(F.regexp_replace(a["description"], r"\s+", " ")))
    noise = F.exists(low, is_noise) | publisher_noise(publisher, F.array_compact(F.array_append(low, told)))
    controls = publisher.isin(*CONTROL_PUBLISHERS) & (a["content_type"] == "article") & a["has_button"]
    blank = F.exists(a["images"], lambda i: i["keep"] & _any(F.lower(i["url"]), PLACEHOLDER_IMAGES))
    tests = (
        ((a["status"] != "complete") & ~a["content_type"].isin(*NONTEXT), F.concat(F.lit("extraction-"), a["status"])),
        (F.coalesce(a["headline"], F.lit("")) == "", F.lit("missing-headline")),
        (a["published_at"].isNull(), F.lit("missing-published-at")),
        (~address.eqNullSafe(captured), F.lit("source-link-mismatch")),
        (F.size(texts) > F.size(F.array_distinct(texts)), F.lit("duplicate-text-blocks")),
        (noise, F.lit("interface-noise-in-body")),
        (controls, F.lit("interactive-control-in-body")),
        (blank, F.lit("selected-placeholder-image")),
        (paywall_shell(F.char_length(a["plain_text"]), a["plain_text"]), F.lit("suspected-paywall-shell")),
    )
    return F.when(a.isNull(), F.array(F.lit("parser-exception"))).otherwise(F.array_compact(F.array(*(F.when(F.coalesce(bad, F.lit(False)), name) for bad, name in tests))))


def article_violations(a: Column) -> Column:
    """Broken rules of an article struct: image blocks name an image that is there, positions count up from
    0, an image is kept exactly if its role is."""
    assets = F.transform(a["images"], lambda i: i["asset"])
    lost = F.exists(a["blocks"], lambda b: b["asset"].isNotNull() & ~F.array_contains(assets, b["asset"]))
    order = F.transform(a["blocks"], lambda b: b["position"]) != F.when(F.size(a["blocks"]) > 0, F.sequence(F.lit(0), F.size(a["blocks"]) - 1)).otherwise(F.array().cast("array<int>"))
    roles = F.exists(a["images"], lambda i: i["keep"] != i["role"].isin("lead", "body", "gallery", "chart", "infographic"))
    return F.array_compact(F.array(F.when(lost, "unknown-image"), F.when(order, "positions"), F.when(roles, "image-role")))
