"""Quality of a raw capture: a score of byte tests, and why it is rejected."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HTML_MARKS = ("<!doctype html", "<html", "<head", "<body")
ARTICLE_MARKS = ("<article", "newsarticle")
BODY_MARKS = ('"articlebody"', 'itemprop="articlebody"', "article-body", "story-body")
ERROR_MARKS = ("page cannot be displayed due to robots.txt", "hrm. the archive has not", "snapshot cannot be displayed", "this url has been excluded")
SHELLS = {
    "authentication": ("please sign in to continue", 'id="login-form"', "enter your password"),
    "challenge": ("verify you are human", "captcha-delivery", "enable javascript and cookies to continue"),
    "subscription": ("subscribe to continue reading", "already a subscriber?", "subscribe to unlock this article"),
    "redirect": ('http-equiv="refresh"', "window.location.replace("),
}
SUBSTANTIAL, TINY, LARGE, HALF = 2048, 512, 2_000_000, 1_000_000
NOISE_EXACT = ("advertisement", "share", "read more:", "0 min read", "promoted content", "related")
NOISE_STARTS = ("recommended *", "follow the topics in this ", "get alerts on ", "share on twitter")
NOISE_PARTS = ("sign up for our newsletter", "all rights reserved", "click here to subscribe")


def _any(text: Column, marks: tuple[str, ...]) -> Column:
    out = F.lit(False)
    for m in marks:
        out |= F.contains(text, F.lit(m))
    return out


def signals(html: Column, status: Column, content_type: Column, url: Column) -> Column:
    """struct of the tests.  Sizes are in bytes; of pages over 2 MB the first and last MB are tested."""
    n = F.octet_length(html)
    seen = F.lower(F.when(n <= LARGE, html).otherwise(F.concat(F.substring(html, 1, HALF), F.substring(html, -HALF, HALF))))
    looks = F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("html")) | _any(seen, HTML_MARKS)
    article, body = _any(seen, ARTICLE_MARKS), _any(seen, BODY_MARKS)
    login = F.lower(F.coalesce(url, F.lit(""))).rlike(r"/(?:auth/login|account/login|sign-?in)(?:[/?#]|$)")
    return F.struct(
        F.coalesce(status.isin(200, 203, 206), F.lit(False)).alias("accepted"),
        looks.alias("looks_html"),
        (n >= SUBSTANTIAL).alias("substantial"),
        article.alias("article_mark"),
        body.alias("body_mark"),
        _any(seen, ERROR_MARKS).alias("archive_error"),
        (~article & (_any(seen, SHELLS["authentication"]) | login)).alias("authentication"),
        (~article & _any(seen, SHELLS["challenge"])).alias("challenge"),
        (~body & _any(seen, SHELLS["subscription"])).alias("subscription"),
        (~body & _any(seen, SHELLS["redirect"])).alias("redirect"),
        (looks & (n < TINY) & ~article & ~body).alias("tiny"),
        n.cast("bigint").alias("bytes"),
    )


SHELL_NAMES = ("authentication", "challenge", "subscription", "redirect", "tiny")


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


def image_type(content: Column) -> Column:
    """Media type by magic bytes."""
    magic = [("FFD8FF", "image/jpeg"), ("89504E470D0A1A0A", "image/png"), ("474946383761", "image/gif"), ("474946383961", "image/gif")]
    out = F.when((F.hex(F.substring(content, 1, 4)) == "52494646") & (F.hex(F.substring(content, 9, 4)) == "57454250"), "image/webp")
    for code, name in magic:
        out = out.when(F.hex(F.substring(content, 1, len(code) // 2)) == code, name)
    return out.when(F.hex(F.substring(content, 5, 8)) == "6674797061766966", "image/avif")


def is_noise(block: Column) -> Column:
    """Interface text rather than prose; block is normalised to lower case."""
    out = block.isin(*NOISE_EXACT) | block.rlike("^_{2,}$")
    for s in NOISE_STARTS:
        out |= block.startswith(s)
    for s in NOISE_PARTS:
        out |= F.contains(block, F.lit(s))
    return out


def response_verdict(status: Column, url: Column, html: Column) -> Column:
    """struct(blocked, available, reason) of one fetched page."""
    s = signals(html, status, F.lit("text/html"), url)
    reason = F.when(status.isin(401, 403, 429), "blocked").when(status == 404, "missing").when(s["challenge"], "challenge").when(s["archive_error"], "archive-error").when(s["accepted"] & s["looks_html"], "available").otherwise("unusable")
    return F.struct(reason.isin("blocked", "challenge").alias("blocked"), (reason == "available").alias("available"), reason.alias("reason"))


def document_rejection(d: Column, year: Column, host: str, least_title: int = 4, least_length: int = 400, language: str = "en") -> Column:
    """Why a corpus document (struct of url, hostname, date, title, length, language, source) isn't taken, the
    first reason; null where it is.  The order of the gates is part of the result."""
    from tidemark.functions import urls

    words = F.size(F.regexp_extract_all(F.lower(F.coalesce(d["title"], F.lit(""))), F.lit("([a-z0-9]+)"), 1))
    return (
        F.when(d["url"].isNull() | (F.coalesce(urls.host(d["url"]), F.lit("")) != host), "other-host")
        .when(F.regexp_replace(F.lower(F.coalesce(d["hostname"], F.lit(""))), r"^www\.", "") != urls.host(d["url"]), "host-differs")
        .when(~F.coalesce(F.substring(d["date"], 1, 4) == year.cast("string"), F.lit(False)), "other-year")
        .when(words < least_title, "short-title")
        .when(F.coalesce(d["length"], F.lit(0)) < least_length, "short-text")
        .when(~F.coalesce(d["language"] == language, F.lit(False)), "other-language")
        .when(F.coalesce(d["source"], F.lit("")) == "", "no-source")
    )


def body_evidence(article: Column) -> Column:
    """struct(characters, images, paragraphs) of a parsed article."""
    return F.struct(F.char_length(article["plain_text"]).alias("characters"), F.size(F.filter(article["images"], lambda i: i["keep"])).alias("images"), F.size(F.filter(article["blocks"], lambda b: b["kind"] == "paragraph")).alias("paragraphs"))


def thin(article: Column, least: int = 400, gallery: int = 3) -> Column:
    """Too little text for an article, and too few images for a gallery."""
    e = body_evidence(article)
    return (e["characters"] < least) & (e["images"] < gallery)


def paywalled(plain: Column, most: int = 1000) -> Column:
    """A short text that asks for a subscription."""
    return (F.char_length(plain) < most) & F.lower(plain).rlike(r"subscribe to (?:continue|read|unlock)|already a subscriber|sign in to read")


def rescued(s: Column, article: Column) -> Column:
    """A subscription shell around an article that is there in full is usable."""
    return s["subscription"] & (article["status"] == "complete") & ~paywalled(article["plain_text"])


def is_notice(headline: Column, plain: Column) -> Column:
    """A notice of the publisher rather than an article."""
    return F.lower(F.concat_ws(" ", headline, F.substring(plain, 1, 300))).rlike(r"^(?:correction|clarification|editor'?s note|for the record)\b|this (?:story|article) (?:has been|was) (?:removed|withdrawn|retracted)")


def noise_sequence(blocks: Column, phrases: tuple[str, ...], reach: int = 3) -> Column:
    """Whether up to `reach` consecutive blocks together hold one of the phrases."""
    joined = F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size(blocks))), lambda i: F.array_join(F.slice(blocks, i, F.lit(reach)), " "))
    return F.exists(joined, lambda t: _any(t, phrases))


def placeholder_image(url: Column) -> Column:
    return F.lower(F.coalesce(F.try_url_decode(url), url)).rlike(r"placeholder|blank\.|spacer|1x1|transparent|default[-_]?(?:image|share)|lazy[-_]?load")


def fallbacks(attempts: Column, validating: Column) -> Column:
    """struct of the archives that are worth asking after so many attempts."""
    return F.struct((attempts >= 1).alias("timemap"), ((attempts >= 1) | validating).alias("index"), (attempts >= 2).alias("mirrors"))


def article_violations(a: Column) -> Column:
    """Broken rules of an article struct: image blocks name an image that is there, positions count up from
    0, an image is kept exactly if its role is."""
    assets = F.transform(a["images"], lambda i: i["asset"])
    lost = F.exists(a["blocks"], lambda b: b["asset"].isNotNull() & ~F.array_contains(assets, b["asset"]))
    order = F.transform(a["blocks"], lambda b: b["position"]) != F.when(F.size(a["blocks"]) > 0, F.sequence(F.lit(0), F.size(a["blocks"]) - 1)).otherwise(F.array().cast("array<int>"))
    roles = F.exists(a["images"], lambda i: i["keep"] != i["role"].isin("lead", "body", "gallery"))
    return F.array_compact(F.array(F.when(lost, "unknown-image"), F.when(order, "positions"), F.when(roles, "image-role")))
