"""Verdicts on fetched copies of an article, by source: rules as data.

`judge` takes one row a copy: source, status, characters, plain, visible, raw, headline, authors (one text), parsed_on and
expected_on (dates), canonical, final_url, expected_headline, description, keywords, source_authors, expected_url.  A rule
is a list of gates; the first that fails names the reason, and a copy that passes all of them is valid.  All in columns.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import capture, dates, text, urls

REPLAY = r"(?i)^https?://web\.archive\.org/web/\d{14}(?:id_|im_|js_|cs_)?/(https?://.+)$"


@dataclass(frozen=True)
class Rule:
    """gates in order; name is what missing attributions are called after.

    least: characters of the body; overlap: of the headlines; attribution: a pattern, looked for in the authors and in
    `where` ("ends" of the plain text, "visible" or its first `reach` characters); licence: a pattern that copies with
    a longer date window have; window, licensed: days."""

    name: str
    gates: tuple[str, ...]
    least: int = 400
    overlap: float = 0.8
    attribution: str = ""
    where: str = "visible"
    reach: int = 0
    copyright: str = ""
    hosts: tuple[str, ...] = ()
    licence: str = ""
    window: int = 2
    licensed: int = 2


_FT_RIGHTS = r"(?i)(?:copyright|©|\(c\))\s*(?:20\d{2}\s+)?(?:the\s+)?financial\s+times\s+(?:limited|ltd\.?)(?:\s+20\d{2})?"
_FT_LICENCE = r"(?i)(?:this(?:\s+financial\s+times)?|financial\s+times)\s+article\s+was\s+legally\s+licensed\s+(?:by|through)\s+advisorstream"
_BLOOMBERG_RIGHTS = r"(?i)(?:©|\(c\)|copyright)\s*YEAR\s+bloomberg\s+l\.p\."
RULES = {
    "ap": Rule("ap", ("complete", "body", "source", "ap-headline", "attribution", "ap-date"), attribution=r"(?i:(?:^|\W)(?:the\s+)?associated\s+press(?:\W|$))|(?:^|\W)AP(?:\W|$)", overlap=0.55),
    "reuters": Rule("reuters", ("complete", "body", "attribution", "dated-headline"), attribution=r"(?i)(?:^|\W)reuters(?:\W|$)", where="ends", overlap=0.6),
    "bloomberg": Rule("bloomberg", ("complete", "body", "paywall", "attribution", "slug-headline", "date"), attribution=r"(?i)(?:^|\W)bloomberg(?:\s+(?:news|opinion))?(?:\W|$)", reach=10_000, overlap=0.75),
    "bloomberg-bnn": Rule("bloomberg", ("bnn-url", "expected", "complete", "body", "attribution", "copyright", "provenance", "headline", "date"), attribution=r"(?i)(?:^|\W)bloomberg(?:\s+news)?(?:\W|$)", reach=5_000, copyright=_BLOOMBERG_RIGHTS, hosts=("bnnbloomberg.ca",)),
    "bloomberg-partner": Rule("bloomberg", ("partner-archive", "complete", "body", "attribution", "copyright", "headline", "date"), attribution=r"(?i)(?:^|\W)bloomberg(?:\s+news)?(?:\W|$)", reach=5_000, copyright=_BLOOMBERG_RIGHTS),
    "nyt": Rule("nyt", ("complete", "body", "attribution", "linked", "linked-headline", "date"), least=1000, attribution=r"(?i)(?:the\s+)?new\s+york\s+times|(?:^|\W)NYT(?:\W|$)", reach=30_000, overlap=0.75),
    "wsj": Rule("wsj", ("partner-path", "expected", "complete", "body", "attribution", "headline", "date"), attribution=r"(?i:(?:the\s+)?wall\s+street\s+journal)|(?:^|\W)(?i:WSJ)(?:\W|$)", reach=30_000, hosts=("tovima.com",)),
    "ft": Rule("ft", ("partner-host", "expected", "complete", "body", "copyright", "headline", "near-date"), copyright=_FT_RIGHTS, licence=_FT_LICENCE, licensed=14, hosts=("ft.com",)),
    "wsj-origin": Rule("wsj", ("origin", "expected", "complete", "body", "headline", "date"), least=1000, hosts=("wsj.com", "online.wsj.com")),
    "ft-origin": Rule("ft", ("origin", "expected", "complete", "body", "headline", "date"), least=1000, hosts=("ft.com",)),
    "ft-ghost": Rule("ft", ("origin", "complete", "body", "any-headline", "date"), least=1000, hosts=("ft.com",)),
}


def partner_url(final_url: Column) -> Column:
    """The address that a replay shows; '' for other addresses."""
    inner = F.regexp_extract(final_url, REPLAY, 1)
    return F.coalesce(F.try_url_decode(inner), inner)


def mirrored_slug(partner: Column, canonical: Column) -> Column:
    """Whether a partner's dated path is the canonical one under another name."""
    shape = r"(?i)^https?://(?:www\.)?bnnbloomberg\.ca/bloomberg/(20\d{2})/(\d{2})/(\d{2})/([a-z0-9][a-z0-9-]*)/?(?:[?#].*)?$"
    part = [F.regexp_extract(partner, shape, k) for k in (1, 2, 3, 4)]
    want = F.concat(F.lit("/news/articles/"), F.concat_ws("-", *part[:3]), F.lit("/"), part[3])
    return F.coalesce((part[0] != "") & urls.host(canonical).isin("bloomberg.com") & (F.lower(F.regexp_replace(urls.path(canonical), "/+$", "")) == F.lower(want)), F.lit(False))


def _share(a: Column, b: Column) -> Column:
    return text.overlap(text.tokens(a, "capture"), text.tokens(b, "capture"), "least")


def _slug(canonical: Column) -> Column:
    last = F.regexp_extract(F.regexp_replace(urls.path(canonical), "/+$", ""), "[^/]*$", 0)
    return F.regexp_replace(last, "-", " ")


def evidence(rows: DataFrame) -> DataFrame:
    """rows with what several gates look at: days, day_shown, overlap, slug_overlap, partner, linked."""
    c = F.col
    overlap = F.when(c("expected_headline").isNotNull() & (c("expected_headline") != ""), _share(c("expected_headline"), c("headline"))).otherwise(0.0)
    raw = F.lower(F.regexp_replace(F.coalesce("raw", F.lit("")), r"\\/", "/"))
    return rows.withColumns(
        {
            "days": F.abs(F.datediff("parsed_on", "expected_on")),
            "day_shown": dates.date_visible(F.concat_ws("\n", "raw", "visible"), c("expected_on")),
            "overlap": overlap,
            "slug_overlap": _share(F.regexp_replace(_slug(c("canonical")), r" 20\d{2} \d{2} \d{2}$", ""), c("headline")),
            "partner": partner_url(c("final_url")),
            "linked": F.contains(raw, F.lower(F.regexp_replace("canonical", "/+$", ""))),
        }
    )


def gate(name: str, rule: Rule) -> tuple[Column, Column]:
    """(holds, the reason where it doesn't)."""
    c, is_ = F.col, lambda x: F.coalesce(x, F.lit(False))
    host = lambda x: F.coalesce(urls.host(x), F.lit(""))
    missing = lambda x: F.lit(f"missing-{rule.name}-{x}")
    on_date = is_(c("days") <= rule.window) | c("day_shown")
    head = F.lit("headline-mismatch")
    authors, visible, plain = (F.coalesce(x, F.lit("")) for x in ("authors", "visible", "plain"))
    if name == "complete":
        return c("status") == "complete", F.concat(F.lit("parser-"), "status")
    if name == "body":
        return c("characters") >= rule.least, F.lit("body-too-short")
    if name == "paywall":
        return ~capture.paywall_shell(c("characters"), plain), F.lit("suspected-paywall-shell")
    if name == "attribution":
        seen = [authors, F.substring(plain, 1, 1000), F.substring(plain, -1000, 1000)] if rule.where == "ends" else [authors, F.substring(visible, 1, rule.reach) if rule.reach else visible]
        return F.concat_ws("\n", *seen).rlike(rule.attribution), missing("attribution")
    if name == "copyright":
        if "YEAR" in rule.copyright:
            before, after = rule.copyright.split("YEAR")
            return is_(F.expr("regexp(coalesce(visible, ''), concat({}, cast(year(expected_on) AS string), {}))".format(*(f"r'{x}'" for x in (before, after))))), missing("copyright")
        return visible.rlike(rule.copyright), missing("copyright")
    if name == "provenance":
        return c("linked") | mirrored_slug(c("partner"), c("canonical")), F.lit("missing-original-url-provenance")
    if name in ("expected", "linked"):
        told = F.coalesce("expected_headline", F.lit("")) != ""
        return told | c("linked") if name == "linked" else told, F.lit("missing-original-headline")
    if name == "headline":
        return c("overlap") >= rule.overlap, head
    if name == "slug-headline":
        return c("slug_overlap") >= rule.overlap, head
    if name == "dated-headline":
        best = F.greatest("overlap", "slug_overlap")
        return (best >= rule.overlap) | (is_(c("days") <= rule.window) & (best >= 0.35)), head
    if name == "ap-headline":
        return (F.coalesce("expected_headline", F.lit("")) == "") | (c("overlap") >= rule.overlap), head
    if name == "linked-headline":
        told = F.coalesce("expected_headline", F.lit("")) != ""
        return F.when(told, c("overlap") >= rule.overlap).otherwise(c("linked")), head
    if name == "any-headline":
        enough = F.size(text.tokens(F.coalesce("headline", F.lit("")), "capture")) >= 4
        return enough & ((F.coalesce("expected_headline", F.lit("")) == "") | (c("overlap") >= rule.overlap)), head
    if name == "date":
        return on_date, F.lit("publication-date-mismatch")
    if name == "ap-date":
        return c("days").isNull() | (c("days") <= rule.window), F.lit("date-mismatch")
    if name == "near-date":
        gap = F.least("days", dates.visible_date_gap(visible, c("expected_on")))
        return is_(gap <= F.when(visible.rlike(rule.licence), rule.licensed).otherwise(rule.window)) | c("day_shown"), F.lit("publication-date-mismatch")
    if name == "source":
        told, body = (F.lower(F.regexp_replace(F.coalesce(x, F.lit("")), r"\s+", " ")) for x in ("description", "plain"))
        tokens = text.tokens(body, "capture")
        said = (told != "") & (F.contains(body, told) | (text.overlap(text.tokens(told, "capture"), tokens, "first") >= 0.75))
        words = text.tokens(F.array_join(F.coalesce("keywords", F.array().cast("array<string>")), " "), "capture")
        n = text.shared(words, tokens)
        share = F.when(F.size(words) > 0, F.least(F.lit(1.0), n / F.least(F.lit(12), F.size(words)))).otherwise(0.0)
        by = F.exists(F.coalesce("source_authors", F.array().cast("array<string>")), lambda a: (F.length(F.trim(a)) >= 4) & F.contains(F.lower(F.concat_ws("\n", authors, visible)), F.lower(a)))
        meta = (told == "") & (F.coalesce("expected_headline", F.lit("")) != "") & is_(c("days") <= rule.window) & (n >= 6) & (share >= 0.5) & (by | (n >= 8))
        return said | meta, F.when(told == "", "metadata-mismatch").otherwise("description-mismatch")
    if name == "bnn-url":
        return host(c("partner")).isin(*rule.hosts), F.lit("unexpected-bnn-archive-url")
    if name == "partner-archive":
        return (host(c("partner")) != "") & (host(c("partner")) != "bloomberg.com"), F.lit("unexpected-partner-archive-url")
    if name == "partner-path":
        return c("final_url").startswith("https:") & host(c("final_url")).isin(*rule.hosts) & urls.path(c("final_url")).startswith("/wsj/"), F.lit("unexpected-partner-url")
    if name == "partner-host":
        want = host(c("expected_url"))
        return (want != "") & (host(c("final_url")) == want) & ~want.isin(*rule.hosts), F.lit("unexpected-partner-url")
    if name == "origin":
        key = urls.match_key
        same = host(c("canonical")).isin(*rule.hosts) & host(c("final_url")).isin(*rule.hosts) & (key(c("final_url")) == key(c("canonical")))
        return same & ((F.coalesce("expected_url", F.lit("")) == "") | (key(c("expected_url")) == key(c("canonical")))), F.lit("unexpected-origin-url")
    raise ValueError(name)


def reason(source: str) -> Column:
    """Why a copy of this source isn't the article, the first gate that fails; null where all hold.  Over `evidence`."""
    rule, out = RULES[source], F.lit(None).cast("string")
    for name in reversed(rule.gates):
        holds, why = gate(name, rule)
        out = F.when(~F.coalesce(holds, F.lit(False)), why).otherwise(out)
    return out


def judge(rows: DataFrame) -> DataFrame:
    """rows with valid and reason; a source without a rule is 'unknown-source'."""
    rows = evidence(rows)
    out = F.lit("unknown-source")
    for source in RULES:
        out = F.when(F.col("source") == source, reason(source)).otherwise(out)
    return rows.withColumn("reason", out).withColumn("valid", F.col("reason").isNull())
