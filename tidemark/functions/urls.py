"""URL columns: canonical forms, join keys, variants, guards."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

ASSETS = r"(?i)\.(js|mjs|css|pdf|ico|svg|png|gif|bmp|webp|avif|jpg|jpeg)$"
TRACKING = ("fbclid", "gclid", "ref", "mc_cid", "mc_eid", "cmpid")


@dataclass(frozen=True)
class SourceRule:
    """What an article URL of one source looks like: data, joined by name or built into a plan."""

    name: str
    host: str
    accept: tuple[str, ...]
    reject: tuple[str, ...] = ()
    other_hosts: tuple[str, ...] = ()
    keep_hosts: tuple[str, ...] = ()
    repairs: tuple[tuple[str, str], ...] = ()
    prefixes: tuple[str, ...] = field(default=())

    def query_prefixes(self, first: int, last: int) -> list[str]:
        """Prefixes to look up, each once, years filled in."""
        years = range(first, last + 1)
        return list(dict.fromkeys(p.format(year=y) for p in self.prefixes for y in (years if "{year}" in p else (first,))))


#: Shapes of article URLs by source; a user adds rows of the same form.
RULES = {
    r.name: r
    for r in (
        SourceRule("daily", "www.example.com", (r"^/[a-z]{2}/\d+", r"^/20\d\d/"), (r"^/(?:video|search)(?:/|$)",), ("m.example.com",), prefixes=("www.example.com/{year}/*",)),
        SourceRule("npr", "www.npr.org", (r"^/20\d\d/",), (r"^/(?:music|programs|podcasts?)(?:/|$)",), repairs=((r"(?i)(?:%0[0-9a-f]|%7f)+$", ""), (r"=+$", "")), prefixes=("npr.org/{year}/*", "www.npr.org/{year}/*")),
        SourceRule("ft", "www.ft.com", (r"^/content/[0-9a-f-]{20,}$",), prefixes=("ft.com/content/*",)),
        SourceRule("nikkei", "www.nikkei.com", (r"^/article/[A-Z0-9_]{13,}/?$",), repairs=((r"^/article/article/", "/article/"),), prefixes=("www.nikkei.com/article/*",)),
        SourceRule("axios", "www.axios.com", (r"^/(?:[^/]+/)?20\d\d/",), (r"^/(?:about|signup|newsletters?)(?:/|$)",), prefixes=("axios.com/{year}/*",)),
        SourceRule("scmp", "www.scmp.com", (r"/article/\d+",), (r"^/(?:magazines|video)(?:/|$)",), prefixes=("www.scmp.com/article/*",)),
        SourceRule("caixin", "www.caixin.com", (r"^/20\d\d(?:-|/|$)",), other_hosts=("magazine.caixin.com",), keep_hosts=("magazine.caixin.com",), prefixes=("magazine.caixin.com/{year}/*",)),
        SourceRule("zaobao", "www.zaobao.com.sg", (r"^(?:/[a-z0-9-]+)+/story20\d{6}-\d+$",), (r"^/(?:podcast|zvideos)(?:/|$)",), prefixes=("www.zaobao.com.sg/news/*",)),
    )
}


def part(url: Column, name: str) -> Column:
    return F.try_parse_url(F.trim(url), F.lit(name))


def host(url: Column) -> Column:
    return F.regexp_replace(F.lower(part(url, "HOST")), r"^www\.", "")


def path(url: Column) -> Column:
    return F.regexp_replace(F.coalesce(F.nullif(part(url, "PATH"), F.lit("")), F.lit("/")), "/+", "/")


def normalize(rule: SourceRule, url: Column) -> Column:
    """The canonical article URL: https, the source's host, no query or trailing slash; null if it isn't one."""
    raw, bare = F.lower(part(url, "HOST")), rule.host.removeprefix("www.")
    p = path(url)
    for pattern, to in rule.repairs:
        p = F.regexp_replace(p, pattern, to)
    ok = part(url, "PROTOCOL").isin("http", "https") & raw.isin(rule.host, bare, f"www.{bare}", *rule.other_hosts) & ~p.rlike(ASSETS)
    for pattern in rule.reject:
        ok &= ~p.rlike(f"(?i){pattern}")
    hit = F.lit(False)
    for pattern in rule.accept:
        hit |= p.rlike(f"(?i){pattern}")
    short = F.when(p == "/", p).otherwise(F.regexp_replace(p, "/+$", ""))
    to = F.when(raw.isin(*rule.keep_hosts), raw).otherwise(rule.host) if rule.keep_hosts else F.lit(rule.host)
    return F.when(ok & hit, F.concat(F.lit("https://"), to, short))


def match_key(url: Column) -> Column:
    """Join key of one article: host without www, path without slash or .html and folded over its site's generations,
    no query."""
    return F.concat(host(url), F.regexp_replace(fold_path(host(url), path(url)), r"(?i)(?:\.html?)?/*$", ""))


def variants(url: Column) -> Column:
    """Spellings under which an index may hold a URL: both schemes, with and without www and slash."""
    rest = F.regexp_replace(path(url), "/+$", "")
    h = host(url)
    return F.array_distinct(F.array(*(F.concat(F.lit(f"{scheme}://{www}"), h, rest, F.lit(end)) for scheme in ("https", "http") for www in ("www.", "") for end in ("", "/"))))


def snapshot_target(url: Column) -> Column:
    """The original URL inside an archive's replay URL."""
    return F.nullif(F.regexp_extract(url, r"^https?://[^/]+/(?:web|wayback|noFrame/replay)/\d{1,14}(?:[a-z]{2}_)?/(https?://.+)$", 1), F.lit(""))


def strip_tracking(url: Column) -> Column:
    """Without the fragment and tracking parameters, the others in order."""
    query = F.coalesce(part(url, "QUERY"), F.lit(""))
    kept = F.filter(F.split(query, "&"), lambda x: (x != "") & ~F.lower(F.split_part(x, F.lit("="), F.lit(1))).isin(*TRACKING) & ~F.lower(x).startswith("utm_"))
    base = F.regexp_replace(F.trim(url), r"[?#].*$", "")
    return F.when(F.size(kept) > 0, F.concat(base, F.lit("?"), F.array_join(kept, "&"))).otherwise(base)


def is_public(url: Column, excluded: tuple[str, ...] = ()) -> Column:
    """http(s) on a usual port, a domain name that isn't local or excluded, and no credentials."""
    h = F.lower(part(url, "HOST"))
    ok = part(url, "PROTOCOL").isin("http", "https") & part(url, "USERINFO").isNull() & h.rlike(r"^(?:[a-z0-9-]+\.)+[a-z]{2,}$") & ~h.rlike(r"(?:^|\.)(?:localhost|local|internal|lan)$")
    port = F.regexp_extract(url, r"^[a-z]+://[^/?#]*:(\d+)", 1)
    ok &= port.isin("", "80", "443")
    for domain in excluded:
        ok &= ~((h == domain) | h.endswith(f".{domain}"))
    return F.coalesce(ok, F.lit(False))


def archive_guesses(url: Column, published: Column) -> Column:
    """Snapshot addresses 1, 7 and 30 days after publication; one open address without a date."""
    dated = F.transform(F.array(*map(F.lit, (1, 7, 30))), lambda d: F.date_format(F.timestamp_add("DAY", d, published), "yyyyMMddHHmmss"))
    stamps = F.when(published.isNull(), F.array(F.lit("2"))).otherwise(dated)
    return F.transform(stamps, lambda s: F.concat(F.lit("https://web.archive.org/web/"), s, F.lit("id_/"), url))


def row_url(year: Column, index: Column) -> Column:
    """Address of one row of a year-partitioned corpus."""
    return F.format_string("corpus://news/%d/%d", year, index)


def image_family(url: Column) -> Column:
    """Renditions of one image share this key: sizes in the path become a template, the query goes."""
    return F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"(?<=[/_-])-?\d{1,4}x-?\d{1,4}(?=[/._-]|$)", "{size}")


def srcset(value: Column) -> Column:
    """Addresses of a srcset by falling width."""
    items = F.filter(F.transform(F.split(value, r",\s+"), lambda x: F.split(F.trim(x), r"\s+")), lambda x: F.element_at(x, 1) != "")
    sized = F.transform(items, lambda x: F.struct((-F.coalesce(F.regexp_extract(F.try_element_at(x, F.lit(2)), r"^(\d+)", 1).try_cast("bigint"), F.lit(0))).alias("w"), F.element_at(x, 1).alias("u")))
    return F.array_distinct(F.transform(F.array_sort(sized), lambda s: s["u"]))


def replay_matches(replay: Column, url: Column) -> Column:
    """Whether a replay address shows this article."""
    return F.coalesce(match_key(snapshot_target(replay)) == match_key(url), F.lit(False))


def source_priority(url: Column, first: tuple[str, ...], second: tuple[str, ...] = ()) -> Column:
    """0 for hosts of the first list and their subdomains, 1 for the second, else 2."""
    hit = lambda hosts: F.coalesce(host(url).rlike("(?:^|\\.)(?:" + "|".join(h.replace(".", "\\.") for h in hosts) + ")$"), F.lit(False)) if hosts else F.lit(False)
    return F.when(hit(first), 0).when(hit(second), 1).otherwise(2)


def unwrap_redirect(url: Column) -> Column:
    """The target in a search result's redirect address."""
    raw = F.coalesce(F.nullif(F.regexp_extract(url, r"[/?&;](?:RU|url|u|q)=(https?[^/&;]+)", 1), F.lit("")), url)
    return F.coalesce(F.try_url_decode(raw), raw)


def embedded(page: Column, rule: SourceRule) -> Column:
    """Distinct canonical article URLs in a page, in order."""
    found = F.regexp_extract_all(page, F.lit(r"(https?://[^\s\"'<>\\]+)"), 1)
    return F.array_distinct(F.filter(F.transform(found, lambda u: normalize(rule, u)), lambda u: u.isNotNull()))


def spec_fingerprint(rule: SourceRule, first: int, last: int) -> str:
    """Hash of what a run looks up: a resumed run must have the same."""
    import hashlib
    import json

    return hashlib.sha256(json.dumps({"name": rule.name, "first": first, "last": last, "prefixes": rule.query_prefixes(first, last)}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def fold_path(host_: Column, path_: Column) -> Column:
    """Path of an article across its site's generations: dated news paths with and without a folder or .html are one."""
    bare = F.regexp_replace(path_, "/+$", "")
    shape = r"^/news/(?:articles/)?(\d{4}-\d{2}-\d{2})/([^/]+?)(?:\.html)?$"
    legacy = bare.rlike(r"^/news/\d{4}-\d{2}-\d{2}/[^/]+\.html$") | bare.rlike(r"^/news/articles/\d{4}-\d{2}-\d{2}/[^/]+$")
    return F.when((host_ == "bloomberg.com") & legacy, F.regexp_replace(bare, shape, "/news/$1/$2")).otherwise(bare)


#: A wire's partners: hosts, the path of its articles there, the host that they get, and the parameter that is kept.
PARTNERS = (
    (("google.com", "www.google.com"), r"(?i)^/hostednews/(?:ap|canadianpress)/article/[^/]+$", "www.google.com", "docId"),
    (("news.yahoo.com", "www.news.yahoo.com"), r"(?i)^/s/ap/(\d{8})/[^/]+/[^/]+$", "news.yahoo.com", None),
    (("huffingtonpost.com", "www.huffingtonpost.com"), r"(?i)^/huff-wires/(\d{8})/[^/]+$", "www.huffingtonpost.com", None),
)


def partner(url: Column) -> Column:
    """The canonical form of a wire article's address at a partner; null if it isn't one."""
    raw = F.lower(part(url, "HOST"))
    p = F.regexp_replace(F.regexp_replace(F.coalesce(part(url, "PATH"), F.lit("")), ";.*$", ""), "/+$", "")
    out = F.lit(None).cast("string")
    for hosts, pattern, to, key in PARTNERS:
        name = F.regexp_extract(F.coalesce(part(url, "QUERY"), F.lit("")), rf"(?i)(?:^|&){key}(?:=|/x3d|/u003d)([^&]+)", 1)
        query = F.when(name != "", F.concat(F.lit(f"?{key}="), name)).otherwise("") if key else F.lit("")
        out = F.when(raw.isin(*hosts) & p.rlike(pattern), F.concat(F.lit(f"https://{to}"), p, query)).otherwise(out)
    return out


def partner_date(url: Column) -> Column:
    """The day in a partner's path; null where there is none or it is impossible."""
    own, day = partner(url), F.lit("")
    for _, pattern, to, _ in PARTNERS:
        if "(\\d{8})" in pattern:
            inner = F.regexp_extract(own, "(?i)" + pattern.removeprefix("(?i)").replace("^", f"^https://{to.replace('.', chr(92) + '.')}", 1), 1)
            day = F.when(F.coalesce(inner, F.lit("")) != "", inner).otherwise(day)
    return F.try_to_date(F.nullif(day, F.lit("")), "yyyyMMdd")


def mirrored_original(url: Column) -> Column:
    """The original's address behind a partner's dated mirror path; null if it isn't one."""
    shape = r"(?i)^https?://(?:www\.)?bnnbloomberg\.ca/bloomberg/(20\d{2})/(\d{2})/(\d{2})/([a-z0-9][a-z0-9-]*)/?(?:[?#].*)?$"
    return F.when(url.rlike(shape), F.regexp_replace(url, shape, "https://www.bloomberg.com/news/articles/$1-$2-$3/$4"))


def decoded_feed_url(url: Column) -> Column:
    """The article's address inside an aggregator's opaque item: its last path part is base64 of a short record that
    holds it; null where it holds none."""
    raw = F.regexp_extract(url, r"/(?:rss/)?articles/([A-Za-z0-9_-]+)", 1)
    plain = F.translate(raw, "-_", "+/")
    padded = F.rpad(plain, F.ceil(F.length(plain) / 4).cast("int") * 4, "=")
    text = F.decode(F.try_to_binary(padded, F.lit("base64")), "ISO-8859-1")
    return F.nullif(F.regexp_extract(text, r"(https?://[\x21-\x7e]+)", 1), F.lit(""))
