"""Date columns: stamps, publication dates in URLs, distance of a capture."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BEFORE_PENALTY = 20 * 365 * 86_400


def stamp(text: Column) -> Column:
    """14 digits to a UTC timestamp; null if they aren't one."""
    return F.when(text.rlike(r"^\d{14}$"), F.try_to_timestamp(text, F.lit("yyyyMMddHHmmss")))


def iso(text: Column) -> Column:
    """ISO text, without an offset in UTC; bad text is null."""
    return F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")))


def in_years(date_text: Column, first: int, last: int) -> Column:
    """Half-open window on ISO text, compared as text."""
    return (date_text >= f"{first:04d}-01-01") & (date_text < f"{last + 1:04d}-01-01")


def capture_distance(captured: Column, published: Column) -> Column:
    """Seconds from publication to capture; a capture before it ranks behind all that are within 20 years
    after it; without a publication date the earliest capture is first."""
    gap = captured.cast("bigint") - published.cast("bigint")
    undated = F.date_format(captured, "yyyyMMddHHmmss").cast("bigint")
    return F.when(published.isNull(), undated).when(gap >= 0, gap).otherwise(-gap + BEFORE_PENALTY)


#: (host or None, pattern of year, month, day), tried in order.
URL_DATES: list[tuple[str | None, str]] = [
    (r"(^|\.)caixin\.com$", r"/(20\d\d)-(\d\d)-(\d\d)(?=/|$)"),
    (r"^zaobao\.com\.sg$", r"/story(20\d\d)(\d\d)(\d\d)(?=[-/]|$)"),
    (r"^reuters\.com$", r"/article/.*?((?:19|20)\d\d)(\d\d)(\d\d)(?=\D|$)"),
    (None, r"/(20\d\d)/(\d\d?)/(\d\d?)(?=/|$)"),
    (None, r"/articles/(20\d\d)-(\d\d)-(\d\d)(?=/|$)"),
    (None, r"-(20\d\d)-(\d\d)-(\d\d)(?=/|$)"),
]


def url_date(url: Column) -> Column:
    """The date that a URL shows.  The first pattern that matches decides: if its date is impossible, the
    result is null, not the next pattern's."""
    host = F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("HOST"))), r"^www\.", "")
    out = F.lit(None).cast("date")
    for host_rule, pattern in reversed(URL_DATES):
        hit = url.rlike(pattern) if host_rule is None else host.rlike(host_rule) & url.rlike(pattern)
        part = [F.regexp_extract(url, pattern, i) for i in (1, 2, 3)]
        day = F.try_to_date(F.concat_ws("-", part[0], F.lpad(part[1], 2, "0"), F.lpad(part[2], 2, "0")), "yyyy-MM-dd")
        out = F.when(hit, day).otherwise(out)
    return out


def slug_epoch_date(url: Column) -> Column:
    """The day in a slug's trailing 10 to 12 digit identifier, for years 2008 to 2038."""
    raw = F.regexp_extract(url, r"/articles/[^/?#]+-(\d{10,12})$", 1)
    epoch = F.when(F.length(raw) == 10, raw).when((F.length(raw) == 11) & raw.startswith("1"), F.substring(raw, 2, 10)).when(F.length(raw) == 12, F.substring(raw, 3, 10))
    day = F.to_date(F.timestamp_seconds(epoch.try_cast("bigint")))
    return F.when(F.year(day).between(2008, 2038), day)


def query_stamp(url: Column, key: str = "CTIME") -> Column:
    """A query parameter of six dash-separated numbers."""
    return F.try_to_timestamp(F.regexp_extract(url, rf"(?i)[?&]{key}=(\d{{4}}-\d\d-\d\d-\d\d-\d\d-\d\d)(?:&|#|$)", 1), F.lit("yyyy-MM-dd-HH-mm-ss"))


def sitemap_date(last_modified: Column, year: Column, month: Column) -> Column:
    """The modification time if it is in the sitemap's month, else noon of the month's 15th."""
    t = iso(last_modified)
    return F.when((F.year(t) == year) & (F.month(t) == month), t).otherwise(F.make_timestamp(year, month, F.lit(15), F.lit(12), F.lit(0), F.lit(0)))


_MONTHS = "January|February|March|April|May|June|July|August|September|October|November|December"
_SHORT = "Jan|Feb|Mar|Apr|May|Jun|Jul|Aug|Sep|Oct|Nov|Dec"
#: Spellings of a date, and how they are read once points and commas are gone.
SPELLINGS = (
    (r"(?i)\b(20\d{2}-\d{2}-\d{2})\b", "yyyy-MM-dd"),
    (rf"(?i)\b((?:{_MONTHS})\s+\d{{1,2}},?\s+20\d{{2}})\b", "MMMM d yyyy"),
    (rf"(?i)\b((?:{_SHORT})\.?\s+\d{{1,2}},?\s+20\d{{2}})\b", "MMM d yyyy"),
    (rf"(?i)\b(\d{{1,2}}\s+(?:{_MONTHS})\s+20\d{{2}})\b", "d MMMM yyyy"),
    (rf"(?i)\b(\d{{1,2}}\s+(?:{_SHORT})\.?\s+20\d{{2}})\b", "d MMM yyyy"),
)


def visible_date_gap(text: Column, expected: Column) -> Column:
    """Least distance in days to the expected date of any date in the first 4,000 characters, in five spellings; where
    the page shows its date, it does so there.  Null without a date."""
    head = F.substring(text, 1, 4000)
    plain = lambda x: F.initcap(F.regexp_replace(F.regexp_replace(x, "[.,]", ""), r"\s+", " "))
    each = lambda p, f: F.transform(F.regexp_extract_all(head, F.lit(p), 1), lambda x: F.try_to_date(plain(x), f))
    found = F.concat(*(each(p, f) for p, f in SPELLINGS))
    return F.array_min(F.transform(found, lambda d: F.abs(F.datediff(d, expected))))


def date_visible(text: Column, expected: Column) -> Column:
    """Whether the expected date stands anywhere in the whole text, in any of its five spellings."""
    low, out = F.lower(text), F.lit(False)
    for f in ("yyyy-MM-dd", "MMMM d, yyyy", "MMM d, yyyy", "d MMMM yyyy", "d MMM yyyy"):
        out |= F.contains(low, F.lower(F.date_format(expected, f)))
    return F.coalesce(out, F.lit(False))
