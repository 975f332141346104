"""Text columns: cleaning, token sets, overlap measures, stable hashes."""

from __future__ import annotations

import html
import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_FILLERS = frozenset("the with to on of in from for by at as and an a".split())
#: Stop lists differ by measure; a caller picks one.
STOP_WORDS = {
    "short": _FILLERS,
    "capture": _FILLERS | {"s", "after"},
    "long": _FILLERS | frozenset("were was will have has is be are its it this that s or".split()),
}


def collapse(text: Column) -> Column:
    """White space runs to one blank, ends trimmed."""
    return F.trim(F.regexp_replace(text, r"[\s ]+", " "))


def _unescaped(texts: pa.Array) -> pa.Array:
    out = []
    for t in texts.to_pylist():
        if t is not None:
            t = "".join(bytes([ord(c)]).decode("cp1252", "ignore") if 0x80 <= ord(c) < 0xA0 else c for c in html.unescape(t))
        out.append(t)
    return pa.array(out, pa.string())


def clean(text: Column) -> Column:
    """Entities, C1 controls and white space."""
    return collapse(unescaped(text))


def _casefolded(texts: pa.Array) -> pa.Array:
    return pa.array([None if t is None else t.casefold() for t in texts.to_pylist()], pa.string())


def _slug(texts: pa.Array) -> pa.Array:
    out = []
    for t in texts.to_pylist():
        if t is not None:
            plain = unicodedata.normalize("NFKD", t).encode("ascii", "ignore").decode().casefold()
            t = re.sub("[^a-z0-9]+", "-", plain).strip("-")
        out.append(t)
    return pa.array(out, pa.string())


# UDFs are made where they are used: a module must import without a session, on executors too
def unescaped(text: Column) -> Column:
    """Entities resolved and C1 controls read as Windows-1252."""
    return F.arrow_udf(_unescaped, "string")(text)


def casefolded(text: Column) -> Column:
    """Full case folding (lower() keeps the sharp s)."""
    return F.arrow_udf(_casefolded, "string")(text)


def slug(text: Column) -> Column:
    """Headline to a-z0-9 words joined by hyphens; other letters fold to ASCII or go."""
    return F.arrow_udf(_slug, "string")(text)


def tokens(text: Column, stop: str | None = "short") -> Column:
    """Distinct a-z0-9 words of the lower-cased text, without stop words; null gives none."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit("([a-z0-9]+)"), 1))
    return F.array_except(words, F.array(*map(F.lit, sorted(STOP_WORDS[stop])))) if stop else words


def shared(a: Column, b: Column) -> Column:
    return F.size(F.array_intersect(a, b))


def overlap(a: Column, b: Column, over: str = "least") -> Column:
    """Shared share of two token sets: over the smaller ("least"), the larger ("greatest") or the first ("first")."""
    base = {"least": F.least(F.size(a), F.size(b)), "greatest": F.greatest(F.size(a), F.size(b)), "first": F.size(a)}[over]
    return F.when(base > 0, shared(a, b) / base).otherwise(0.0)


def first_text(*values: Column) -> Column:
    """The first value that isn't blank."""
    return F.coalesce(*(F.nullif(collapse(v), F.lit("")) for v in values))


def distinct_lines(text: Column) -> Column:
    """Lines in order, each once."""
    return F.array_join(F.array_distinct(F.split(text, "\n", -1)), "\n")


def stable_id(publisher: Column, url: Column) -> Column:
    return F.concat(publisher, F.lit(":"), F.sha2(url, 256))


def hash_priority(*parts: Column, sep: str = "|") -> Column:
    """SHA-256 of the joined parts: a seeded, engine-independent order."""
    return F.sha2(F.concat_ws(sep, *(p.cast("string") for p in parts)), 256)


def hash_number(*parts: Column, sep: str = ":") -> Column:
    """The first 8 bytes of that hash without the top bit, as a number."""
    head = F.substring(hash_priority(*parts, sep=sep), 1, 16)
    low = F.conv(F.substring(head, 2, 15), 16, 10).cast("bigint")
    high = F.conv(F.substring(head, 1, 1), 16, 10).cast("bigint").bitwiseAND(7)
    return F.shiftleft(high, 60) + low


def url_fingerprint(urls: Column) -> Column:
    """Aggregate: SHA-256 of the sorted distinct values, each ended by a line feed."""
    return F.sha2(F.concat(F.array_join(F.sort_array(F.collect_set(urls)), "\n"), F.lit("\n")), 256)


def clean_title(text: Column) -> Column:
    """Tags and a trailing site name removed."""
    return collapse(F.regexp_replace(F.regexp_replace(text, "<[^>]*>", " "), r"\s+[|–—-]\s+[^|–—-]{2,40}$", ""))
