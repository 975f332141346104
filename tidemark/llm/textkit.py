"""Vectorised text kernels shared by the operators of this subpackage.

Everything works on whole Arrow string batches with numpy: no Python loop runs
per word or per character.  A *word* is a maximal run of ASCII letters, ASCII
digits and non-ASCII bytes of the lower-cased UTF-8 text, so white space and
ASCII punctuation never change a word sequence.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 20

_WORD_BYTE = np.zeros(256, dtype=bool)
_WORD_BYTE[48:58] = _WORD_BYTE[65:91] = _WORD_BYTE[97:123] = _WORD_BYTE[128:] = True
_rng = np.random.Generator(np.random.PCG64(20240229))
_BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) | U64(1)
_MULT = U64(0x9E3779B97F4A7C15)
_GRAM_MULT = U64(0xD6E8FEB86659FD93)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser: a bijection that spreads every input bit."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, dtype=U64)
    out[0] = U64(1)
    return np.multiply.accumulate(out, dtype=U64)


@dataclass
class Words:
    """The words of a chunk of texts, in order."""

    n_docs: int
    doc: np.ndarray  # text number of each word
    start: np.ndarray  # byte offset of each word in data
    end: np.ndarray
    hash: np.ndarray  # uint64
    first: np.ndarray  # n_docs + 1 word offsets by text
    data: np.ndarray  # bytes of the lower-cased chunk


def _buffers(arr: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    wide = pa.types.is_large_string(arr.type) or pa.types.is_large_binary(arr.type)
    _, offsets, data = arr.buffers()
    if len(arr) == 0:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, dtype=np.int64 if wide else np.int32)[arr.offset : arr.offset + len(arr) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw[off[0] : off[-1]]


def as_array(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if not (pa.types.is_string(column.type) or pa.types.is_large_string(column.type)):
        column = column.cast(pa.string())
    return pc.fill_null(column, "") if column.null_count else column


def chunked(column: pa.Array | pa.ChunkedArray, max_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, pa.Array]]:
    """Slices of about max_bytes, at least one text each: (first row, texts)."""
    arr = as_array(column)
    off, _ = _buffers(arr)
    at = 0
    while at < len(arr):
        to = max(at + 1, int(np.searchsorted(off, off[at] + max_bytes, side="right")) - 1)
        yield at, arr.slice(at, to - at)
        at = to


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the byte spans, all of at least one byte; about CHUNK_BYTES are in work at once, so that a
    very long text costs no more memory than a short one."""
    lens = end - start
    out = np.empty(len(start), U64)
    total = np.cumsum(lens)
    power = powers(_MULT, int(min(CHUNK_BYTES, lens.max(initial=1))))
    at = 0
    while at < len(start):
        to = max(at + 1, int(np.searchsorted(total, total[at] - lens[at] + CHUNK_BYTES, side="right")))
        n = lens[at:to]
        if to == at + 1 and n[0] > CHUNK_BYTES:
            h, shift = U64(0), U64(1)
            for lo in range(int(start[at]), int(end[at]), CHUNK_BYTES):
                piece = _BYTE_CODE[data[lo : min(lo + CHUNK_BYTES, int(end[at]))]]
                with np.errstate(over="ignore"):
                    h = h + np.add.reduce(piece * power[: len(piece)]) * shift
                    shift = shift * power[-1] * _MULT
            out[at] = h
        else:
            head = np.cumsum(n) - n
            place = np.arange(int(n.sum())) - np.repeat(head, n)
            out[at:to] = np.add.reduceat(_BYTE_CODE[data[place + np.repeat(start[at:to], n)]] * power[place], head)
        at = to
    return mix64(out ^ lens.astype(U64))


def words_of(texts: pa.Array, lower: bool = True) -> Words:
    arr = pc.utf8_lower(texts) if lower else texts
    off, data = _buffers(arr)
    n = len(arr)
    if not len(data):
        z = np.zeros(0, np.int64)
        return Words(n, z, z, z, z.astype(U64), np.zeros(n + 1, np.int64), data)
    inside = _WORD_BYTE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cut = off[:-1][off[:-1] < len(data)]
    begins[cut] = inside[cut]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    cut = off[1:][off[1:] > 0] - 1
    ends[cut] = inside[cut]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    first = np.searchsorted(start, off)
    doc = np.repeat(np.arange(n), np.diff(first))
    if not len(start):
        return Words(n, doc, start, end, np.zeros(0, U64), first, data)
    return Words(n, doc, start, end, span_hashes(data, start, end), first, data)


def grams(h: np.ndarray, n: int) -> np.ndarray:
    """Names of the runs of n words that start at each position, by local doubling
    (length len(h) - n + 1).  Runs across texts are the caller's to leave out."""
    if n <= 0 or len(h) < n:
        return np.zeros(0, U64)
    have, size = h.astype(U64), 1
    while size * 2 <= n:
        have = mix64(have[: len(have) - size] * _GRAM_MULT + mix64(have[size:] + U64(size)))
        size *= 2
    if size < n:
        have = mix64(have[: len(h) - n + 1] * _GRAM_MULT + mix64(have[n - size : n - size + len(h) - n + 1] + U64(n)))
    return have


def within(first: np.ndarray, n: int) -> np.ndarray:
    """Mask over the starts of n-word runs: those that stay in one text."""
    total = int(first[-1])
    if total < n:
        return np.zeros(0, bool)
    left = np.repeat(first[1:], np.diff(first)) - np.arange(total)
    return left[: total - n + 1] >= n


def sliding(op: np.ufunc, x: np.ndarray, n: int) -> np.ndarray:
    """op.reduce over each window of n, by doubling."""
    have, size = x, 1
    while size * 2 <= n:
        have = op(have[: len(have) - size], have[size:])
        size *= 2
    return op(have[: len(x) - n + 1], have[n - size : n - size + len(x) - n + 1]) if size < n else have


def lines_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text number, line number, byte length, uint64 hash) of each line, split at line feeds.
    Blanks at the ends don't count in hash and length; a text without line feeds is one line."""
    off, data = _buffers(texts)
    n = len(texts)
    is_break = data == 10
    breaks = np.flatnonzero(is_break)
    per = np.searchsorted(breaks, off)
    counts = np.diff(per) + 1
    doc = np.repeat(np.arange(n), counts)
    head = np.cumsum(counts) - counts
    number = np.arange(int(counts.sum())) - np.repeat(head, counts)
    start = np.empty(len(doc), np.int64)
    end = np.empty(len(doc), np.int64)
    start[head] = off[:-1]
    inner = np.ones(len(doc), bool)
    inner[head] = False
    start[inner] = breaks + 1
    end[head + counts - 1] = off[1:]
    outer = np.ones(len(doc), bool)
    outer[head + counts - 1] = False
    end[outer] = breaks
    # the solid bytes at the ends of each line: blanks around them don't count
    solid = np.flatnonzero((data > 32) & (data != 127))
    lo, hi = np.searchsorted(solid, start), np.searchsorted(solid, end)
    full = np.flatnonzero(hi > lo)
    a, b = solid[lo[full]], solid[hi[full] - 1] + 1
    size = np.zeros(len(doc), np.int64)
    size[full] = b - a
    out = np.zeros(len(doc), U64)
    out[full] = span_hashes(data, a, b)
    return doc, number, size, out
