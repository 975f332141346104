"""WARC records: decoding a stored byte range to an HTTP response."""

from __future__ import annotations

import gzip
import zlib

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

MOST_BYTES = 25_000_000
SCHEMA = "struct<target string, status int, headers map<string,string>, body binary, error string>"


def inflate(raw: bytes, wbits: int, most: int = MOST_BYTES) -> bytes:
    """Decompress at most so many bytes; more is an error, so that a small file can't fill memory."""
    d = zlib.decompressobj(wbits)
    out = d.decompress(raw, most + 1)
    if len(out) > most:
        raise ValueError("body too large")
    return out + d.flush()


def unchunk(raw: bytes) -> bytes:
    out, at = bytearray(), 0
    while True:
        end = raw.index(b"\r\n", at)
        n = int(raw[at:end].split(b";")[0], 16)
        if not n:
            return bytes(out)
        if len(raw) < end + 2 + n:
            raise ValueError("chunk cut short")
        out += raw[end + 2 : end + 2 + n]
        at = end + 4 + n


def _headers(block: bytes) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in block.split(b"\r\n")[1:]:
        name, sep, value = line.partition(b":")
        if sep:
            out[name.decode("latin-1").strip().lower()] = value.decode("latin-1").strip()
    return out


def http_body(payload: bytes, most: int = MOST_BYTES) -> tuple[int, dict[str, str], bytes]:
    head, sep, body = payload.partition(b"\r\n\r\n")
    words = head.split(b"\r\n")[0].split(None, 2)
    if not sep or len(words) < 2 or not words[0].startswith(b"HTTP/"):
        raise ValueError("not an HTTP response")
    headers = _headers(head)
    if headers.get("transfer-encoding", "").lower() == "chunked":
        body = unchunk(body)
    elif headers.get("content-length", "").isdigit():
        body = body[: int(headers["content-length"])]
    coding = headers.get("content-encoding", "").lower()
    if coding == "gzip" and body[:2] == b"\x1f\x8b":
        body = inflate(body, 31, most)
    elif coding == "deflate":
        try:
            body = inflate(body, 15, most)
        except zlib.error:
            body = inflate(body, -15, most)
    if len(body) > most:
        raise ValueError("body too large")
    return int(words[1]), headers, body


def record(raw: bytes, most: int = MOST_BYTES) -> tuple[str, int, dict[str, str], bytes]:
    """(target, status, headers, body) of a response record, gzipped or not."""
    if raw[:2] == b"\x1f\x8b":
        raw = inflate(raw, 31, most)
    head, sep, payload = raw.partition(b"\r\n\r\n")
    if not sep or not head.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    meta = _headers(head)
    if meta.get("warc-type") != "response":
        raise ValueError("not a response record")
    if meta.get("content-length", "").isdigit():
        if len(payload) < int(meta["content-length"]):
            raise ValueError("record cut short")
        payload = payload[: int(meta["content-length"])]
    return meta.get("warc-target-uri", "").strip("<>"), *http_body(payload, most)


def _decode(content: pa.Array) -> pa.Array:
    out = []
    for raw in content.to_pylist():
        row = dict.fromkeys(("target", "status", "headers", "body", "error"))
        try:
            if raw is not None:
                row["target"], row["status"], headers, row["body"] = record(raw)
                row["headers"] = list(headers.items())
        except (ValueError, zlib.error, gzip.BadGzipFile, EOFError) as e:
            row["error"] = str(e) or type(e).__name__
        out.append(row)
    kind = pa.struct([("target", pa.string()), ("status", pa.int32()), ("headers", pa.map_(pa.string(), pa.string())), ("body", pa.binary()), ("error", pa.string())])
    return pa.array(out, kind)


def decode(content: Column) -> Column:
    """Column of records to responses; what can't be decoded has an error instead."""
    return F.arrow_udf(_decode, SCHEMA)(content)


def records(raw: bytes, most: int = MOST_BYTES) -> list[tuple[str, int, dict[str, str], bytes]]:
    """Every HTML response of status 200 in a WARC file of several records; a cut-off record is an error."""
    if raw[:2] == b"\x1f\x8b":
        raw = gzip.decompress(raw)
    out, at = [], 0
    while raw[at:].strip():
        at = raw.index(b"WARC/", at)
        end = raw.index(b"\r\n\r\n", at)
        size = int(_headers(raw[at:end]).get("content-length", "0"))
        if len(raw) < end + 4 + size:
            raise ValueError("record cut short")
        one = raw[at : end + 4 + size]
        at = end + 4 + size
        if _headers(one.partition(b"\r\n\r\n")[0]).get("warc-type") == "response":
            r = record(one, most)
            if r[1] == 200 and "html" in r[2].get("content-type", "html"):
                out.append(r)
    return out


def _longest(content: pa.Array, url: pa.Array) -> pa.Array:
    out = []
    for raw, target in zip(content.to_pylist(), url.to_pylist()):
        try:
            bodies = [b for t, _, _, b in records(raw) if target is None or t.rstrip("/") == target.rstrip("/")] if raw is not None else []
        except (ValueError, zlib.error, gzip.BadGzipFile, EOFError):
            bodies = []
        out.append(max(bodies, key=len, default=None))
    return pa.array(out, pa.binary())


def longest_body(content: Column, url: Column) -> Column:
    """The longest page of an address in a WARC file; null if there is none or the file is broken."""
    return F.arrow_udf(_longest, "binary")(content, url)


def _encoded(content: pa.Array, coding: pa.Array) -> pa.Array:
    out = []
    for raw, how in zip(content.to_pylist(), coding.to_pylist()):
        try:
            head = b"HTTP/1.1 200 OK\r\nContent-Encoding: " + (how or "").encode() + b"\r\n\r\n"
            out.append(None if raw is None else http_body(head + raw)[2])
        except (ValueError, zlib.error, EOFError):
            out.append(None)
    return pa.array(out, pa.binary())


def decode_body(content: Column, coding: Column) -> Column:
    """A stored body without its content coding; null if it is broken or too large."""
    return F.arrow_udf(_encoded, "binary")(content, coding)


def _ranges(root: str):
    def run(batches):
        for batch in batches:
            out = []
            for name, offset, length in zip(*(batch.column(k).to_pylist() for k in ("filename", "offset", "length"))):
                try:
                    with open(f"{root}/{name}", "rb") as f:
                        f.seek(offset)
                        out.append(f.read(length))
                except OSError:
                    out.append(None)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], [*batch.schema.names, "content"])

    return run


def read_ranges(rows, root: str):
    """Add content to rows of (filename, offset, length): the byte range of a file in a folder that every
    executor mounts.  Rows are sorted by file and place first, so that a task reads forward."""
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.repartitionByRange("filename", "offset").sortWithinPartitions("filename", "offset").mapInArrow(_ranges(root), f"{kinds}, content binary")
