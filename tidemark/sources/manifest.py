"""Manifest files: one JSON object a line, with spelling variants of the same fields."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CANDIDATE = "struct<provider string, snapshotUrl string, sourceUrl string, expectedHeadline string, capturedAt string, digest string, mimeType string, statusCode int, byteCount bigint, warcFilename string, warcOffset bigint, warcLength bigint>"
ROW = (
    "struct<formatVersion string, publisher string, canonicalUrl string, canonical_url string, url string, publishedAt string, published_at string, catalog_date string, section string,"
    " wayback_status string, wayback_snapshot_url string, wayback_timestamp string, wayback_digest string, wayback_mimetype string, wayback_status_code string,"
    f" candidates array<{CANDIDATE}>>"
)


def filled(*names: str, row: str = "r") -> Column:
    """The first of the fields that isn't blank."""
    return F.coalesce(*(F.nullif(F.trim(F.col(f"{row}.{n}")), F.lit("")) for n in names))


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds each line's number, from 1, in its file, or in its part of a file that is split."""
    now, n = None, 0
    for batch in batches:
        line = np.empty(batch.num_rows, np.int64)
        for i, key in enumerate(zip(batch.column("file").to_pylist(), batch.column("start").to_pylist())):
            now, n = (now, n + 1) if key == now else (key, 1)
            line[i] = n
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(line)], [*batch.schema.names, "line"])


def read_manifest(spark: SparkSession, paths: str | list[str], publisher: str) -> DataFrame:
    """(source, ordinal, url, published, section, candidates) of JSONL files, gzipped or not.

    Blank lines are skipped.  A line that isn't an object, a row without a URL or of another publisher
    fails the scan, naming the file and the line.  source is the place of the path in the list; ordinal orders
    the rows of a source: by file name, then by place in the file.  Old rows with one capture in flat fields get
    it as their candidate.
    """
    paths = [paths] if isinstance(paths, str) else paths
    out = None
    for k, path in enumerate(paths):
        part = spark.read.text(path).select("value", F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("start"))
        part = part.mapInArrow(_numbered, "value string, file string, start bigint, line bigint").where(F.trim("value") != "").withColumn("source", F.lit(k))
        out = part if out is None else out.unionByName(part)
    out = out.withColumn("ordinal", F.struct("file", "start", "line"))
    rows = out.withColumn("r", F.from_json("value", ROW))
    bad = ~F.trim("value").startswith("{") | F.try_parse_json("value").isNull()
    who = F.lower(F.coalesce(filled("publisher"), F.lit(publisher)))
    at = F.concat(F.lit(": "), "file", F.lit(", line "), F.col("line").cast("string"), F.when(F.col("start") > 0, F.concat(F.lit(" from byte "), F.col("start").cast("string"))).otherwise(""))
    fail = lambda why: F.raise_error(F.concat(F.lit(why), at))
    url = F.coalesce(filled("canonicalUrl", "canonical_url", "url"), fail("manifest row without a URL"))
    url = F.when(bad, fail("manifest line is no JSON object")).when(who != publisher.lower(), fail("manifest of another publisher")).otherwise(url)
    flat = F.when(
        (F.col("r.wayback_status") == "found") & filled("wayback_snapshot_url").isNotNull(),
        F.array(
            F.struct(
                F.lit("wayback").alias("provider"), F.col("r.wayback_snapshot_url").alias("snapshotUrl"), F.lit(None).cast("string").alias("sourceUrl"), F.lit(None).cast("string").alias("expectedHeadline"),
                F.col("r.wayback_timestamp").alias("capturedAt"), F.col("r.wayback_digest").alias("digest"), F.col("r.wayback_mimetype").alias("mimeType"), F.col("r.wayback_status_code").try_cast("int").alias("statusCode"),
                F.lit(None).cast("bigint").alias("byteCount"), F.lit(None).cast("string").alias("warcFilename"), F.lit(None).cast("bigint").alias("warcOffset"), F.lit(None).cast("bigint").alias("warcLength"),
            )
        ),
    )
    empty = F.lit(None).cast(f"array<{CANDIDATE}>")
    return rows.select("source", "ordinal", url.alias("url"), filled("publishedAt", "published_at", "catalog_date").alias("published"), filled("section").alias("section"), F.coalesce(F.col("r.candidates"), flat, F.coalesce(empty, F.array().cast(f"array<{CANDIDATE}>"))).alias("candidates"))


def write_manifest(rows: DataFrame, path: str, publisher: str, compression: str = "gzip") -> None:
    """JSON lines ordered by URL, absent fields left out; the commit protocol makes it all or nothing."""
    line = F.to_json(F.struct(F.lit("1").alias("formatVersion"), F.lit(publisher).alias("publisher"), F.col("url").alias("canonicalUrl"), F.col("published").alias("publishedAt"), "section", "candidates"), {"ignoreNullFields": "true"})
    rows.orderBy("url").select(line.alias("value")).write.mode("overwrite").option("compression", compression).text(path)
