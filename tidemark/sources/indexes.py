"""Capture indexes, sitemaps, feeds and corpora as DataFrames, and a paged index source."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

CDX_COLUMNS = ["timestamp", "original", "mimetype", "statuscode", "digest", "length"]
CDX_SCHEMA = "page string, place int, timestamp string, original string, mimetype string, status int, digest string, length long, resume_key string"
MOST_RECORD = 25_000_000


def parse_cdx(pages: DataFrame, body: str = "body", page: str = "page") -> DataFrame:
    """Index pages (JSON arrays of arrays) to captures.  The first row is the header; an empty row and a
    one-element row end a page, the latter as its resume key.  A dash is a null digest, a length that is no
    number null.  A page with another header fails."""
    rows = pages.select(F.col(page).alias("page"), F.from_json(body, "array<array<string>>").alias("rows"))
    head = F.try_element_at("rows", F.lit(1))
    good = F.when(F.size("rows") == 0, F.lit(True)).when(head == F.array(*map(F.lit, CDX_COLUMNS)), F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("unexpected index header on page "), "page")))
    rows = rows.where(good).withColumn("resume_key", F.element_at(F.coalesce(F.try_element_at(F.filter("rows", lambda r: F.size(r) == 1), F.lit(1)), F.array(F.lit(None).cast("string"))), 1))
    each = rows.select("page", "resume_key", F.posexplode(F.filter("rows", lambda r: F.size(r) == 6)).alias("place", "r")).where("place > 0")
    at = lambda k: F.element_at("r", k)
    return each.select("page", "place", at(1).alias("timestamp"), at(2).alias("original"), at(3).alias("mimetype"), at(4).try_cast("int").alias("status"), F.nullif(at(5), F.lit("-")).alias("digest"), at(6).try_cast("long").alias("length"), "resume_key")


def parse_index_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """NDJSON index rows that can be fetched: HTML, status 200, a crawl file, a sane byte range."""
    r = lines.select(F.from_json(value, "struct<url string, timestamp string, status string, mime string, digest string, length string, offset string, filename string>").alias("r")).select("r.*")
    r = r.withColumns({"offset": F.col("offset").try_cast("long"), "length": F.col("length").try_cast("long"), "status": F.col("status").try_cast("int")})
    return r.where((F.col("status") == 200) & F.col("mime").isin("text/html", "application/xhtml+xml") & F.col("filename").startswith("crawl-data/") & (F.col("offset") >= 0) & F.col("length").between(1, MOST_RECORD))


def _repaired(xml: Column) -> Column:
    """Bare ampersands and control bytes, the two faults that feeds have, mended."""
    return F.regexp_replace(F.regexp_replace(xml, r"&(?!#?\w{1,10};)", "&amp;"), r"[\x00-\x08\x0B\x0C\x0E-\x1F]", "")


def _tags(xml: Column, outer: str) -> Column:
    return F.regexp_extract_all(_repaired(xml), F.lit(rf"(?s)<(?:\w+:)?{outer}(?:\s[^>]*)?>(.*?)</(?:\w+:)?{outer}>"), 1)


def _tag(xml: Column, name: str) -> Column:
    inner = F.regexp_extract(xml, rf"(?s)<(?:\w+:)?{name}(?:\s[^>]*)?>(?:\s*<!\[CDATA\[)?(.*?)(?:\]\]>\s*)?</(?:\w+:)?{name}>", 1)
    text = inner
    for entity, char in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&#39;", "'"), ("&amp;", "&")):
        text = F.replace(text, F.lit(entity), F.lit(char))
    return F.nullif(F.trim(text), F.lit(""))


def parse_sitemap_index(files: DataFrame, xml: str = "xml") -> DataFrame:
    """Distinct (loc, lastmod, year, month) of sitemap indexes; the month as the address shows it."""
    e = files.select(F.explode(_tags(F.col(xml), "sitemap")).alias("e")).select(_tag(F.col("e"), "loc").alias("loc"), _tag(F.col("e"), "lastmod").alias("lastmod"))
    rule = r"(20\d\d)[-/_]?(0[1-9]|1[0-2])"
    return e.where("loc IS NOT NULL").select("loc", "lastmod", F.regexp_extract("loc", rule, 1).try_cast("int").alias("year"), F.regexp_extract("loc", rule, 2).try_cast("int").alias("month")).distinct()


def parse_sitemap(files: DataFrame, xml: str = "xml") -> DataFrame:
    """(loc, lastmod) of URL sets, namespaces ignored."""
    return files.select(F.explode(_tags(F.col(xml), "url")).alias("e")).select(_tag(F.col("e"), "loc").alias("loc"), _tag(F.col("e"), "lastmod").alias("lastmod")).where("loc IS NOT NULL")


def parse_feed(files: DataFrame, xml: str = "xml") -> DataFrame:
    """(link, title, published) of RSS items; the date in RFC 822 form, bad dates null."""
    e = files.select(F.explode(_tags(F.col(xml), "item")).alias("e")).select(_tag(F.col("e"), "link").alias("link"), _tag(F.col("e"), "title").alias("title"), _tag(F.col("e"), "pubDate").alias("d"))
    day = F.regexp_replace(F.regexp_replace("d", r"^\w{3},\s*", ""), r"\s(?:GMT|UTC|UT|Z)$", " +0000")
    return e.where("link IS NOT NULL").select("link", "title", F.try_to_timestamp(day, F.lit("d MMM yyyy HH:mm:ss Z")).alias("published"))


def parse_timemap(pages: DataFrame, body: str = "body", page: str = "page") -> DataFrame:
    """Timemap JSON, whose first row names the columns, to one map a row."""
    rows = pages.select(F.col(page).alias("page"), F.from_json(body, "array<array<string>>").alias("rows"))
    return rows.select("page", F.posexplode("rows").alias("place", "r"), F.element_at("rows", 1).alias("head")).where((F.col("place") > 0) & (F.size("r") == F.size("head"))).select("page", "place", F.map_from_arrays("head", "r").alias("row"))


def parse_posts(posts: DataFrame, body: str = "body") -> DataFrame:
    """(post_date, title, url): of the links in a post within two days of it the one of the best source, the
    last of equals; headlines of fewer than four words go."""
    p = posts.select(F.from_json(body, "struct<date string, title string, links array<struct<url string, date string, priority int>>>").alias("p")).select("p.*")
    p = p.withColumn("at", F.try_to_timestamp("date")).where(F.size(F.split(F.trim("title"), r"\s+")) >= 4)
    links = p.select("at", "title", F.posexplode("links").alias("place", "l")).where(F.abs(F.datediff(F.try_to_timestamp("l.date"), "at")) <= 2)
    return links.groupBy("at", "title").agg(F.min_by("l.url", F.struct("l.priority", -F.col("place"))).alias("url")).withColumnRenamed("at", "post_date")


def parse_segments(answers: DataFrame, body: str = "body") -> DataFrame:
    """Phrase-search answers to (total, shard, start, end), empty segments left out."""
    a = answers.select(F.from_json(body, "struct<count bigint, segment_by_shard array<array<bigint>>>").alias("a"))
    return a.select(F.col("a.count").alias("total"), F.posexplode("a.segment_by_shard").alias("shard", "s")).select("total", "shard", F.element_at("s", 1).alias("start"), F.element_at("s", 2).alias("end")).where("end > start")


def corpus_rows(corpus: DataFrame, year: int, least_tokens: int = 4, least_length: int = 400, language: str = "en") -> DataFrame:
    """Rows of a Parquet corpus (url, url_hostname, warc_filename, publish_date, title, text_length, language)
    that pass every gate; filters that Parquet can use come first, so they are pushed to the scan."""
    ok = (F.col("language") == language) & (F.col("text_length") >= least_length) & (F.col("publish_date") >= f"{year}-01-01") & (F.col("publish_date") < f"{year + 1}-01-01")
    host = F.regexp_replace(F.lower(F.try_parse_url("url", F.lit("HOST"))), r"^www\.", "")
    return corpus.where(ok).where((host == F.regexp_replace(F.lower("url_hostname"), r"^www\.", "")) & F.col("warc_filename").isNotNull() & (F.size(F.regexp_extract_all(F.lower("title"), F.lit("([a-z0-9]+)"), 1)) >= least_tokens)).select("url", "publish_date", "title", "text_length", "warc_filename")


def corpus_offsets(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows, first): rows of each Parquet file and the number of the first one, files by name."""
    from pyspark.sql import Window

    n = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("rows"))
    before = F.sum("rows").over(Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1))
    return n.select("file", "rows", F.coalesce(before, F.lit(0)).alias("first"))


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """(file, rows) of a Parquet folder from the files' footers alone: no page of data is read."""
    names = [r["path"] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path").collect()]

    def count(batches):
        import pyarrow.parquet as pq

        for batch in batches:
            n = []
            for p in batch.column(0).to_pylist():
                fs, inner = _opened(p)
                with fs.open_input_file(inner) as f:
                    n.append(pq.ParquetFile(f).metadata.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], ["file", "rows"])

    return spark.createDataFrame([(n,) for n in names], "file string").repartition(max(1, len(names) // 64)).mapInArrow(count, "file string, rows bigint")


def _opened(path: str):
    """(file system, path in it) of a URI or a local path: local disks, object stores and HDFS, as pyarrow has them."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _stored(folder: str) -> list[str]:
    """JSON pages of a folder, pages in the order of the numbers in their names."""
    from pyarrow import fs

    where, inner = _opened(folder)
    prefix = folder[: len(folder) - len(inner)] if folder.endswith(inner) else ""
    names = [f.path for f in where.get_file_info(fs.FileSelector(inner)) if f.type == fs.FileType.File and f.path.endswith(".json")]
    return [prefix + p for p in sorted(names, key=lambda p: [(0, int(x), "") if x.isdigit() else (1, 0, x) for x in re.split(r"(\d+)", p)])]


class _Page(InputPartition):
    def __init__(self, path: str) -> None:
        self.path = path


def _captures(path: str):
    where, inner = _opened(path)
    with where.open_input_file(inner) as f:
        rows = json.loads(f.read().decode() or "[]")
    name, key = path.rsplit("/", 1)[-1], None
    if rows and rows[0] != CDX_COLUMNS:
        raise ValueError(f"unexpected index header on page {name}")
    key = next((r[0] for r in rows if len(r) == 1), None)
    for k, r in enumerate(rows[1:], 1):
        if len(r) == 6:
            yield (name, k, r[0], r[1], r[2], int(r[3]) if r[3].isdigit() else None, None if r[4] == "-" else r[4], int(r[5]) if r[5].isdigit() else None, key)


class _Reader(DataSourceReader):
    def __init__(self, folder: str) -> None:
        self.folder = folder

    def partitions(self):
        return [_Page(p) for p in _stored(self.folder)]

    def read(self, partition):
        yield from _captures(partition.path)


class _Stream(SimpleDataSourceStreamReader):
    """Pages in order of their number; the offset is the number of pages read, as a resume key is."""

    def __init__(self, folder: str, most: int) -> None:
        self.folder, self.most = folder, most

    def _pages(self) -> list[str]:
        return _stored(self.folder)

    def initialOffset(self):
        return {"page": 0}

    def read(self, start):
        pages = self._pages()[start["page"] : start["page"] + self.most]
        return iter([r for p in pages for r in _captures(p)]), {"page": start["page"] + len(pages)}

    def readBetweenOffsets(self, start, end):
        return iter([r for p in self._pages()[start["page"] : end["page"]] for r in _captures(p)])


class CdxSource(DataSource):
    """spark.read.format("cdx").load(folder) and spark.readStream: a partition, or a turn, for each stored page."""

    @classmethod
    def name(cls):
        return "cdx"

    def schema(self):
        return CDX_SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])

    def simpleStreamReader(self, schema):
        return _Stream(self.options["path"], int(self.options.get("pagesPerTurn", 10)))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(CdxSource)


def parse_search(answers: DataFrame, body: str = "body") -> DataFrame:
    """Distinct (url, published) of search-window answers: the page's and the task's address of each result,
    dated by the address alone; undated ones go."""
    from tidemark.functions import dates

    a = answers.select(F.explode(F.from_json(body, "struct<results array<struct<page struct<url string>, task struct<url string>>>>").getField("results")).alias("r"))
    u = a.select(F.explode(F.array("r.page.url", "r.task.url")).alias("url")).where("url IS NOT NULL").distinct()
    return u.withColumn("published", dates.url_date(F.col("url"))).where("published IS NOT NULL")


def parse_documents(answers: DataFrame, body: str = "body") -> DataFrame:
    """Document answers to typed fields (url, hostname, date, title, length, language, source) and their place."""
    d = F.from_json(body, "struct<doc_ix bigint, doc_len bigint, metadata struct<url string, date string, language string, hostname string, warc_source string, title string>>")
    return answers.select(d.alias("d")).select(F.col("d.doc_ix").alias("place"), F.struct(F.col("d.metadata.url").alias("url"), F.col("d.metadata.hostname").alias("hostname"), F.col("d.metadata.date").alias("date"), F.col("d.metadata.title").alias("title"), F.col("d.doc_len").alias("length"), F.col("d.metadata.language").alias("language"), F.col("d.metadata.warc_source").alias("source")).alias("document"))


def corpus_rows_at(corpus: DataFrame, offsets: DataFrame, wanted: DataFrame) -> DataFrame:
    """Rows of a corpus by their number over its files: wanted (index), offsets as `corpus_offsets` gives them.
    The number of a row is its file's first plus its place in the file, which Parquet knows."""
    numbered = corpus.withColumn("file", F.col("_metadata.file_path")).withColumn("place", F.col("_metadata.row_index")).join(F.broadcast(offsets), "file").withColumn("index", F.col("first") + F.col("place"))
    return numbered.join(wanted, "index").drop("file", "place", "first", "rows")


def known_rows(corpus: DataFrame, urls: DataFrame, key: str = "url") -> DataFrame:
    """Rows of a corpus whose URL is known: a semi join, with Spark's bloom filter where it pays."""
    return corpus.join(urls.select(key), key, "left_semi")


def anchors(pages: DataFrame, html: str = "html") -> DataFrame:
    """(href, text) of every link of the pages, each pair once, for search results stored as pages."""
    found = F.regexp_extract_all(html, F.lit(r"(?is)(<a\s[^>]*href=[^>]*>.*?</a>)"), 1)
    a = pages.select(F.explode(found).alias("a"))
    href = F.regexp_extract("a", r"(?i)href\s*=\s*[\"']?([^\"'\s>]+)", 1)
    return a.select(href.alias("href"), F.trim(F.regexp_replace(F.regexp_replace("a", "<[^>]*>", " "), r"\s+", " ")).alias("text")).where("href <> ''").distinct()
