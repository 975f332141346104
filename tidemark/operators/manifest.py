"""Manifest algebra: build, merge, filter, summarise."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators.rank import top_per_key

IDENTITY = ("provider", "snapshotUrl", "sourceUrl", "digest", "warcFilename", "warcOffset", "warcLength")


def build(captures: DataFrame, keep: int = 3) -> DataFrame:
    """(url, published, candidates) from (url, published, captured timestamp, snapshot, digest): per URL the
    best captures in order of rank."""
    ranked = captures.withColumn("rank", dates.capture_distance(F.col("captured"), F.col("published")))
    best = top_per_key(ranked, ["url"], ["rank", "captured", "digest", "snapshot"], keep, "place")
    item = F.struct("place", F.col("snapshot").alias("snapshotUrl"), F.date_format("captured", "yyyyMMddHHmmss").alias("capturedAt"), "digest")
    out = best.groupBy("url").agg(F.min("published").alias("published"), F.array_sort(F.collect_list(item)).alias("c"))
    return out.select("url", "published", F.transform("c", lambda x: x.dropFields("place")).alias("candidates"))


def identity(c: Column) -> Column:
    """What makes two candidates the same; missing parts count as blank."""
    return F.struct(*(F.coalesce(c[n].cast("string"), F.lit("")).alias(n) for n in IDENTITY))


def merge(rows: DataFrame) -> DataFrame:
    """One row a URL of (source, ordinal, url, published, section, candidates), as `sources.manifest` reads it.

    The first row's values win and later ones fill blanks.  All of the first row's candidates stay; those of
    later rows are added in order where no earlier one has the same identity.  Each candidate is a row until the
    last step, so that a URL with many of them costs a sort, not a comparison of all with all.
    """
    place = F.struct("source", "ordinal")
    scalars = rows.groupBy("url").agg(*(F.min_by(n, F.when(F.nullif(F.col(n), F.lit("")).isNotNull(), place)).alias(n) for n in ("published", "section")), F.min(place).alias("lead"))
    lead = scalars.select("url", "lead")
    each = rows.join(lead, "url").select("url", place.alias("place"), (place == F.col("lead")).alias("own"), F.posexplode("candidates").alias("at", "c"))
    named = each.withColumn("key", F.sha2(F.to_json(identity(F.col("c"))), 256))
    # all of the first row's stay; of the rest the first of each identity, where the first row hasn't it
    turn = F.row_number().over(Window.partitionBy("url", "key").orderBy("place", "at"))
    kept = named.withColumn("turn", turn).where("own OR turn = 1")
    merged = kept.groupBy("url").agg(F.array_sort(F.collect_list(F.struct("place", "at", "c"))).alias("all"))
    empty = F.array().cast(rows.schema["candidates"].dataType)
    return scalars.drop("lead").join(merged, "url", "left").select("url", "published", "section", F.coalesce(F.transform("all", lambda x: x["c"]), empty).alias("candidates"))


def union_candidates(first: Column, second: Column) -> Column:
    """Candidates of two arrays by snapshot address, blanks dropped, the first of equals."""
    both = F.filter(F.concat(first, second), lambda c: F.coalesce(c["snapshotUrl"], F.lit("")) != "")
    return F.filter(both, lambda c, i: ~F.exists(F.slice(both, F.lit(1), i), lambda e: e["snapshotUrl"] == c["snapshotUrl"]))


def in_years(rows: DataFrame, first: int, last: int, url_date_wins: bool = False) -> DataFrame:
    """Rows published from the first to the last year.  A missing date is taken from the URL; where the
    URL's date wins, it replaces the row's."""
    shown = F.date_format(dates.url_date(F.col("url")), "yyyy-MM-dd'T00:00:00+00:00'")
    own = F.nullif(F.trim("published"), F.lit(""))
    date = F.coalesce(shown, own) if url_date_wins else F.coalesce(own, shown)
    return rows.withColumn("published", date).where(dates.in_years(F.col("published"), first, last))


def summary(rows: DataFrame) -> DataFrame:
    """(year, articles, candidates, missing, invalid): counts by year; the row without a year has the rows
    whose date is missing or has no year."""
    own = F.nullif(F.trim("published"), F.lit(""))
    year = F.nullif(F.regexp_extract(F.coalesce(own, F.lit("")), r"^((?:19|20)\d\d)(?:-|$)", 1), F.lit(""))
    return rows.groupBy(year.cast("int").alias("year")).agg(F.count("*").alias("articles"), F.sum(F.size("candidates")).alias("candidates"), F.count_if(own.isNull()).alias("missing"), F.count_if(own.isNotNull() & year.isNull()).alias("invalid"))


def full_catalog(left: DataFrame, right: DataFrame, right_date_wins: bool) -> DataFrame:
    """Full outer join of two catalogs (url, published, candidates): which date wins is a rule of the source."""
    a, b = left.toDF("url", "pa", "ca"), right.toDF("url", "pb", "cb")
    date = F.coalesce("pb", "pa") if right_date_wins else F.coalesce("pa", "pb")
    empty = F.array().cast(left.schema[2].dataType)
    return a.join(b, "url", "full_outer").select("url", date.alias("published"), union_candidates(F.coalesce("ca", empty), F.coalesce("cb", empty)).alias("candidates"))


def earliest_dates(*catalogs: DataFrame) -> DataFrame:
    """Least date per URL over several catalogs (url, published)."""
    out = catalogs[0].select("url", "published")
    for c in catalogs[1:]:
        out = out.unionByName(c.select("url", "published"))
    return out.groupBy("url").agg(F.min("published").alias("published"))


def drop_reused_digests(rows: DataFrame) -> DataFrame:
    """Of articles (url, digest) whose first digest is the same, the least URL; an empty digest isn't shared."""
    blank = F.coalesce("digest", F.lit("")) == ""
    return rows.where(blank).unionByName(top_per_key(rows.where(~blank), ["digest"], ["url"], 1))


def with_live_fallback(candidates: Column, url: Column, published: Column, as_of_year: int) -> Column:
    """Append the live address of articles published in the given year, unless it is there."""
    live = F.struct(F.lit("live-origin").alias("provider"), url.alias("snapshotUrl"))
    has = F.exists(candidates, lambda c: c["provider"] == "live-origin")
    return F.when((F.year(published) == as_of_year) & ~has, F.array_append(candidates, live)).otherwise(candidates)


def side_catalog(rows: DataFrame, side: DataFrame, before: bool = False) -> DataFrame:
    """Manifest rows (url, published, candidates) and a side catalog of the same form: the manifest's date wins, the
    side's candidates follow its own (or, with before, precede them), each snapshot address once."""
    a, b = rows.select("url", F.col("published").alias("pa"), F.col("candidates").alias("ca")), side.select("url", F.col("published").alias("pb"), F.col("candidates").alias("cb"))
    empty = F.array().cast(rows.schema["candidates"].dataType)
    both = [F.coalesce("ca", empty), F.coalesce("cb", empty)]
    return a.join(b, "url", "full_outer").select("url", F.coalesce("pa", "pb").alias("published"), union_candidates(*(both[::-1] if before else both)).alias("candidates"))


def export(captures: DataFrame, sides: list[DataFrame], first: int, last: int, least_per_year: int, keep: int = 3) -> tuple[DataFrame, DataFrame]:
    """(rows, status) of a source's manifest: its captures ranked by `build`, side catalogs of (url, published,
    candidates) added in order, rows of the years only.  status has one row a year of the range: articles, candidates
    and whether the year is ready."""
    rows = build(captures, keep)
    slim = "array<struct<snapshotUrl string, capturedAt string, digest string>>"
    rows = rows.select("url", F.date_format("published", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("published"), F.col("candidates").cast(slim).alias("candidates"))
    for s in sides:
        rows = side_catalog(rows, s.select("url", "published", F.col("candidates").cast(slim).alias("candidates")))
    rows = rows.where(dates.in_years(F.col("published"), first, last) & (F.size("candidates") > 0))
    n = rows.groupBy(F.substring("published", 1, 4).cast("int").alias("year")).agg(F.count("*").alias("articles"), F.sum(F.size("candidates")).alias("candidates"))
    years = rows.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("year"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    status = years.join(n, "year", "left").select("year", zero("articles"), zero("candidates")).withColumn("ready", F.col("articles") >= least_per_year)
    return rows, status


def hosted_rows(captures: DataFrame, first: int, last: int, keep: int, preferred: Column | None = None, marker: str | None = None, own_dates: bool = True) -> DataFrame:
    """(url, published, candidates) of a wire's hosted pages: captures (url, published, captured, snapshot, digest), the
    preferred ones first, then by distance to publication, then by time and address; `keep` of each URL; articles whose
    first digest an earlier URL has go.  marker: what is noted on each candidate.  Without own dates an article's date
    is that of its earliest capture that is kept."""
    order = F.when(preferred, 0).otherwise(1) if preferred is not None else F.lit(0)
    gap = F.abs(F.col("captured").cast("bigint") - F.col("published").cast("bigint"))
    rows = captures.withColumn("tier", order).withColumn("gap", F.coalesce(gap, F.lit(0)))
    once = top_per_key(rows, ["url", "snapshot"], ["tier", "gap", "captured"], 1)
    best = top_per_key(once, ["url"], ["tier", "gap", "captured", "snapshot"], keep, "place")
    item = F.struct("place", F.col("snapshot").alias("snapshotUrl"), F.date_format("captured", "yyyyMMddHHmmss").alias("capturedAt"), "digest", F.lit(marker).cast("string").alias("validation"))
    date = F.min("published") if own_dates else F.min("captured")
    out = best.groupBy("url").agg(date.alias("published"), F.array_sort(F.collect_list(item)).alias("c"), F.min_by("digest", "place").alias("digest"))
    out = out.where(F.year("published").between(first, last))
    return drop_reused_digests(out).select("url", "published", F.transform("c", lambda x: x.dropFields("place")).alias("candidates"))


def file_hash(spark: SparkSession, path: str) -> str:
    """SHA-256 of a manifest's bytes; of a folder, of its files' hashes in the order of their names."""
    files = spark.read.format("binaryFile").load(path).select(F.regexp_extract("path", "[^/]+$", 0).alias("name"), F.sha2("content", 256).alias("sha256")).orderBy("name").collect()
    import hashlib

    return files[0]["sha256"] if len(files) == 1 else hashlib.sha256("".join(f"{f['sha256']}\n" for f in files).encode()).hexdigest()


def described(rows: DataFrame, path: str, publisher: str) -> DataFrame:
    """One row on a written manifest: articles, candidates, years, missing and invalid dates, and the file's hash."""
    s = summary(rows)
    one = s.agg(F.sum("articles").alias("articles"), F.sum("candidates").alias("candidates"), F.sum("missing").alias("missing"), F.sum("invalid").alias("invalid"), F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("year").isNotNull(), F.struct("year", "articles"))))).alias("years"))
    return one.select(F.lit(publisher).alias("publisher"), "*", F.lit(file_hash(rows.sparkSession, path)).alias("sha256"))


def write_sidecar(row: DataFrame, path: str) -> None:
    """A one-row table as one JSON file beside a manifest."""
    row.limit(1).coalesce(1).write.mode("overwrite").json(path)


def status_row(spark: SparkSession, publisher: str, first: int, last: int, mode: str, complete: bool, ready: bool, more: bool, at: str) -> DataFrame:
    """What a catalog's status sidecar says."""
    return spark.createDataFrame([(STATUS_FORMAT, publisher, first, last, mode, complete, ready, more, at)], "formatVersion string, publisher string, fromYear int, toYear int, manifestMode string, complete boolean, captureReady boolean, shouldContinue boolean, updatedAt string")


def status_matches(s: Column, target: Column) -> Column:
    """Whether a status (a struct as `status_row` has it) is of this form and for this target (publisher, first, last, mode)."""
    ok = (s["formatVersion"] == STATUS_FORMAT) & (s["publisher"] == target["publisher"]) & (s["fromYear"] == target["first"]) & (s["toYear"] == target["last"]) & (s["manifestMode"] == target["mode"])
    return F.coalesce(ok & s["complete"].isNotNull() & s["captureReady"].isNotNull() & s["shouldContinue"].isNotNull(), F.lit(False))


STATUS_FORMAT = "catalog-status/1"
