"""Fuzzy, as-of and interval joins, and matching on URL keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text, urls
from tidemark.operators.rank import top_per_key


def title_match(left: DataFrame, right: DataFrame, days: int = 2, least: float = 0.9, least_shared: int = 4, keep: int = 3, same_year: bool = True) -> DataFrame:
    """Pairs of (id, title, day) whose titles share at least `least` of the larger token set and least_shared
    tokens, days apart at most and, if wanted, in one year; per left id the best `keep`.

    Titles of one token set and day are a class, and classes are matched, not their copies: each has the same
    matches, and of a right class only its `keep` least ids can be among them.  Only the rarest tokens of a left class
    are exploded: a match that misses at most (1 - least) of n tokens has one among any n - ceil(least * n) + 1, so
    prefix filtering loses nothing and common words join nothing.  A pair is kept at the first of those that it shares.
    """
    kind = lambda df, id_, day, key: df.where("day IS NOT NULL").select(F.col("id").alias(id_), F.col("day").alias(day), F.array_sort(text.tokens(F.col("title"))).alias("t")).where(F.size("t") >= max(1, least_shared)).select(id_, day, F.array_join("t", " ").alias(key))
    a, b = kind(left, "a", "day_a", "ka"), kind(right, "b", "day_b", "kb")
    first = top_per_key(b, ["kb", "day_b"], [F.asc_nulls_last("b")], keep, "nth").groupBy("kb", "day_b").agg(F.array_sort(F.collect_list(F.struct("nth", "b"))).alias("bs")).select("day_b", "bs", F.split("kb", " ").alias("tb"))
    kinds = a.select("ka", "day_a").distinct()
    count = first.select(F.explode("tb").alias("t")).groupBy("t").agg(F.count("*").alias("n"))
    pool = kinds.select("ka", "day_a", F.explode(F.split("ka", " ")).alias("t")).join(count, "t", "left")
    rare = pool.groupBy("ka", "day_a").agg(F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "t"))).alias("x"))
    need = (F.size("x") - F.ceil(F.size("x") * least - 1e-9) + 1).cast("int")
    rare = rare.select("ka", "day_a", F.col("x.t").alias("ta"), need.alias("need"))
    rare = rare.select("ka", "day_a", "ta", F.posexplode(F.slice("ta", F.lit(1), F.col("need"))).alias("k", "t"))
    # the days around a title are join keys too, so that a common token doesn't pair all times
    near = rare.withColumn("day_b", F.explode(F.sequence(F.date_sub("day_a", days), F.date_add("day_a", days))))
    near = near.where(F.year("day_a") == F.year("day_b")) if same_year else near
    pairs = near.join(first.select("*", F.explode("tb").alias("t")), ["t", "day_b"]).where(~F.arrays_overlap(F.slice("ta", F.lit(1), F.col("k")), "tb"))
    pairs = pairs.withColumn("overlap", text.overlap(F.col("ta"), F.col("tb"), "greatest")).where((F.col("overlap") >= least) & (text.shared(F.col("ta"), F.col("tb")) >= least_shared))
    pairs = pairs.select("ka", "day_a", "overlap", F.abs(F.datediff("day_a", "day_b")).alias("apart"), "bs")
    order = [F.desc("overlap"), "apart", F.asc_nulls_last("b")]
    # the best classes by their least id hold the best ids
    best = top_per_key(pairs.withColumn("b", F.col("bs")[0]["b"]), ["ka", "day_a"], order, keep).select("ka", "day_a", "overlap", "apart", F.explode("bs.b").alias("b"))
    best = top_per_key(best, ["ka", "day_a"], order, keep).groupBy("ka", "day_a").agg(F.collect_list(F.struct("b", "overlap", "apart")).alias("best"))
    return top_per_key(a.join(best, ["ka", "day_a"]).select("a", F.inline("best")), ["a"], order, keep)


def token_pairs(left: DataFrame, right: DataFrame, least: float, over: str = "least") -> DataFrame:
    """(a, b, overlap) of (id, tokens): every pair whose overlap is at least `least`, which is above 0.

    Shared tokens are counted by a join on the token, whose counts are summed before the shuffle; no pair's
    sets are compared, and Spark broadcasts the right side only if its size allows.  Tokens are joined as
    64-bit hashes, and the ids' sizes only to the pairs' counts."""
    token = lambda: F.explode(F.transform("tokens", lambda t: F.xxhash64(t)))
    a = left.select(F.col("id").alias("a"), token().alias("t"))
    b = right.select(F.col("id").alias("b"), token().alias("t"))
    base = {"least": F.least("na", "nb"), "greatest": F.greatest("na", "nb"), "first": F.col("na")}[over]
    pairs = a.join(b, "t").groupBy("a", "b").agg(F.count("*").alias("n"))
    pairs = pairs.join(left.select(F.col("id").alias("a"), F.size("tokens").alias("na")), "a").join(right.select(F.col("id").alias("b"), F.size("tokens").alias("nb")), "b")
    return pairs.withColumn("overlap", F.col("n") / base).where(F.col("overlap") >= least).select("a", "b", "overlap")


def asof(left: DataFrame, right: DataFrame, key: str, at: str, within: int) -> DataFrame:
    """For each left row (id, key, at) the latest right row (ref, key, at) not after it and within so many days; null keys
    and times match none.

    A sort-merge as-of: both sides are unioned and the last right row is carried along each key in time order,
    so a key costs one sort, not a product of its rows."""
    from pyspark.sql import Window

    a = left.select("id", key, at, F.lit(None).cast(right.schema["ref"].dataType).alias("ref"), F.lit(1).alias("side"))
    b = right.where(F.col(key).isNotNull() & F.col(at).isNotNull()).select(F.lit(None).cast(left.schema["id"].dataType).alias("id"), key, at, "ref", F.lit(0).alias("side"))
    w = Window.partitionBy(key).orderBy(at, "side", "ref").rowsBetween(Window.unboundedPreceding, 0)
    seen = F.last(F.when(F.col("side") == 0, F.struct("ref", at)), ignorenulls=True).over(w)
    out = a.unionByName(b).withColumn("seen", seen).where("side = 1")
    near = F.datediff(F.col(at), F.col("seen")[at]) <= within
    return out.select("id", key, at, F.when(near, F.col("seen.ref")).alias("ref"), F.when(near, F.col("seen")[at]).alias("ref_at"))


#: Intervals, at most, that are compared inside each row.
MOST_INTERVALS = 10_000


def rank_intervals(items: DataFrame, intervals: DataFrame, keep: int = 3) -> DataFrame:
    """For each item (id, at) the best intervals (name, start, end): those that hold it first, then by distance,
    later ones before earlier, then the newest.

    intervals is a dimension: its rows become one array that goes with the plan, and each row ranks them in place,
    without a shuffle.  More than MOST_INTERVALS are refused."""
    rows = intervals.select("name", F.col("start").cast("bigint"), F.col("end").cast("bigint")).limit(MOST_INTERVALS + 1).collect()
    if len(rows) > MOST_INTERVALS:
        raise ValueError(f"more than {MOST_INTERVALS} intervals")
    kind = "array<struct<name string, start bigint, end bigint>>"
    table = F.array(*(F.struct(F.lit(r["name"]).alias("name"), F.lit(r["start"]).alias("start"), F.lit(r["end"]).alias("end")) for r in rows)).cast(kind) if rows else F.array().cast(kind)
    at = F.col("at").cast("bigint")
    scored = F.transform(table, lambda s: F.struct(F.when(at < s["start"], s["start"] - at).when(at > s["end"], at - s["end"]).otherwise(0).alias("gap"), (at > s["end"]).cast("int").alias("before"), (-s["end"]).alias("newest"), s["name"].alias("name")))
    best = items.where("at IS NOT NULL").select("id", "at", F.posexplode(F.slice(F.array_sort(scored), 1, keep)).alias("place", "s"))
    return best.select("id", "at", "s.name", "s.gap", (F.col("place") + 1).alias("place"))


def sharing_tokens(expected: DataFrame, found: DataFrame, keep: int) -> DataFrame:
    """(id, position, priority, expected, found) of (id, title) and (position, priority, title): pairs whose titles share a
    token, which is all that an overlap above 0 needs, with their token sets.

    Found titles of one token set overlap with any other alike, so but their first `keep` by priority and position none
    can be among the first `keep` of an id, and only those are joined.  A pair is kept at the first token that it shares."""
    e = expected.select("id", F.array_sort(text.tokens(F.col("title"))).alias("expected"))
    f = found.select("position", "priority", F.array_sort(text.tokens(F.col("title"))).alias("found")).where(F.size("found") > 0)
    f = top_per_key(f.withColumn("kind", F.array_join("found", " ")), ["kind"], [F.asc_nulls_last("priority"), F.asc_nulls_last("position")], keep).drop("kind")
    pairs = e.select("*", F.explode("expected").alias("t")).join(f.select("*", F.explode("found").alias("t")), "t")
    return pairs.where(F.array_intersect("expected", "found")[0] == F.col("t")).drop("t")


# ---- semi and anti joins of the validation tables ----


def pending(samples: DataFrame, captures: DataFrame, results: DataFrame, complete_only: bool = False) -> DataFrame:
    """Planned and captured but not yet evaluated: samples (canonical_url, ...) with a capture and without a result."""
    have = captures.where("status = 'complete'") if complete_only else captures
    return samples.join(have.select("canonical_url"), "canonical_url", "left_semi").join(results.select("canonical_url"), "canonical_url", "left_anti")


def unsampled(captures: DataFrame, samples: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Captures that are neither planned nor excluded."""
    return captures.join(samples.select("canonical_url"), "canonical_url", "left_anti").join(exclusions.select("canonical_url"), "canonical_url", "left_anti")


def drop_unevaluated(samples: DataFrame, results: DataFrame) -> DataFrame:
    """What a delete of samples without a result leaves."""
    return samples.join(results.select("canonical_url"), "canonical_url", "left_semi")


def adopt(samples: DataFrame, results: DataFrame, year: Column) -> DataFrame:
    """Samples, and as samples of `year` those results that aren't planned yet."""
    new = results.join(samples.select("canonical_url"), "canonical_url", "left_anti").select("canonical_url", year.alias("sample_year")).distinct()
    return samples.select("canonical_url", "sample_year").unionByName(new)


def exclusion_split(captures: DataFrame, exclusions: DataFrame, year: Column, first: int, last: int) -> DataFrame:
    """(year, eligible, excluded): captures of each year of the range, without and with an exclusion."""
    out = exclusions.select("canonical_url", F.lit(True).alias("out")).distinct()
    rows = captures.withColumn("year", year).where(F.col("year").between(first, last)).join(out, "canonical_url", "left")
    return rows.groupBy("year").agg(F.count_if(F.col("out").isNull()).alias("eligible"), F.count_if("out").alias("excluded"))


def replays(config: DataFrame, samples: DataFrame, captures: DataFrame, results: DataFrame) -> DataFrame:
    """Complete captures to evaluate again: planned for a year (config: sample_year, target_size, parser_version) whose
    results of that version are under the target, and without such a result."""
    current = results.join(config.select("sample_year", "parser_version"), ["sample_year", "parser_version"])
    n = current.groupBy("sample_year").agg(F.count("*").alias("n"))
    active = config.join(n, "sample_year", "left").where(F.coalesce("n", F.lit(0)) < F.col("target_size")).select("sample_year", "parser_version")
    todo = samples.select("canonical_url", "sample_year").join(active, "sample_year").join(captures.where("status = 'complete' AND raw_path IS NOT NULL").select("canonical_url"), "canonical_url", "left_semi")
    return todo.join(results.select("canonical_url", "parser_version").distinct(), ["canonical_url", "parser_version"], "left_anti")


def corroborated(articles: DataFrame, occurrences: DataFrame, least_length: int) -> DataFrame:
    """Articles (url, index) that an accepted occurrence of the same URL and index, long enough, bears out."""
    ok = occurrences.where((F.col("status") == "accepted") & (F.col("length") >= least_length)).select("url", "index").distinct()
    return articles.join(ok, ["url", "index"], "left_semi")


def hydrated_only(candidates: DataFrame, hydration: DataFrame) -> DataFrame:
    """Candidates but those whose dates are still being looked for."""
    return candidates.join(hydration.where("status <> 'complete'").select("canonical_url"), "canonical_url", "left_anti")


def selected_captures(source: DataFrame, chosen: DataFrame, target: DataFrame) -> DataFrame:
    """The target's captures after complete captures of the chosen URLs were taken over from the source: rows that are
    complete in the target stay as they are."""
    new = source.where("status = 'complete'").join(chosen.select("canonical_url").distinct(), "canonical_url", "left_semi")
    return target.join(new.join(target.where("status = 'complete'").select("canonical_url"), "canonical_url", "left_anti").select("canonical_url"), "canonical_url", "left_anti").unionByName(
        new.join(target.where("status = 'complete'").select("canonical_url"), "canonical_url", "left_anti").select(*target.columns)
    )


def exclude(samples: DataFrame, results: DataFrame, exclusions: DataFrame, urls_: DataFrame, label: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(samples, results, exclusions) after URLs were excluded under a label: overlapping samples and results go."""
    new = urls_.select("canonical_url").where("canonical_url IS NOT NULL").distinct()
    gone = lambda df: df.join(new, "canonical_url", "left_anti")
    return gone(samples), gone(results), gone(exclusions).unionByName(new.withColumn("label", F.lit(label)))


def relax(exclusions: DataFrame, eligible: int, target: int) -> tuple[DataFrame, DataFrame]:
    """(exclusions, relaxed): below the target the exclusions are copied away and lifted, else they stay."""
    return (exclusions.limit(0), exclusions) if eligible < target else (exclusions, exclusions.limit(0))


def preindex(captures: DataFrame, articles: DataFrame, keep: int = 3) -> DataFrame:
    """Index captures (original, captured, digest) matched to articles (url, published) by URL key: sorted by
    distance in time, each digest once, the best `keep`."""
    a = articles.select("url", "published", urls.match_key(F.col("url")).alias("key"))
    c = captures.select("original", "captured", "digest", urls.match_key(F.col("original")).alias("key"))
    pairs = a.join(c, "key").withColumn("gap", F.abs(F.col("captured").cast("bigint") - F.col("published").cast("bigint")))
    once = top_per_key(pairs, ["url", "digest"], [F.asc_nulls_last("gap"), "captured", "original"], 1)
    return top_per_key(once, ["url"], [F.asc_nulls_last("gap"), "captured", "original"], keep, "place").select("url", "original", "captured", "digest", "place")


def by_overlap(pairs: DataFrame, expected: str, found: str, least: float = 0.35, keep: int = 8) -> DataFrame:
    """Search results (id, position, priority, both titles) by falling overlap, priority and position.  Titles are texts
    or, where they are made already, arrays of tokens."""
    e, f = (F.col(c) if dict(pairs.dtypes)[c].startswith("array") else text.tokens(F.col(c)) for c in (expected, found))
    share = text.overlap(e, f, "least")
    return top_per_key(pairs.withColumn("overlap", share).where(F.col("overlap") >= least), ["id"], [F.desc("overlap"), F.asc_nulls_last("priority"), F.asc_nulls_last("position")], keep, "place")


def best_original(rows: DataFrame, least: float = 0.8, least_shared: int = 4) -> DataFrame:
    """Per id the URL whose title (found) covers the expected one best, the least position of equals; below the limits
    none.  Titles are texts or, where they are made already, arrays of tokens."""
    e, f = (F.col(c) if dict(rows.dtypes)[c].startswith("array") else text.tokens(F.col(c)) for c in ("expected", "found"))
    scored = rows.withColumn("coverage", text.overlap(e, f, "first")).where((F.col("coverage") >= least) & (text.shared(e, f) >= least_shared))
    return scored.groupBy("id").agg(F.max_by("url", F.struct("coverage", -F.col("position"))).alias("url"), F.max("coverage").alias("coverage"))


def verdict(body_length: Column, overlap: Column, days: Column, attributed: Column, date_visible: Column, least_body: int = 400, least_overlap: float = 0.8, most_days: int = 2) -> Column:
    """Why a fetched copy isn't the article, the first reason that holds; null where it is."""
    return F.when(body_length < least_body, "short-body").when(~attributed, "no-attribution").when(overlap < least_overlap, "headline-differs").when(~(F.coalesce(days <= most_days, F.lit(False)) | date_visible), "date-differs")
