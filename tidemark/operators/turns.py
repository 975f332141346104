"""Turns over work queues: what is claimed, fetched, parsed and recorded, and when work ends.

A queue is a table (key, status, attempts, error, ...); a turn is a join of the claimed rows with what was fetched for
them, and an upsert.  Fetching itself is the caller's: responses come as a table, so that a turn can be run again.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import dates
from tidemark.operators import rank, state

OPEN = ("pending", "error")
#: Errors after which a row isn't tried again, whatever its attempts.
TERMINAL = ("missing", "gone", "rejected")


def claim(queue: DataFrame, key: str, order: list, most: int, most_attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """(queue, claimed): the first `most` open rows by the order are 'downloading', with one attempt more."""
    chosen = rank.queue(queue, order, most_attempts=most_attempts, states=OPEN, limit=most).select(key)
    marked = queue.join(F.broadcast(chosen.withColumn("tm_claimed", F.lit(True))), key, "left")  # most rows
    mine = F.coalesce("tm_claimed", F.lit(False))
    marked = marked.withColumn("status", F.when(mine, "downloading").otherwise(F.col("status"))).withColumn("attempts", F.col("attempts") + mine.cast("int"))
    return marked.drop("tm_claimed"), marked.where(mine).drop("tm_claimed")


def resume(queue: DataFrame, policy: str | None = None, tiny: Column | None = None) -> DataFrame:
    """A queue after an interruption: rows that were being worked on are open again; where the policy changed, errors of
    the old one are too, from attempt 0; completed rows that are shells (tiny) as well."""
    again = F.col("status") == "downloading"
    fresh = F.lit(False)
    if policy is not None:
        fresh |= (F.col("status") == "error") & ~F.col("policy").eqNullSafe(F.lit(policy))
    if tiny is not None:
        fresh |= (F.col("status") == "complete") & F.coalesce(tiny, F.lit(False))
    out = queue.withColumn("attempts", F.when(fresh, 0).otherwise(F.col("attempts"))).withColumn("status", F.when(again | fresh, "pending").otherwise(F.col("status")))
    return out.withColumn("policy", F.when(fresh, F.lit(policy)).otherwise(F.col("policy"))) if policy is not None else out


def extend(queue: DataFrame, wanted: DataFrame, key: str, fingerprint: str | None = None, stored: str | None = None) -> DataFrame:
    """A queue with the rows of wanted that it lacks, pending; rows that it has stay, also those that are no longer
    wanted.  A fingerprint other than the stored one is refused."""
    if stored is not None and fingerprint != stored:
        raise ValueError("the queue belongs to another specification")
    new = wanted.join(queue.select(key), key, "left_anti").dropDuplicates([key])
    blank = {c: F.lit(None).cast(t) for c, t in queue.dtypes if c not in wanted.columns} | {"status": F.lit("pending"), "attempts": F.lit(0)}
    return queue.unionByName(new.withColumns(blank).select(*queue.columns))


def reset(queue: DataFrame, keys: DataFrame, key: str, why: str) -> DataFrame:
    """Completed rows of these keys are pending again, with the reason as their error; others stay as they are."""
    marked = queue.join(keys.select(key).distinct().withColumn("tm_reset", F.lit(True)), key, "left")
    hit = F.coalesce("tm_reset", F.lit(False)) & (F.col("status") == "complete")
    return marked.withColumn("error", F.when(hit, F.lit(why)).otherwise(F.col("error"))).withColumn("attempts", F.when(hit, 0).otherwise(F.col("attempts"))).withColumn("status", F.when(hit, "pending").otherwise(F.col("status"))).drop("tm_reset")


def settle(queue: DataFrame, outcome: DataFrame, key: str, most_attempts: int = 3) -> DataFrame:
    """A queue after its claimed rows came back: outcome (key, error).  Without an error a row is complete; with one it
    may be tried again until its attempts are spent or the error is terminal, then it is 'exhausted'."""
    done = queue.join(outcome.select(key, F.col("error").alias("tm_error"), F.lit(True).alias("tm_back")), key, "left")
    back = (F.col("status") == "downloading") & F.coalesce("tm_back", F.lit(False))
    over = F.col("tm_error").isin(*TERMINAL) | (F.col("attempts") >= most_attempts)
    status = F.when(~back, F.col("status")).when(F.col("tm_error").isNull(), "complete").when(over, "exhausted").otherwise("error")
    return done.withColumn("error", F.when(back, F.col("tm_error")).otherwise(F.col("error"))).withColumn("status", status).drop("tm_error", "tm_back")


def turn(queue: DataFrame, responses: DataFrame, catalog: DataFrame, key: str, parse: Callable[[DataFrame], DataFrame], catalog_keys: list[str], rules: dict[str, str], order: list, most: int, most_attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """(queue, catalog) after one turn: the first rows are claimed, their responses (key, error, body) parsed, what is found
    upserted to the catalog by its rules, and the rows settled.  A claimed row without a response failed."""
    now, mine = claim(queue, key, order, most, most_attempts)
    got = mine.select(key).join(responses, key, "left").withColumn("error", F.when(F.col("body").isNull(), F.coalesce("error", F.lit("no-response"))).otherwise(F.col("error")))
    found = parse(got.where("error IS NULL")).dropDuplicates(catalog_keys).select(*catalog.columns)
    return settle(now, got, key, most_attempts), state.upsert(catalog, found, catalog_keys, rules)


def work_left(queues: list[DataFrame], done: DataFrame | None = None, target: int | None = None, most_attempts: int = 3) -> DataFrame:
    """One row: whether any queue has a row that can be tried; with done (year, n) and a target only rows whose year is
    under it count, and rows without a year always."""
    rows = None
    for q in queues:
        open_ = q.where(F.col("status").isin(*OPEN, "downloading") & (F.col("attempts") < most_attempts)).select(F.col("year") if "year" in q.columns else F.lit(None).cast("int").alias("year"))
        rows = open_ if rows is None else rows.unionByName(open_)
    if done is not None:
        rows = rows.join(done.select("year", "n"), "year", "left").where(F.col("year").isNull() | (F.coalesce("n", F.lit(0)) < target))
    return rows.agg((F.count("*") > 0).alias("more"))


def close_met(queue: DataFrame, articles: DataFrame, target: int) -> DataFrame:
    """A queue whose open rows are skipped where their year has target distinct articles (year, url)."""
    n = articles.groupBy("year").agg(F.countDistinct("url").alias("tm_n"))
    met = F.coalesce("tm_n", F.lit(0)) >= target
    return queue.join(n, "year", "left").withColumn("status", F.when(met & F.col("status").isin(*OPEN), "skipped").otherwise(F.col("status"))).drop("tm_n")


def scan(files: DataFrame, articles: DataFrame, read: Callable[[DataFrame], DataFrame], target: int, most_files: int, batch: int) -> tuple[DataFrame, DataFrame]:
    """(files, articles) after pending files (path, priority, status) were read, by priority, a batch at a time, until
    there are target distinct articles (url, published) or `most_files` files were read.  An article that is there
    keeps its earliest date.  The loop is over batches of files, not over rows."""
    done, read_ = articles, 0
    while read_ < most_files and done.select("url").distinct().count() < target:
        next_ = files.where("status = 'pending'").orderBy("priority", "path").limit(min(batch, most_files - read_))
        paths = [r["path"] for r in next_.select("path").collect()]  # a batch
        if not paths:
            break
        done = done.unionByName(read(next_).select(*done.columns)).groupBy("url").agg(F.min("published").alias("published"))
        files = files.withColumn("status", F.when(F.col("path").isin(*paths), "complete").otherwise(F.col("status")))
        read_ += len(paths)
    return files, done


def prepend(captures: DataFrame, found: DataFrame, provider: str) -> DataFrame:
    """Captures (url, candidates, status, attempts, ...) with a new first candidate (url, snapshot) unless they have it;
    rows that aren't complete are pending again if they got one."""
    new = F.struct(F.lit(provider).alias("provider"), F.col("tm_snapshot").alias("snapshotUrl"))
    rows = captures.join(found.groupBy("url").agg(F.min("snapshot").alias("tm_snapshot")), "url", "left")
    gets = F.col("tm_snapshot").isNotNull() & ~F.exists("candidates", lambda c: c["snapshotUrl"] == F.col("tm_snapshot"))
    again = gets & (F.col("status") != "complete")
    out = rows.withColumn("candidates", F.when(gets, F.concat(F.array(new), "candidates")).otherwise(F.col("candidates")))
    return out.withColumn("attempts", F.when(again, 0).otherwise(F.col("attempts"))).withColumn("status", F.when(again, "pending").otherwise(F.col("status"))).drop("tm_snapshot")


def hydrate(undated: DataFrame, pages: DataFrame, published: Callable[[Column, Column], Column], most: int, snapshots: int = 3, most_attempts: int = 3) -> tuple[DataFrame, DataFrame]:
    """(queue, dates) of URLs without a date: undated (url, status, attempts, error); pages (url, place, html), their
    captures in order.  The first `most` open URLs are claimed; of the first captures the first date that `published`
    reads (from html and url) counts; URLs without one fail."""
    now, mine = claim(undated, "url", ["attempts", "url"], most, most_attempts)
    seen = mine.select("url").join(pages.where(F.col("place") <= snapshots), "url").withColumn("published", published(F.col("html"), F.col("url")))
    found = seen.where("published IS NOT NULL").groupBy("url").agg(F.min_by("published", "place").alias("published"))
    back = mine.select("url").join(found, "url", "left").select("url", F.when(F.col("published").isNull(), "no-date").alias("error"))
    return settle(now, back, "url", most_attempts), found


def reinfer(rows: DataFrame, first: int, last: int) -> DataFrame:
    """State rows (url, published, ...) whose missing dates are taken from the URL, and those of other years left out;
    rows without any date stay, to be hydrated."""
    shown = F.date_format(dates.url_date(F.col("url")), "yyyy-MM-dd'T'00:00:00+00:00")
    out = rows.withColumn("published", F.coalesce(F.nullif(F.trim("published"), F.lit("")), shown))
    return out.where(F.col("published").isNull() | dates.in_years(F.col("published"), first, last))


def record_validation(samples: DataFrame, results: DataFrame, parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(samples, results) after captures were evaluated: parsed (canonical_url, year, ...) as results has it beside
    sample_year.  Only planned ones count.  A sample moves to the year that its article shows; a result that is there is
    replaced but keeps its sample_year."""
    mine = parsed.join(samples.select("canonical_url", F.col("sample_year").alias("planned")), "canonical_url")
    new = mine.withColumn("sample_year", F.coalesce("year", "planned")).select(*results.columns)
    moved = mine.where("year IS NOT NULL").select("canonical_url", F.col("year").alias("tm_year"))
    samples = samples.join(moved, "canonical_url", "left").withColumn("sample_year", F.coalesce("tm_year", "sample_year")).drop("tm_year")
    return samples, state.upsert(results, new, ["canonical_url"], {"sample_year": "insert_only"})


def action(captures: DataFrame, config: DataFrame, samples: DataFrame, results: DataFrame, most_attempts: int, stop_at_target: bool = False) -> DataFrame:
    """One row: what a capture state still has to do.

    captures (canonical_url, status, attempts, raw_path), config (sample_year, target_size, parser_version), samples
    (canonical_url, sample_year), results (canonical_url, sample_year, parser_version, extraction_status, qa_pass,
    source_capture_sha256).  by_status; actionable: pending, downloading, errors with attempts left and replays; retry:
    only errors are left; unresolved: errors without attempts left; ready: every year has its target, 95 % complete, all
    passed, no errors and no unbound captures; reached: every year has its target; more: whether to go on."""
    from tidemark.operators import joins

    n = lambda c: F.count_if(c)
    c = captures.agg(
        n(F.col("status") == "pending").alias("pending"), n(F.col("status") == "downloading").alias("downloading"), n(F.col("status") == "error").alias("errors"),
        n((F.col("status") == "error") & (F.col("attempts") < most_attempts)).alias("recoverable"),
    )
    per = config.join(results.drop("sample_year").withColumn("sample_year", results["sample_year"]), ["sample_year", "parser_version"], "left").groupBy("sample_year", "target_size").agg(
        F.count("canonical_url").alias("evaluated"), n("qa_pass").alias("passed"), n(F.col("extraction_status") == "complete").alias("complete"), n(F.col("extraction_status") == "error").alias("failed"),
        n(F.col("canonical_url").isNotNull() & F.col("source_capture_sha256").isNull()).alias("unbound"),
    )
    enough = F.col("evaluated") >= F.col("target_size")
    good = enough & (F.col("complete") >= 0.95 * F.col("evaluated")) & (F.col("passed") == F.col("evaluated")) & (F.col("failed") == 0) & (F.col("unbound") == 0)
    years = per.agg(F.coalesce(F.bool_and(good), F.lit(False)).alias("ready"), F.coalesce(F.bool_and(enough), F.lit(False)).alias("reached"))
    again = joins.replays(config, samples, captures, results).agg(F.count("*").alias("replays"))
    one = c.crossJoin(years).crossJoin(again)  # one row each
    actionable = F.col("pending") + F.col("downloading") + F.col("recoverable") + F.col("replays")
    return one.select(
        "pending", "downloading", "errors", "replays", actionable.alias("actionable"), ((F.col("pending") == 0) & (F.col("downloading") == 0) & (F.col("recoverable") > 0)).alias("retry"), "ready", "reached",
        F.greatest(F.lit(0), F.col("errors") - F.col("recoverable")).alias("unresolved"), ((actionable > 0) & ~F.col("ready") & ~(F.lit(stop_at_target) & F.col("reached"))).alias("more"),
    )
