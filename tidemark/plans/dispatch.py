"""Planning: which (publisher, year) cells get work next."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GATES = {"target": 800, "complete": 0.95, "passed": 1.0}


def gates(row: str = "") -> Column:
    """Evaluated enough, complete, without failures, errors or unbound captures; null fails."""
    c = lambda n: F.col(f"{row}.{n}" if row else n)
    ok = (c("evaluated") >= F.greatest(c("target"), F.lit(GATES["target"]))) & (c("complete_rate") >= GATES["complete"]) & (c("qa_pass_rate") >= GATES["passed"]) & (c("errors") == 0) & (c("unbound") == 0)
    return F.coalesce(ok, F.lit(False))


def cohort_number(cohort: Column) -> Column:
    return F.regexp_extract(cohort, r"^holdout-(\d+)$", 1).try_cast("int")


def current_cohort(rows: DataFrame) -> DataFrame:
    """Per (publisher, year) the highest holdout, else validation, else source, else the most evaluated."""
    kind = F.when(cohort_number(F.col("cohort")).isNotNull(), 3).when(F.col("cohort") == "validation", 2).when(F.col("cohort") == "source", 1).otherwise(0)
    order = F.struct(kind, F.coalesce(cohort_number(F.col("cohort")), F.lit(-1)), "evaluated", "cohort")
    return rows.groupBy("publisher", "year").agg(F.max_by(F.struct(*rows.columns), order).alias("r")).select("r.*")


def grid(publishers: DataFrame, first: int, last: int) -> DataFrame:
    return publishers.select("publisher").crossJoin(publishers.sparkSession.range(first, last + 1).select(F.col("id").cast("int").alias("year")))


def dispatch(cells: DataFrame, summaries: DataFrame, active: DataFrame, capacity: DataFrame, slots: int) -> DataFrame:
    """The first cells by need: never evaluated, then least evaluated; not ready, not active, with capacity.
    cells (publisher, year); summaries as `current_cohort` takes them; active (publisher, year);
    capacity (publisher, year, eligible)."""
    latest = current_cohort(summaries)
    open_ = cells.join(active, ["publisher", "year"], "left_anti").join(latest, ["publisher", "year"], "left").join(capacity, ["publisher", "year"], "left")
    todo = open_.where(~gates() & (F.coalesce("eligible", F.lit(0)) > F.coalesce("evaluated", F.lit(0))))
    w = Window.orderBy(F.col("evaluated").isNotNull(), "evaluated", "publisher", "year")
    return todo.orderBy(F.col("evaluated").isNotNull(), "evaluated", "publisher", "year").limit(slots).withColumn("place", F.row_number().over(w)).select("place", "publisher", "year", "cohort", "evaluated")


def shard(publisher: Column, year: Column) -> Column:
    """Where a cell's manifest lies; some publishers are cut into spans of years."""
    span = F.concat((F.floor(year / 5) * 5).cast("string"), F.lit("-"), (F.floor(year / 5) * 5 + 4).cast("string"))
    return F.concat(F.lit("manifests/"), publisher, F.lit("/"), F.when(publisher.isin("reuters", "wsj"), span).otherwise(year.cast("string")), F.lit(".jsonl.gz"))


def should_continue(queue: DataFrame, done: DataFrame, year: str, target: int, most_attempts: int = 3) -> DataFrame:
    """One row: whether a year under target has an item that can still be tried."""
    left = queue.where(F.col("status").isin("pending", "error") & (F.col("attempts") < most_attempts)).join(done, year, "left")
    return left.agg((F.count_if(F.coalesce("n", F.lit(0)) < target) > 0).alias("more"))


def next_cohort(rows: DataFrame) -> DataFrame:
    """(publisher, year, cohort): the holdout after the highest that was seen, current or stale."""
    n = rows.groupBy("publisher", "year").agg(F.max(cohort_number(F.col("cohort"))).alias("n"))
    return n.select("publisher", "year", F.concat(F.lit("holdout-"), (F.coalesce("n", F.lit(0)) + 1).cast("string")).alias("cohort"))


def candidate_bound(rows: DataFrame, capacity: DataFrame) -> DataFrame:
    """(publisher, year, bound): eligible candidates of the newest cohort and what the manifest has beyond those known."""
    order = F.struct(F.coalesce(cohort_number(F.col("cohort")), F.lit(-1)), "evaluated")
    last = rows.groupBy("publisher", "year").agg(F.max_by(F.struct("eligible", "excluded"), order).alias("r"))
    growth = F.greatest(F.lit(0), F.coalesce("capacity", F.lit(0)) - (F.col("r.eligible") + F.col("r.excluded")))
    return last.join(capacity, ["publisher", "year"], "left").select("publisher", "year", (F.col("r.eligible") + growth).alias("bound"))


def catalog_dispatch(targets: DataFrame, status: DataFrame, active: DataFrame, slots: int) -> DataFrame:
    """Catalogs to build next: targets (publisher, first, last, priority) without a status row for the same span,
    then those that are incomplete; not active ones; by priority."""
    done = status.select("publisher", "first", "last", "complete")
    todo = targets.join(active, "publisher", "left_anti").join(done, ["publisher", "first", "last"], "left").where(~F.coalesce("complete", F.lit(False)))
    return todo.orderBy(F.col("complete").isNotNull(), "priority", "publisher", "first").limit(slots)
