"""Ranking within keys, work queues and fair interleaving."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_per_key(df: DataFrame, keys: list[str], order: list, k: int, rank: str | None = None) -> DataFrame:
    """The first k rows of each key.  Spark prunes each partition to k rows a key before the shuffle
    (WindowGroupLimit), so a hot key doesn't travel."""
    name = rank or "tm_rank"
    out = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= k)
    return out if rank else out.drop(name)


def round_robin(df: DataFrame, key: str, order: list, limit: int | None = None, descending: bool = False) -> DataFrame:
    """Rows ordered by their rank within the key, then the key: one of each key in turn."""
    ranked = df.withColumn("turn", F.row_number().over(Window.partitionBy(key).orderBy(*order)))
    out = ranked.orderBy("turn", F.desc(key) if descending else F.asc(key))
    return out.limit(limit) if limit is not None else out


def shortfall(df: DataFrame, done: DataFrame, key: str, order: list, target: int) -> DataFrame:
    """Per key only as many rows as it still lacks: rank <= target - done.  done: (key, n)."""
    ranked = top_per_key(df, [key], order, target, "turn")
    return ranked.join(done, key, "left").where(F.col("turn") <= target - F.coalesce("n", F.lit(0))).drop("n")


def prefix_offsets(df: DataFrame, keys: list[str], order: list, n: str) -> DataFrame:
    """Exclusive running sum of n within the keys."""
    w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("first", F.coalesce(F.sum(n).over(w), F.lit(0)))


def queue(df: DataFrame, order: list, attempts: str = "attempts", status: str = "status", most_attempts: int = 3, states: tuple[str, ...] = ("pending", "error"), limit: int | None = None) -> DataFrame:
    """Rows still to be worked on, in order; limit plans a distributed top-k."""
    out = df.where(F.col(status).isin(*states) & (F.col(attempts) < most_attempts)).orderBy(*order)
    return out.limit(limit) if limit is not None else out


def tiers(*conditions: Column) -> Column:
    """The number of the first condition that holds, for sorting."""
    out = F.lit(len(conditions))
    for k, c in reversed(list(enumerate(conditions))):
        out = F.when(c, k).otherwise(out)
    return out


def nearest_order(captured: str, published: str, url: str) -> list[Column]:
    """Sort keys by distance to publication; undated captures last, ties by address."""
    gap = F.abs(F.col(captured).cast("bigint") - F.col(published).cast("bigint"))
    return [F.coalesce(gap, -F.col(captured).cast("bigint")).asc_nulls_last(), F.col(url).asc()]


def per_year_turns(df: DataFrame, year: str, order: list, most: int) -> DataFrame:
    """At most `most` rows, as evenly over the years as they allow: ceil(most / years) of each, then one of each year in
    turn, later years first."""
    years = df.select(year).distinct().count()
    share = -(-most // years) if years else 0
    return top_per_key(df, [year], order, max(1, share), "turn").orderBy("turn", F.desc(year)).limit(most)


def under_target(df: DataFrame, year: str, done: DataFrame, target: int, order: list) -> DataFrame:
    """The first row, by the order, whose year has under target rows done: (year, n)."""
    return df.join(done, year, "left").where(F.coalesce("n", F.lit(0)) < target).drop("n").orderBy(*order).limit(1)
