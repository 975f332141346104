"""Deterministic samplers: the same rows on every engine and at every parallelism."""

from __future__ import annotations

import hashlib
import random

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import text
from tidemark.operators.rank import top_per_key


#: Between the parts that are hashed for samples that other tools draw too.
NUL = "\0"


def priority(seed: str, *parts: Column, sep: str = "|") -> Column:
    """The order of samples: SHA-256 of the seed and the parts (publisher if any, stratum, key)."""
    return text.hash_priority(F.lit(seed), *parts, sep=sep)


def by_hash(df: DataFrame, stratum: str, key: str, seed: str, k: int, publisher: str | None = None, sep: str = "|") -> DataFrame:
    """The k rows of each stratum with the least `priority` of seed, publisher (if any), stratum and key."""
    parts = [F.col(stratum), F.col(key)] if publisher is None else [F.lit(publisher), F.col(stratum), F.col(key)]
    return top_per_key(df.withColumn("priority", priority(seed, *parts, sep=sep)), [stratum], ["priority", key], k)


#: Ranges of shards whose lengths are summed before places are found.
RANGES = 4096


def systematic(segments: DataFrame, most: int) -> DataFrame:
    """Places floor((i + 1/2) * total / n) of the segments (shard, start, end) laid end to end: (shard, rank).

    Prefix sums run in two steps: sums of at most RANGES ranges of shard numbers, which alone reach the driver, then
    sums inside a range; no task holds all segments."""
    from pyspark.sql import Window

    spark = segments.sparkSession
    some = segments.where("end > start").withColumn("n", F.col("end") - F.col("start"))
    lo, hi = some.agg(F.min("shard"), F.max("shard")).first()
    if lo is None:
        return some.select("shard", F.col("start").cast("bigint").alias("rank"))
    some = some.withColumn("range", F.floor((F.col("shard") - lo) * F.lit(RANGES) / F.lit(hi - lo + 1)).cast("int"))
    before, total = [], 0
    for r in some.groupBy("range").agg(F.sum("n").alias("n")).orderBy("range").collect():
        before.append((r["range"], total))
        total += r["n"]
    size = min(total, most)
    w = Window.partitionBy("range").orderBy("shard", "start").rowsBetween(Window.unboundedPreceding, -1)
    # a row a range, RANGES at most
    laid = some.join(F.broadcast(spark.createDataFrame(before, "range int, before bigint")), "range").withColumn("base", F.col("before") + F.coalesce(F.sum("n").over(w), F.lit(0)))
    # the draws that fall in a segment follow from its bounds: no join over places
    first = F.ceil(F.col("base") * size / total - 0.5)
    last = F.ceil((F.col("base") + F.col("n")) * size / total - 0.5) - 1
    laid = laid.withColumn("first", F.greatest(F.lit(0), first.cast("bigint"))).withColumn("last", last.cast("bigint")).where("last >= first")
    drawn = laid.withColumn("i", F.explode(F.sequence("first", "last"))).where(F.col("i") < size)
    place = F.least(F.lit(total - 1), F.floor((F.col("i") + 0.5) * total / size))
    return drawn.withColumn("place", place).where("place >= base AND place < base + n").select("shard", (F.col("start") + F.col("place") - F.col("base")).cast("bigint").alias("rank")).distinct()


def seeded(segments: list[tuple[int, int, int]], most: int, seed: str) -> list[tuple[int, int]]:
    """Random places in drawing order, as Python's generator draws them from a hashed seed."""
    total = sum(max(0, e - s) for _, s, e in segments)
    draw = random.Random(int.from_bytes(hashlib.sha256(seed.encode()).digest()[:8], "big")).sample(range(total), min(total, most)) if total else []
    out = []
    for place in draw:
        for shard, start, end in segments:
            if place < max(0, end - start):
                out.append((shard, start + place))
                break
            place -= max(0, end - start)
    return out


def plan(done: DataFrame, pool: DataFrame, stratum: str, key: str, seed: str, target: int, preferred: Column | None = None, sep: str = "|") -> DataFrame:
    """Target and reserve rows a stratum, reserve the larger of 100 and half the target: rows that are done
    first, then the preferred ones of the pool, then the rest; each by hash."""
    reserve = max(100, target // 2)
    both = done.select(stratum, key, F.lit(0).alias("tier")).unionByName(pool.join(done, [stratum, key], "left_anti").select(stratum, key, F.when(preferred, 1).otherwise(2).alias("tier") if preferred is not None else F.lit(2).alias("tier")))
    both = both.withColumn("priority", priority(seed, F.col(stratum), F.col(key), sep=sep))
    return top_per_key(both, [stratum], ["tier", "priority", key], target + reserve, "place").withColumn("reserve", F.col("place") > target)
