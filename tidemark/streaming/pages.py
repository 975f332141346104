"""Streams: index pages applied to state, and event-time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import dates, urls
from tidemark.operators.rank import top_per_key
from tidemark.operators.state import read_state, write_state

STATE = "url string, published timestamp, snapshot string, captured timestamp, digest string"


def candidates(captures: DataFrame, url: Column | None = None) -> DataFrame:
    """Captures (timestamp, original, status, mimetype, digest) that are pages, as state rows."""
    u = F.col("original") if url is None else url
    rows = captures.where((F.coalesce("status", F.lit(200)) == 200) & F.col("mimetype").startswith("text/html")).select(u.alias("url"), dates.url_date(u).cast("timestamp").alias("published"), F.concat(F.lit("https://web.archive.org/web/"), "timestamp", F.lit("id_/"), "original").alias("snapshot"), dates.stamp(F.col("timestamp")).alias("captured"), "digest")
    return rows.where("url IS NOT NULL AND captured IS NOT NULL")


def apply(state: DataFrame, batch: DataFrame, keep: int = 3) -> DataFrame:
    """State and batch, each snapshot once, trimmed to the best per URL.  Applying a batch twice changes nothing."""
    both = state.unionByName(batch).dropDuplicates(["url", "snapshot"])
    both = both.withColumn("rank", dates.capture_distance(F.col("captured"), F.col("published")))
    return top_per_key(both, ["url"], ["rank", "captured", "digest", "snapshot"], keep).drop("rank")


def page_stream(pages: DataFrame, folder: str, checkpoint: str, rule: urls.SourceRule | None = None, keep: int = 3) -> StreamingQuery:
    """Apply each micro-batch of index captures to the state in folder and write the next version."""

    def turn(batch: DataFrame, number: int) -> None:
        if batch.isEmpty():
            return
        spark = batch.sparkSession
        url = urls.normalize(rule, F.col("original")) if rule else None
        write_state(apply(read_state(spark, folder, STATE), candidates(batch, url), keep), folder)

    return pages.writeStream.foreachBatch(turn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed(events: DataFrame, ts: str, keys: list[str], width: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts and sums in event-time windows, on a table or a stream; a stream drops rows later than `late`."""
    e = events.withColumn(ts, F.col(ts).cast("timestamp"))
    if events.isStreaming:
        e = e.withWatermark(ts, late)
    return e.groupBy(F.window(ts, width).alias("w"), *keys).agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), *keys, "n", "total")
