"""Mixing sources to target weights that change over training.

Each source has a weight schedule over training time t in [0, 1], piecewise linear between
knots and normalised over the sources at each knot.  Its integral D(t) is the share of all
tokens up to t that the source supplies, so the inverse of D tells when a source's n-th token
is due: every document gets the training position of its first token, and a range sort by
position gives the training order.

The number of tokens is the least at which every source is used once in full: the source that
is scarcest against its weights passes once, the others repeat in whole and part passes
(epochs).  So the mixture keeps its weights at every point and no document is left out.

Prefix sums run in two steps: token sums of the 65,536 hash buckets of each source, then sums
inside a bucket; no task holds a whole source.  Only the ids, hashes and counts are shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import checkpointed, fresh, row_keys, sized, text_of

Schedule = dict[str, list[tuple[float, float]]]


def token_count(text: Column) -> Column:
    """Tokens of a text: its runs without white space."""
    return F.regexp_count(text, F.lit(r"\S+")).cast("long")


def flattening(supply: dict[str, int]) -> Schedule:
    """From the sources' natural shares to shares by the square root of their size."""
    total = sum(supply.values())
    root = sum((n / total) ** 0.5 for n in supply.values()) if total else 0
    return {s: [(0.0, n / total), (1.0, (n / total) ** 0.5 / root)] for s, n in supply.items()} if total else {}


def _at(points: list[tuple[float, float]], t: float) -> float:
    points = sorted(points)
    if t <= points[0][0]:
        return points[0][1]
    for (t0, w0), (t1, w1) in zip(points, points[1:]):
        if t <= t1:
            return w0 + (w1 - w0) * (t - t0) / (t1 - t0) if t1 > t0 else w1
    return points[-1][1]


def plan(supply: dict[str, int], schedule: Schedule) -> tuple[dict[str, dict], int]:
    """By source: tokens due (demand) and the pieces of D; and the number of tokens of the whole run."""
    own = {s: p for s, p in schedule.items() if supply.get(s) and p}
    for s, p in own.items():
        if any(w < 0 for _, w in p):
            raise ValueError(f"negative weight of source {s!r}")
    knots = sorted({0.0, 1.0, *(t for p in own.values() for t, _ in p if 0 < t < 1)})
    sums = [sum(_at(p, t) for p in own.values()) for t in knots]
    out: dict[str, dict] = {}
    for s, p in own.items():
        w = [_at(p, t) / n if n else 0.0 for t, n in zip(knots, sums)]
        pieces, area = [], 0.0
        for t0, t1, w0, w1 in zip(knots, knots[1:], w, w[1:]):
            pieces.append((t0, area, w0, (w1 - w0) / (t1 - t0)))
            area += (w0 + w1) / 2 * (t1 - t0)
        if area > 0:
            out[s] = {"pieces": pieces, "area": area}
    tokens = max((supply[s] / x["area"] for s, x in out.items()), default=0.0)
    for s, x in out.items():
        x["demand"] = max(supply[s], round(tokens * x["area"]))
    return out, sum(x["demand"] for x in out.values())


def positions(docs: DataFrame, schedule: Schedule | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """(doc_id, source, epoch, tokens, position), one row for each use of a document, in no order.

    schedule: by source the knots (t, weight); None is `flattening`.  A null source counts as ''.  A source with
    tokens but without a weight above 0 has no part in the run: its documents are left out.  Documents of a source
    without any token are at position 0 of epoch 0, once.  Null and empty texts have 0 tokens and the position of
    the next token; long texts count whole.  Documents of a source are ordered by the hash of their id; ids may be of
    any type, and rows that share one are documents of their own, in the order of their content, so ties don't occur.
    Rows without an id aren't placed.  An empty table gives an empty result; other columns aren't read.
    The schedule is held by source on the driver, so sources must be as few as a person can weigh.
    """
    # rows are keyed after their tokens are counted, so that no text is written
    k = row_keys(_counted(docs, id_col, text_col, source_col))
    return k.named(_positions(k.docs.select(F.col(k.key).alias("doc_id"), "source", "tokens"), schedule), "doc_id")


def _counted(docs: DataFrame, key: str, text_col: str, source_col: str) -> DataFrame:
    return docs.select(F.col(f"`{key}`").alias("doc_id"), F.coalesce(F.col(f"`{source_col}`").cast("string"), F.lit("")).alias("source"), token_count(text_of(text_col)).alias("tokens")).where("doc_id IS NOT NULL")


def _positions(rows: DataFrame, schedule: Schedule | None) -> DataFrame:
    spark = rows.sparkSession
    rows = checkpointed(rows.withColumn("hash", F.md5(F.col("doc_id").cast("string"))).withColumn("bucket", F.substring("hash", 1, 4)))
    sums = rows.groupBy("source", "bucket").agg(F.sum("tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    sums = sums.select("source", "bucket", F.coalesce(before, F.lit(0)).alias("base"))
    supply = {r["source"]: int(r["n"]) for r in rows.groupBy("source").agg(F.sum("tokens").alias("n")).collect()}
    shape, total = plan(supply, flattening(supply) if schedule is None else schedule)
    supply = {s: n for s, n in supply.items() if s in shape or not n}
    piece = "array<struct<t double, c double, w double, m double>>"
    table = spark.createDataFrame([(s, n, shape[s]["demand"] if s in shape else 0, shape[s]["area"] if s in shape else 0.0, shape[s]["pieces"] if s in shape else []) for s, n in supply.items()], f"source string, supply long, demand long, area double, pieces {piece}")
    inner = F.sum("tokens").over(Window.partitionBy("source", "bucket").orderBy("hash", "doc_id").rowsBetween(Window.unboundedPreceding, 0)) - F.col("tokens")
    placed = rows.withColumn("inner", inner).join(sums, ["source", "bucket"]).withColumn("start", F.col("base") + F.col("inner")).join(sized(table), "source")
    last = F.greatest(F.lit(0), F.expr("CASE WHEN demand > 0 THEN (demand - start - 1) DIV supply ELSE 0 END"))
    placed = placed.withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), last.cast("long"))))
    placed = placed.withColumn("x", F.expr("(epoch * supply + start) / nullif(demand, 0) * area"))
    placed = placed.withColumn("p", F.expr("try_element_at(filter(pieces, s -> s.c <= x), -1)")).withColumn("y", F.expr("x - p.c"))
    t = F.expr("CASE WHEN demand = 0 THEN 0D WHEN y <= 0 THEN p.t ELSE p.t + 2 * y / (p.w + sqrt(greatest(0D, p.w * p.w + 2 * p.m * y))) END")
    return placed.select("doc_id", "source", "epoch", "tokens", F.floor(F.least(t, F.lit(1.0)) * F.lit(float(total))).cast("long").alias("position"))


def mix(docs: DataFrame, schedule: Schedule | None = None, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """docs, its columns kept, in training order: each document once for each of its uses.  What `positions` says of
    nulls, empty and long texts, ties, rows that share an id, sources without a weight and empty tables holds here;
    rows without an id come last, once, and other columns may have any name."""
    k = row_keys(docs, id_col)
    key, at, used = fresh(k.docs, "tm_id", "tm_position", "tm_used")
    placed = _positions(_counted(k.docs, k.key, text_col, source_col), schedule).select(F.col("doc_id").alias(key), F.col("position").alias(at))
    placed = placed.groupBy(key).agg(F.collect_list(at).alias(at))
    joined = k.docs.join(placed.hint("shuffle_hash"), F.col(f"`{k.key}`") == F.col(key), "left").withColumn(used, F.col(key).isNotNull() | F.col(f"`{k.key}`").isNull()).where(F.col(used))
    joined = joined.withColumn(at, F.explode_outer(at))
    return joined.orderBy(F.col(at).asc_nulls_last(), F.col(f"`{k.key}`")).select(*[f"`{c}`" for c in docs.columns])


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS source, len(regexp_extract_all(coalesce(text, ''), '\S+'))::BIGINT AS tokens, md5(doc_id::VARCHAR) AS h FROM documents),
c AS (SELECT *, sum(tokens) OVER (PARTITION BY source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) - tokens AS start FROM d),
s AS (SELECT source, sum(tokens) AS supply FROM d GROUP BY source),
p AS (SELECT source, supply, supply / sum(supply) OVER () AS w0 FROM s),
w AS (SELECT *, sqrt(w0) / sum(sqrt(w0)) OVER () AS w1 FROM p),
a AS (SELECT *, (w0 + w1) / 2 AS area FROM w),
n AS (SELECT *, round(max(supply / area) OVER () * area)::BIGINT AS demand FROM a),
t AS (SELECT *, (sum(demand) OVER ())::DOUBLE AS total FROM n),
u AS (SELECT doc_id, c.source, tokens, unnest(range(0, greatest(0, (demand - start - 1)::BIGINT // supply::BIGINT)::BIGINT + 1)) AS epoch, start, supply, demand, area, w0, w1 - w0 AS m, total FROM c JOIN t USING (source)),
x AS (SELECT *, (epoch * supply + start)::DOUBLE / demand * area AS y FROM u)
SELECT doc_id, source, epoch::BIGINT AS epoch, tokens, floor(least(CASE WHEN y <= 0 THEN 0 ELSE 2 * y / (w0 + sqrt(greatest(0, w0 * w0 + 2 * m * y))) END, 1.0) * total)::BIGINT AS position FROM x
"""
