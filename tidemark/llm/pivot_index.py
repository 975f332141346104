"""Exact top-k search by a pivot-distance index.

Each vector is keyed by its nearest pivot and its distance to it, so a pivot's cell is sorted
by distance.  A query that is d from a pivot can have a neighbour within t only in the annulus
[d - t, d + t] of that cell (triangle inequality), and only where half of how much nearer its
own pivot is doesn't exceed t.  Queries near each other form a block.  A first search in the
cells of the block's own queries bounds t; then the block pulls the annuli that one of its
queries needs and reads them from the nearest outward, comparing only the queries whose bound,
shrinking as it reads, still allows it.

There are about PIVOTS times the root of the number of vectors pivots, at most a quarter of the
sample of vectors.SAMPLE that they are fitted to (the leaves of a k-means tree); every vector is
indexed, and the result is exact whatever the pivots are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import vectors as vs
from tidemark.llm.common import checkpointed

K, PIVOTS = 10, 2.0
PLAN_ROWS = 256  # queries whose bounds are found at once


def _assign(pivots: np.ndarray, dims: int, kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell, r = [np.zeros(0, np.int32)], [np.zeros(0)]
            for lo in range(0, batch.num_rows, 1024):
                x = vs.matrix(batch.column(1).slice(lo, 1024), dims, kind)
                c = vs.squared(x, pivots).argmin(1)
                cell.append(c.astype(np.int32))
                r.append(vs.distance(x, pivots[c]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(cell)), pa.array(np.concatenate(r))], ["id", "vec", "q", "cell", "r"])

    return run


def _bounds(to: np.ndarray, own: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Least possible distance of queries (their distances to pivots, to their own pivot) to vectors with r in [least, most]."""
    return np.maximum(np.maximum(to - most, least - to), (to - own) / 2)


def _slack(t: np.ndarray) -> np.ndarray:
    return t * (1 + 1e-6) + 1e-6


def exact_topk(df: DataFrame, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", queries: Column | None = None, pivots: float = PIVOTS) -> DataFrame:
    """(id, rank, neighbor, distance): the k nearest other vectors of each query, by Euclidean distance, ties by id.
    queries: a condition on df's rows; None makes every vector a query.

    Fewer than k others give fewer rows; repeated vectors are neighbours at distance 0.  Ids may be of any type; rows
    that share an id but not the vector are vectors of their own, equal rows are one.  What `vectors.read_vectors`
    leaves out (nulls, NaN, other lengths) is neither query nor neighbour.  Vectors of any length are read whole.
    An empty table gives an empty result; other columns aren't read.
    """
    spark = df.sparkSession
    v = vs.read_vectors(df, id_col, vec_col, queries)
    dims, kind = v.dims, v.kind
    n = v.rows.count()
    if n < 2 or k < 1:
        return v.named(spark.createDataFrame([], vs.RESULT))
    sample = vs.sampled(v.rows, vs.SAMPLE, dims, kind)
    points = vs.Tree(sample, n, n / min(max(2, pivots * n**0.5), len(sample) / 4)).leaf_centres()
    index = checkpointed(v.rows.mapInArrow(_assign(points, dims, kind), "id long, vec binary, q boolean, cell int, r double"))
    stats = {r["cell"]: (r["lo"], r["hi"]) for r in index.groupBy("cell").agg(F.min("r").alias("lo"), F.max("r").alias("hi")).collect()}
    cells = np.array(sorted(stats))
    least, most = (np.array([stats[c][i] for c in cells]) for i in (0, 1))
    asked = vs.blocks(index.where("q").drop("q"), dims, len(points))

    def anything(s: vs.Search, ready, at: int, lo: float, hi: float) -> np.ndarray:
        return np.arange(len(s.q))

    own = asked.select("block", "cell", F.lit(0).cast("long").alias("turn"), F.lit(0.0).alias("least"), F.lit(float("inf")).alias("most")).distinct()
    none = F.lit(None).cast("binary").alias("extra")
    near = vs.searched(index, asked.select("*", none), own, vs.block_search(dims, kind, k, lambda s: None, anything))
    bound = near.where(F.col("rank") == k).select("id", F.col("distance").alias("t"))
    asked = checkpointed(asked.join(bound, "id", "left").withColumn("t", F.coalesce("t", F.lit(float("inf")))))

    def plan(pdf: pd.DataFrame) -> pd.DataFrame:
        """What one block pulls."""
        x = np.frombuffer(b"".join(pdf["vec"]), kind).reshape(-1, dims).astype(np.float64)
        own, t = pdf["r"].to_numpy(), pdf["t"].to_numpy()
        first, lo, hi = np.full(len(cells), np.inf), np.full(len(cells), np.inf), np.full(len(cells), -np.inf)
        for i in range(0, len(x), PLAN_ROWS):
            part = slice(i, i + PLAN_ROWS)
            to = np.sqrt(vs.squared(x[part], points[cells]))
            limit = _slack(t[part])[:, None]
            bound = _bounds(to, own[part, None], least, most)
            need = bound <= limit
            first = np.minimum(first, bound.min(0))
            lo = np.minimum(lo, np.where(need, to - limit, np.inf).min(0))
            hi = np.maximum(hi, np.where(need, to + limit, -np.inf).max(0))
        turn = np.empty(len(cells), np.int64)
        turn[np.lexsort((cells, first, ~np.isin(cells, pdf["cell"])))] = np.arange(len(cells))
        pick = lo < np.inf
        pick |= hi > -np.inf
        return pd.DataFrame({"block": pdf["block"].iloc[0], "cell": cells[pick], "turn": turn[pick], "least": lo[pick], "most": hi[pick]})

    needs = checkpointed(asked.groupBy("block").applyInPandas(plan, "block long, cell int, turn long, least double, most double"))

    def bytes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = [x.tobytes() for x in batch.column("t").to_numpy()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("block", "cell", "r", "id", "vec")), pa.array(t, pa.binary())], ["block", "cell", "r", "id", "vec", "extra"])

    asked = asked.select("block", "cell", "r", "id", "vec", "t").mapInArrow(bytes_of, "block long, cell int, r double, id long, vec binary, extra binary")

    def prepare(s: vs.Search):
        s.tau = _slack(np.frombuffer(b"".join(s.extra), np.float64))
        to = np.sqrt(vs.squared(s.q, points))
        return to, to.min(1)

    def wanted(s: vs.Search, ready, at: int, lo: float, hi: float) -> np.ndarray:
        to, own = ready
        return np.flatnonzero(_bounds(to[:, at], own, lo, hi) <= _slack(s.tau))

    return v.named(vs.searched(index, asked, needs, vs.block_search(dims, kind, k, prepare, wanted)))


#: The query set of the registered query: every vector whose id is divisible by 50, against all.
ORACLE_SQL = """
WITH v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT a.vec_id, b.vec_id AS neighbor_id, row_number() OVER (PARTITION BY a.vec_id ORDER BY list_distance(a.e, b.e), b.vec_id) AS rank FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0)
SELECT vec_id, rank::INT AS rank, neighbor_id FROM p WHERE rank <= 10
"""
