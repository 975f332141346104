"""Approximate nearest neighbours by a hierarchical k-means tree.

The tree is fitted to at most vectors.SAMPLE vectors: each node's sample is split into BRANCH
clusters until its share of the table is under LEAF vectors or too few sample vectors are left.
Every vector goes to the leaf that greedy descent reaches.  A query visits leaves best bin
first: a priority queue holds the open nodes by their centre's distance.

How many leaves is calibrated: for PROBES queries the true k nearest come from a scan of the
whole table, and visits widen, from one leaf on, until the mean share of true neighbours in the
visited leaves is at TARGET.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import vectors as vs
from tidemark.llm.common import checkpointed

K, BRANCH, LEAF, PROBES, TARGET = 10, 8, 128, 400, 0.95


def _nearest(q: np.ndarray, qid: np.ndarray, k: int, dims: int, kind: str):
    """The k nearest of each probe in a partition, with their leaves."""

    def run(batches):
        who, leaf, dist, ids = (np.zeros(0, t) for t in (np.int64, np.int64, float, np.int64))
        for batch in batches:
            x = vs.matrix(batch.column(1), dims, kind)
            for lo in range(0, len(x), 2048):
                d = np.sqrt(vs.squared(q, x[lo : lo + 2048]))
                own = batch.column(0).to_numpy()[lo : lo + 2048]
                d[qid[:, None] == own[None]] = np.inf
                take = np.argpartition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k]
                a = np.repeat(np.arange(len(q)), take.shape[1])
                b = take.ravel()
                ok = np.isfinite(d[a, b])
                a, b = a[ok], b[ok]
                who, dist, ids = np.append(who, a), np.append(dist, d[a, b]), np.append(ids, own[b])
                leaf = np.append(leaf, batch.column(2).to_numpy()[lo : lo + 2048][b])
                order = np.lexsort((ids, dist, who))
                who, leaf, dist, ids = who[order], leaf[order], dist[order], ids[order]
                keep = np.arange(len(who)) - np.searchsorted(who, who) < k
                who, leaf, dist, ids = who[keep], leaf[keep], dist[keep], ids[keep]
        yield pa.RecordBatch.from_arrays([pa.array(who), pa.array(leaf), pa.array(dist), pa.array(ids)], ["who", "leaf", "dist", "id"])

    return run


def approximate_topk(df: DataFrame, k: int = K, id_col: str = "vec_id", vec_col: str = "embedding", queries: Column | None = None, target: float = TARGET, leaf: int = LEAF, probes: int = PROBES) -> DataFrame:
    """(id, rank, neighbor, distance): of each query the k nearest others in the leaves it visits, by Euclidean
    distance, ties by id.  queries: a condition on df's rows; None makes every vector a query.

    Where the leaves hold fewer than k others, there are fewer rows.  Ids may be of any type; rows that share an id but
    not the vector are vectors of their own, equal rows are one.  What `vectors.read_vectors` leaves out (nulls, NaN,
    other lengths) is neither query nor neighbour.  Vectors of any length are read whole.  An empty table gives an empty
    result; other columns aren't read.
    """
    spark = df.sparkSession
    v = vs.read_vectors(df, id_col, vec_col, queries)
    dims, kind = v.dims, v.kind
    n = v.rows.count()
    if n < 2 or k < 1:
        return v.named(spark.createDataFrame([], vs.RESULT))
    tree = vs.Tree(vs.sampled(v.rows, vs.SAMPLE, dims, kind), n, leaf, BRANCH)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = vs.matrix(batch.column(1), dims, kind)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(tree.descend(x)), pa.array(np.zeros(len(x)))], ["id", "vec", "q", "cell", "r"])

    index = checkpointed(v.rows.mapInArrow(assign, "id long, vec binary, q boolean, cell int, r double"))
    most = calibrate(index, tree, k, target, probes, dims, kind)

    def travel(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = tree.visits(vs.matrix(batch.column("vec"), dims, kind), most)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([row.tobytes() for row in seen], pa.binary())], [*batch.schema.names, "extra"])

    # every query's leaves in order, found once; a block pulls those that one of its queries visits
    asked = vs.blocks(index.where("q").drop("q"), dims, tree.leaves).select("block", "cell", "r", "id", "vec")
    asked = checkpointed(asked.repartition("id").mapInArrow(travel, "block long, cell int, r double, id long, vec binary, extra binary"))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int32).reshape(-1, most)
            block = np.repeat(batch.column(0).to_numpy(), most).reshape(-1, most)
            turn = np.broadcast_to(np.arange(most), seen.shape)
            ok = seen >= 0
            key = np.unique(np.stack([block[ok], seen[ok], turn[ok]], 1), axis=0)
            keep = np.ones(len(key), bool)
            keep[1:] = (key[1:, :2] != key[:-1, :2]).any(1)
            yield pa.RecordBatch.from_arrays([pa.array(key[keep, 0]), pa.array(key[keep, 1].astype(np.int32)), pa.array(key[keep, 2])], ["block", "cell", "turn"])

    needs = asked.select("block", "extra").mapInArrow(leaves, "block long, cell int, turn long").groupBy("block", "cell").agg(F.min("turn").alias("turn"))
    needs = needs.select("block", "cell", (F.col("turn") * tree.leaves + F.col("cell")).alias("turn"), F.lit(0.0).alias("least"), F.lit(0.0).alias("most"))

    def prepare(s: vs.Search):
        seen = np.zeros((len(s.q), tree.leaves + 1), bool)
        np.put_along_axis(seen, np.frombuffer(b"".join(s.extra), np.int32).reshape(-1, most).astype(np.int64), True, axis=1)
        return seen

    def wanted(s: vs.Search, seen: np.ndarray, at: int, lo: float, hi: float) -> np.ndarray:
        return np.flatnonzero(seen[:, at])

    return v.named(vs.searched(index, asked, needs, vs.block_search(dims, kind, k, prepare, wanted)))


def calibrate(index: DataFrame, tree: vs.Tree, k: int, target: float, probes: int, dims: int, kind: str) -> int:
    """Leaves to visit: the least power of two that reaches the target, then the least number under it that does."""
    chosen = index.orderBy(F.xxhash64("id", F.lit(1)), "id").limit(probes).select("id", "vec").collect()
    q = np.frombuffer(b"".join(bytes(r["vec"]) for r in chosen), kind).reshape(-1, dims).astype(np.float64)
    qid = np.array([r["id"] for r in chosen])
    near = index.select("id", "vec", "cell").mapInArrow(_nearest(q, qid, k, dims, kind), "who long, leaf long, dist double, id long")
    order = Window.partitionBy("who").orderBy("dist", "id")
    near = near.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("who", "leaf").collect()
    who, leaf = np.array([r["who"] for r in near]), np.array([r["leaf"] for r in near])
    most = 1
    while True:
        # a query costs its visits, so widening by twos costs at most about twice the last step
        place = np.full((len(q), tree.leaves + 1), tree.leaves)
        seen = tree.visits(q, most).astype(np.int64)
        np.put_along_axis(place, np.where(seen < 0, tree.leaves, seen), np.arange(most)[None].repeat(len(q), 0), axis=1)
        ranks = np.sort(place[who, leaf])
        enough = int(np.ceil(target * len(ranks) - 1e-9))
        if most >= tree.leaves or not enough or ranks[enough - 1] < most:
            return max(1, min(tree.leaves, int(ranks[enough - 1]) + 1)) if enough else 1
        most = min(2 * most, tree.leaves)
