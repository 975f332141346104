"""What both vector searches share: reading, a bounded k-means, and the block search.

Queries are grouped into blocks of near vectors.  A plan says which cells of the index each
block pulls; the pulled vectors stream through the block's task in order of promise, so the
task holds the block's queries, the best k of each and one batch, however much it pulls, and
the result needs no merge.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import Keyed, checkpointed, row_keys

CHUNK = 1024  # vectors compared at once
SAMPLE = 65_536  # vectors, at most, that pivots and trees are fitted to; every vector is indexed
BLOCK_BYTES = 4 << 20  # query vectors, as doubles, that a task holds
BOUND_BYTES = 32 << 20  # and what it holds of each query and cell
LEAST_BLOCK = 64  # queries of a block, where there are as many

RESULT = "id long, rank int, neighbor long, distance double"


@dataclass
class Vectors:
    rows: DataFrame  # (id as a long key, vec as bytes, q: is it a query)
    dims: int
    kind: str  # numpy's name of the type
    keys: Keyed

    def named(self, found: DataFrame) -> DataFrame:
        return self.keys.named(found, "id", "neighbor")


def read_vectors(df: DataFrame, id_col: str, vec_col: str, queries: Column | None) -> Vectors:
    """Vectors of the commonest length (the shorter of equals), queries those rows for which `queries` is true.
    Null ids and vectors, vectors with nulls, NaN or infinities and of other lengths are left out; equal rows
    count once, rows that share an id but not the vector each."""
    kind = "f4" if dict(df.dtypes)[vec_col] == "array<float>" else "f8"
    width = "float" if kind == "f4" else "double"
    asked = F.lit(True) if queries is None else F.coalesce(queries, F.lit(False))
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{vec_col}`").cast(f"array<{width}>").alias("v"), asked.alias("q")).where("id IS NOT NULL AND v IS NOT NULL AND size(v) > 0")
    rows = rows.where("NOT exists(v, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))")
    sizes = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    dims = sizes[0]["n"] if sizes else 0

    def flat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column(1).flatten().to_numpy().astype(kind)
                off = np.arange(batch.num_rows + 1, dtype=np.int32) * (dims * x.itemsize)
                vec = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, pa.py_buffer(off.tobytes()), pa.py_buffer(x.tobytes())])
                yield pa.RecordBatch.from_arrays([batch.column(0), vec, batch.column(2)], ["id", "vec", "q"])

    own = dict(rows.dtypes)["id"]
    rows = rows.where(F.size("v") == dims).mapInArrow(flat, f"id {own}, vec binary, q boolean")
    keys = row_keys(checkpointed(rows.groupBy("id", "vec").agg(F.max("q").alias("q"))), "id")
    return Vectors(keys.docs.select(F.col(f"`{keys.key}`").alias("id"), "vec", "q"), dims, kind, keys)


def matrix(column: pa.Array, dims: int, kind: str) -> np.ndarray:
    if not len(column):
        return np.zeros((0, dims))
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(-1, dims).astype(np.float64)


def sampled(rows: DataFrame, n: int, dims: int, kind: str) -> np.ndarray:
    """At most n vectors by the hash of their id; duplicates once."""
    got = rows.orderBy(F.xxhash64("id"), "id").limit(n).collect()
    x = np.frombuffer(b"".join(bytes(r["vec"]) for r in got), kind).reshape(-1, dims).astype(np.float64)
    _, first = np.unique(x, axis=0, return_index=True)
    return x[np.sort(first)]


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances up to rounding."""
    return np.maximum((a * a).sum(1)[:, None] + (b * b).sum(1)[None] - 2 * a @ b.T, 0)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of equal rows, summed the same way wherever they are computed."""
    return np.sqrt(((a - b) ** 2).sum(1))


def kmeans(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Centres; the first k rows start, an empty centre stays where it is."""
    c = x[:k].copy()
    for _ in range(rounds):
        near = np.concatenate([squared(x[i : i + 4096], c).argmin(1) for i in range(0, len(x), 4096)])
        n = np.bincount(near, minlength=len(c))
        order = np.argsort(near, kind="stable")
        some = np.flatnonzero(n)
        c[some] = np.add.reduceat(x[order], (np.cumsum(n) - n)[some], axis=0) / n[some, None]
    return c


class Tree:
    """Hierarchical k-means in arrays: centres, and the range of each node's children; leaves are numbered so that
    neighbours in the tree have near numbers.  A node of the sample x, that stands for n vectors, is split into
    `branch` clusters until its share is under `leaf` vectors or it has no more than LEAST_SAMPLE sample vectors."""

    LEAST_SAMPLE = 4

    def __init__(self, x: np.ndarray, n: int, leaf: float, branch: int = 8) -> None:
        self.centres, self.children, self.leaf = [x.mean(0)], [(0, 0)], [-1]
        todo, leaves = [(0, x)], 0
        while todo:
            at, part = todo.pop()
            parts = []
            if len(part) * n / len(x) > leaf and len(part) > self.LEAST_SAMPLE:
                c = kmeans(part, min(branch, len(part)))
                near = squared(part, c).argmin(1)
                parts = [part[near == i] for i in range(len(c)) if (near == i).any()]
            if len(parts) < 2:
                self.leaf[at], leaves = leaves, leaves + 1
                continue
            first = len(self.centres)
            self.children[at] = (first, first + len(parts))
            for p in parts:
                todo.append((len(self.centres), p))
                self.centres.append(p.mean(0))
                self.children.append((0, 0))
                self.leaf.append(-1)
        self.centres, self.leaves = np.array(self.centres), leaves

    def leaf_centres(self) -> np.ndarray:
        out = np.empty((self.leaves, self.centres.shape[1]))
        at = np.flatnonzero(np.array(self.leaf) >= 0)
        out[np.array(self.leaf)[at]] = self.centres[at]
        return out

    def descend(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector."""
        out = np.zeros(len(x), np.int32)
        todo = [(0, np.arange(len(x)))]
        while todo:
            at, rows = todo.pop()
            a, b = self.children[at]
            if a == b:
                out[rows] = self.leaf[at]
                continue
            near = squared(x[rows], self.centres[a:b]).argmin(1)
            todo += [(a + i, rows[near == i]) for i in range(b - a) if (near == i).any()]
        return out

    def visits(self, q: np.ndarray, most: int) -> np.ndarray:
        """The first leaves of each query, best bin first; -1 where there are no more.  Only the children of opened
        nodes are compared, so a query costs its visits times the depth, not the size of the tree."""
        out = np.full((len(q), most), -1, np.int32)
        for i, x in enumerate(q):
            heap, done = [(0.0, 0)], 0
            while heap and done < most:
                _, at = heapq.heappop(heap)
                a, b = self.children[at]
                if a == b:
                    out[i, done] = self.leaf[at]
                    done += 1
                else:
                    gap = self.centres[a:b] - x
                    for c, d in enumerate(np.einsum("ij,ij->i", gap, gap).tolist(), a):
                        heapq.heappush(heap, (d, c))
        return out


class Search:
    """The queries of one block and the best k of each so far."""

    def __init__(self, block: int, k: int) -> None:
        self.block, self.k = block, k
        self.ids: list[np.ndarray] = []
        self.vecs: list[np.ndarray] = []
        self.extra: list[bytes | None] = []
        self.q: np.ndarray | None = None

    def start(self) -> None:
        self.qid, self.q = np.concatenate(self.ids), np.concatenate(self.vecs)
        n = len(self.qid)
        self.found, self.dist = np.zeros((n, self.k), np.int64), np.full((n, self.k), np.inf)
        self.tau = np.full(n, np.inf)

    def compare(self, which: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        for lo in range(0, len(which), CHUNK):
            self._compare(which[lo : lo + CHUNK], ids, x)

    def _compare(self, which: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        d = squared(self.q[which], x)
        limit = self.tau[which] ** 2
        if len(ids) > self.k and np.isinf(limit).any():  # one more than k, for the query itself
            limit = np.minimum(limit, np.partition(d, self.k, axis=1)[:, self.k])
        scale = (self.q[which] ** 2).sum(1) + (x * x).sum(1).max(initial=0)
        a, b = np.nonzero(d <= (limit + 1e-12 * scale)[:, None])
        other = self.qid[which[a]] != ids[b]
        a, b = which[a[other]], b[other]
        if not len(a):
            return
        exact = np.concatenate([distance(self.q[a[i : i + 65536]], x[b[i : i + 65536]]) for i in range(0, len(a), 65536)])
        rows = np.unique(a)
        who = np.concatenate([np.repeat(rows, self.k), a])
        found, dist = np.concatenate([self.found[rows].ravel(), ids[b]]), np.concatenate([self.dist[rows].ravel(), exact])
        order = np.lexsort((found, dist, who))
        who, found, dist = who[order], found[order], dist[order]
        rank = np.arange(len(who)) - np.searchsorted(who, who)
        keep = rank < self.k
        self.found[who[keep], rank[keep]] = found[keep]
        self.dist[who[keep], rank[keep]] = dist[keep]
        self.tau[rows] = np.minimum(self.tau[rows], self.dist[rows, -1])

    def result(self) -> pa.RecordBatch:
        if self.q is None:
            self.start()
        who, rank = np.nonzero(np.isfinite(self.dist))
        return pa.RecordBatch.from_arrays([pa.array(self.qid[who]), pa.array((rank + 1).astype(np.int32)), pa.array(self.found[who, rank]), pa.array(self.dist[who, rank])], ["id", "rank", "neighbor", "distance"])


def block_search(dims: int, kind: str, k: int, prepare: Callable, wanted: Callable):
    """Rows (block, turn, cell, r, id, vec, extra) sorted by block, turn and r; turn -1 has the queries.
    prepare(search) -> anything; wanted(search, that, cell, least r, largest r) -> queries to compare."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: Search | None = None
        ready = None
        for batch in batches:
            block, turn, cell, r, ids = (batch.column(i).to_numpy() for i in range(5))
            x = matrix(batch.column(5), dims, kind)
            new = np.ones(len(block), bool)
            new[1:] = (block[1:] != block[:-1]) | (turn[1:] != turn[:-1])
            cuts = np.append(np.flatnonzero(new), len(block))
            for a, z in zip(cuts, cuts[1:]):
                if now is None or block[a] != now.block:
                    if now is not None:
                        yield now.result()
                    now = Search(int(block[a]), k)
                if turn[a] < 0:
                    now.ids.append(ids[a:z])
                    now.vecs.append(x[a:z])
                    now.extra += batch.column(6).slice(a, z - a).to_pylist()
                    continue
                if now.q is None:
                    now.start()
                    ready = prepare(now)
                for i in range(a, z, CHUNK):
                    j = min(i + CHUNK, z)
                    which = wanted(now, ready, int(cell[a]), r[i], r[j - 1])
                    if len(which):
                        now.compare(which, ids[i:j], x[i:j])
        if now is not None:
            yield now.result()

    return run


def searched(index: DataFrame, asked: DataFrame, plan: DataFrame, run: Callable) -> DataFrame:
    """index: (id, vec, cell, r); asked, the queries: (block, cell, r, id, vec, extra bytes); plan: (block, cell, turn,
    least, most), the vectors that blocks pull."""
    own = asked.select("block", F.lit(-1).cast("long").alias("turn"), "cell", "r", "id", "vec", "extra")
    pulled = plan.join(index.select("id", "vec", "cell", "r"), "cell").where("r BETWEEN least AND most").select("block", "turn", "cell", "r", "id", "vec", F.lit(None).cast("binary").alias("extra"))
    rows = own.unionByName(pulled).repartition("block").sortWithinPartitions("block", "turn", "r")
    return rows.mapInArrow(run, RESULT)


def blocks(asked: DataFrame, dims: int, cells: int) -> DataFrame:
    """Add block to queries (id, vec, cell, r): neighbouring cells together, larger cells in parts by hash.  What is
    pulled grows with the number of blocks, so they are as large as a task's memory and the cores' number allow."""
    spark = asked.sparkSession
    sizes = {r["cell"]: r["count"] for r in asked.groupBy("cell").count().collect()}
    most = min(BLOCK_BYTES // (8 * dims), BOUND_BYTES // (8 * cells), max(LEAST_BLOCK, -(-sum(sizes.values()) // spark.sparkContext.defaultParallelism)))
    most = max(1, most)
    table, block, held = [], 0, 0
    for c in sorted(sizes):
        if held and held + sizes[c] > most:
            block, held = block + 1, 0
        parts = -(-sizes[c] // most)
        table.append((c, block, parts))
        block, held = (block + parts, 0) if parts > 1 else (block, held + sizes[c])
    known = spark.createDataFrame(table, "cell int, base long, parts int")
    # one row a cell, and cells are at most a quarter of SAMPLE
    return asked.join(F.broadcast(known), "cell").withColumn("block", F.col("base") + F.expr("pmod(xxhash64(id), parts)")).drop("base", "parts")
