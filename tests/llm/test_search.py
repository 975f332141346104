"""Both vector searches against brute force."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import rows
from tidemark.llm import kmeans_tree, pivot_index, vectors

SCHEMA = "vec_id long, embedding array<float>, label int"


def table(spark, n=600, dims=8, seed=1):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(12, dims)) * 3
    x = (centres[r.integers(0, 12, n)] + r.normal(size=(n, dims))).astype(np.float32)
    x[5] = x[6] = x[7]
    return x, spark.createDataFrame([(i, [float(v) for v in row], 0) for i, row in enumerate(x)], SCHEMA)


def brute(x, k):
    x = x.astype(np.float64)
    out = set()
    for i in range(len(x)):
        d = np.sqrt(((x[i] - x) ** 2).sum(1))
        order = [j for j in np.lexsort((np.arange(len(x)), d)) if j != i][:k]
        out |= {(i, r, j) for r, j in enumerate(order, 1)}
    return out


@pytest.mark.parametrize("pivots", [0.05, 2.0, 8.0])
def test_pivot_index_is_exact(spark, pivots, monkeypatch):
    monkeypatch.setattr(vectors, "LEAST_BLOCK", 40)
    x, df = table(spark)
    assert {(i, r, j) for i, r, j, _ in rows(pivot_index.exact_topk(df, 5, pivots=pivots))} == brute(x, 5)
    some = {(i, r, j) for i, r, j, _ in rows(pivot_index.exact_topk(df, 5, pivots=pivots, queries=F.expr("vec_id % 50 = 0")))}
    assert some == {t for t in brute(x, 5) if t[0] % 50 == 0}


@pytest.mark.parametrize("asked", [None, "vec_id % 50 = 0"])
def test_tree_recall(spark, asked):
    x, df = table(spark, 3000)
    got = {(i, j) for i, _, j, _ in rows(kmeans_tree.approximate_topk(df, 5, leaf=64, probes=200, queries=asked and F.expr(asked)))}
    want = {(i, j) for i, _, j in brute(x, 5) if not asked or i % 50 == 0}
    assert len(got & want) >= 0.9 * len(want) and {i for i, _ in got} == {i for i, _ in want}


def test_tree_visits_every_leaf_once_nearest_first():
    x = np.random.default_rng(3).normal(size=(1500, 8))
    tree = vectors.Tree(x, len(x), 64)
    assert tree.leaves > 10
    visits = tree.visits(x[:50], tree.leaves)
    assert (np.sort(visits, 1) == np.arange(tree.leaves)).all()
    assert (tree.visits(x[:50], 3) == visits[:, :3]).all() and (tree.leaf_centres().shape == (tree.leaves, 8))


def test_ids_of_any_type_and_shared_ids(spark):
    x, df = table(spark, 120)
    named = df.selectExpr("concat('v', lpad(vec_id, 3, '0')) AS vec_id", "embedding", "label")
    got = {(int(i[1:]), r, int(j[1:])) for i, r, j, _ in rows(pivot_index.exact_topk(named, 3))}
    assert got == brute(x, 3)
    shared = spark.createDataFrame([(1, [0.0, 0.0], 0), (1, [0.0, 1.0], 0), (2, [0.0, 3.0], 0)], SCHEMA)
    assert sorted(rows(pivot_index.exact_topk(shared, 1))) == [(1, 1, 1, 1.0), (1, 1, 1, 1.0), (2, 1, 1, 2.0)]


@pytest.mark.parametrize("search", [pivot_index.exact_topk, kmeans_tree.approximate_topk])
def test_awkward_vectors(spark, search):
    assert rows(search(spark.createDataFrame([], SCHEMA))) == []
    assert rows(search(spark.createDataFrame([(1, [1.0, 2.0], 0)], SCHEMA))) == []
    odd = [(1, [0.0, 0.0]), (2, [1.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, [1.0]), (6, [float("nan"), 1.0]), (7, [1.0, None]), (None, [0.0, 0.0]), (8, []), (2, [1.0, 0.0])]
    df = spark.createDataFrame([(i, v, "x", 1.0, "y") for i, v in odd], "vec_id long, embedding array<float>, vec string, r double, cell string")
    want = {(1, 1, 2, 1.0), (1, 2, 3, 1.0), (2, 1, 1, 1.0), (3, 1, 1, 1.0)}
    got = set(rows(search(df, 2)))
    assert want < got and len(got) == 6
    same = spark.createDataFrame([(i, [1.0, 1.0], 0) for i in range(40)], SCHEMA)
    got = rows(search(same, 3))
    assert len(got) == 120 and all(d == 0 for *_, d in got)
    if search is pivot_index.exact_topk:
        assert {j for i, _, j, _ in got if i > 5} == {0, 1, 2}
