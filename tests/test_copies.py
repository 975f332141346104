"""Joins on many copies of few texts: the whole result, without a row for each pair of copies."""

import datetime

from pyspark.sql import functions as F

from tidemark import registry
from tidemark.operators import joins


def most_rows(spark, df):
    """The rows of df, and the most rows that any operator of its plan put out."""
    rows = df.collect()
    store = spark._jsparkSession.sharedState().statusStore()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    k = store.executionsList().last().executionId()
    nodes, values, most = store.planGraph(k).allNodes(), store.executionMetrics(k), 0
    for i in range(nodes.size()):
        metrics = nodes.apply(i).metrics()
        for m in (metrics.apply(j) for j in range(metrics.size())):
            if m.name() == "number of output rows" and values.contains(m.accumulatorId()):
                most = max(most, int(values.apply(m.accumulatorId()).replace(",", "")))
    return rows, most


def test_title_match_of_copies(spark):
    """Each copy has the same matches, of which none but the least ids can be kept: no pairs of copies are made."""
    day = datetime.date(2020, 12, 31)
    titles = [(i, f"red ring t{i % 3}", day + datetime.timedelta(days=i % 2)) for i in range(3000)] + [(None, "red ring t0", day)]
    df = spark.createDataFrame(titles, "id int, title string, day date")
    rows, most = most_rows(spark, joins.title_match(df, df, 2, 0.75, 2, 3, same_year=False))
    got = {}
    for r in rows:
        got.setdefault(r.a, []).append((r.overlap, r.apart, r.b))
    assert most <= 3 * len(titles) and len(got) == 3001
    for i, x in got.items():
        k, d = (0, 0) if i is None else (i % 3, i % 2)
        assert sorted(x) == [(1.0, 0, j) for j in range(3000) if j % 3 == k and j % 2 == d][:3]
    inside = joins.title_match(df, df.where("day > '2020-12-31'"), 2, 0.75, 2, 3).select("a").distinct()
    assert inside.where("a % 2 = 0").count() == 0 and inside.count() == 1500


def test_title_match_takes_titles_whole(spark, tmp_path):
    spark.createDataFrame([(1, "a1 b1", "C1 D1", 1), (2, None, "C1 D1", 1), (3, "a1 b1", "C1 D1", 366), (4, "b1 a1", "D1 C1", 365)], "p_partkey long, p_name string, p_type string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    got = sorted((r.a, r.b, r.apart) for r in registry.QUERIES["title_match"](spark, str(tmp_path)).collect())
    assert got == [(1, 1, 0), (3, 3, 0), (3, 4, 1), (4, 3, 1), (4, 4, 0)]


def test_search_overlap_of_copies(spark, tmp_path):
    """Of found titles with one token set only the first of the order are joined; titles without a size come last."""
    names = ["red ring", "ring red", "blue ring", "red bolt", "sale gear", "the"]
    parts = [(i, names[i % 6], None if i < 60 else i % 7) for i in range(6000)]
    spark.createDataFrame(parts, "p_partkey long, p_name string, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    rows, most = most_rows(spark, registry.QUERIES["search_overlap"](spark, str(tmp_path)))
    want = set()
    for k, name in enumerate(names):
        x = set(f"{name} sale".split()) - {"the"}
        found = [(-len(x & y) / min(len(x), len(y)), (s is None, s), i) for i, n, s in parts if (y := set(n.split()) - {"the"})]
        want |= {(k, i, -o, place) for place, (o, _, i) in enumerate(sorted(f for f in found if f[0] <= -0.35)[:8], 1)}
    assert {tuple(r) for r in rows} == want and len(rows) == len(want) and most <= len(parts)
