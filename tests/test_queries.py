"""Every registered query of the library against its SQL, over the whole small tables."""

import math

import duckdb
import pytest

from tidemark import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    return v.isoformat().replace("+00:00", "") if hasattr(v, "isoformat") else v


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query(spark, con, name):
    df = registry.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    got = [tuple(plain(r[c]) for c in cols) for r in df.collect()]
    if name not in registry.ORACLE:
        assert got
        return
    want = con.sql(registry.ORACLE[name])
    assert sorted(want.columns) == cols
    at = [want.columns.index(c) for c in cols]
    assert sorted(map(str, got)) == sorted(str(tuple(plain(r[i]) for i in at)) for r in want.fetchall())


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())


def test_top_k_is_pruned_before_the_shuffle(spark):
    plan = registry.QUERIES["topk_candidates"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_filters_and_columns_reach_the_scan(spark):
    plan = registry.QUERIES["target_all"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<lang:string,n_chars:bigint>" in plan
    plan = registry.QUERIES["work_queue"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [In(o_orderstatus" in plan and "TakeOrderedAndProject" in plan
