"""The as-of join's first lines: the same in any order of the rows, and nulls as the SQL has them."""

import datetime

import pytest

from tidemark import registry


@pytest.mark.parametrize("turned", [False, True])
def test_asof_title_settles_ties(spark, tmp_path, turned):
    day = lambda k: datetime.datetime(2000, 1, k)
    lines = [(1, 8, 3, day(2)), (1, 7, 3, day(2)), (2, 7, 1, None), (2, 7, 2, day(3)), (3, None, 1, day(1))]
    spark.createDataFrame(lines[::-1] if turned else lines, "l_orderkey long, l_suppkey long, l_linenumber int, l_shipdate timestamp_ntz").coalesce(1).write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(10, 7, day(2)), (11, 8, day(2)), (12, 7, day(4)), (13, None, day(5)), (14, 7, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r.id: r.ref for r in registry.QUERIES["asof_title"](spark, str(tmp_path)).collect()}
    assert got == {10: 1, 11: None, 12: 2, 13: None, 14: None}
