"""Lookup joins: broadcast within the bound, salted beyond it, same rows."""

from __future__ import annotations

import pytest

from censa.functions.joins import lookup_join


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("bound", [0, 100])
def test_same_rows_either_way(spark, how, bound):
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else "hot" if i % 5 < 4 else f"k{i}") for i in range(200)], "i int, k string")
    table = spark.createDataFrame([("hot", 1.0), (None, 2.0), ("k4", 3.0)], "key string, v double")
    joined = lookup_join(rows, table, [("k", "key")], how, bound=bound)
    assert joined.columns == ["i", "k", "key", "v"]
    got = {r.i: r.v for r in joined.collect()}
    want = {"hot": 1.0, None: 2.0, "k4": 3.0}
    expect = {r.i: want.get(r.k) for r in rows.collect() if how == "left" or r.k in want}
    assert got == expect
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert ("BroadcastHashJoin" in plan) or bound == 0
