import numpy as np

from censa.operators.cumulative import running_sum


def test_running_sum_across_ranges(spark):
    rng = np.random.default_rng(11)
    n = 5000
    vals = rng.permutation(n).astype(float)
    ws = rng.integers(1, 9, n).astype(float)
    # one hot group holding most rows, one small group, one NULL group key
    keys = np.where(np.arange(n) < 4000, "hot", np.where(np.arange(n) < 4900, "cold", None))
    df = spark.createDataFrame([(None if k is None else str(k), float(v), float(w))
                                for k, v, w in zip(keys, vals, ws)], "g string, y double, w double")
    res = running_sum(df, ["g"], "y", "w", "C", partitions=8)
    out = res.rows.collect()
    totals = {r["g"]: (r["__total"], r["__count"], r["__max_order"]) for r in res.totals.collect()}
    got = {(r.g, r.y): r.C for r in out}
    assert len(got) == n
    for key in ("hot", "cold", None):
        m = keys == key if key is not None else np.array([k is None for k in keys])
        order = np.argsort(vals[m])
        cum = np.cumsum(ws[m][order])
        for y, c in zip(vals[m][order], cum):
            assert got[(key, y)] == c
        assert totals[key] == (cum[-1], m.sum(), vals[m].max())
