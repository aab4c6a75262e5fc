import pytest
from pyspark.sql import functions as F

from censa.operators.sampling import sample_sizes, stratified_sample, weight_diagnostics


def test_b3_sample_sizes(spark):
    Ns = [1, 2, 10, 100, 1000, 10000, 1000000]
    # strata of the given sizes, cut from one range
    df = spark.range(1000000).select(F.col("id"))
    parts = None
    for N in Ns:
        p = df.where(F.col("id") < N).select(F.lit(f"s{N}").alias("st"))
        parts = p if parts is None else parts.unionByName(p)
    got = {r.st: (r.n, r.sample) for r in sample_sizes(parts, "st").collect()}
    expect = [1, 2, 10, 80, 278, 370, 384]
    assert [got[f"s{N}"][1] for N in Ns] == expect


def test_stratified_sample_exact_and_reproducible(spark):
    orders = spark.read.parquet("/root/testdata/sf0.01/orders.parquet")
    s1 = stratified_sample(orders, "o_orderpriority", "o_orderkey", seed=1)
    got = {r.o_orderpriority: (r.c, r.n, r.sample)
           for r in s1.groupBy("o_orderpriority").agg(F.count("*").alias("c"),
                                                      F.first("n").alias("n"),
                                                      F.first("sample").alias("sample")).collect()}
    for c, n, sample in got.values():
        assert c == sample <= n
    keys1 = {r.o_orderkey for r in s1.select("o_orderkey").collect()}
    keys2 = {r.o_orderkey for r in stratified_sample(orders, "o_orderpriority", "o_orderkey",
                                                     seed=1).select("o_orderkey").collect()}
    keys3 = {r.o_orderkey for r in stratified_sample(orders, "o_orderpriority", "o_orderkey",
                                                     seed=2).select("o_orderkey").collect()}
    assert keys1 == keys2 and keys1 != keys3
    all_keys = {r.o_orderkey for r in orders.select("o_orderkey").collect()}
    assert keys1 <= all_keys


def test_stratified_sample_plans_group_limit(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    plan = stratified_sample(orders, "o_orderpriority", "o_orderkey")._jdf \
        .queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_draw_equals_a_plain_ranking(spark):
    """Few rows leave their tasks, strata that fall short take all rows, and
    the rows drawn are those of a plain ranking."""
    from censa.operators import sampling
    from pyspark.sql import Window
    df = spark.range(60_000).selectExpr("id", "CASE WHEN id % 10 < 7 THEN 'big' WHEN id < 40 THEN NULL ELSE concat('s', id % 37) END AS st",
                                        "id * 2 AS n")
    got = stratified_sample(df, "st", "id", margin_of_error=0.02)
    assert got.columns == ["id", "st", "n", "n", "sample", "incl"]
    got = {(r[0], r[1], r[2]) for r in got.collect()}
    w = Window.partitionBy("st").orderBy(F.md5(F.concat(F.lit("42:"), F.col("id").cast("string"))), "id")
    sizes = sample_sizes(df, "st", margin_of_error=0.02).withColumnsRenamed({"st": "z", "n": "total"})
    ranked = df.withColumn("k", F.row_number().over(w))
    want = ranked.join(sizes, ranked["st"].eqNullSafe(sizes["z"])).where("k <= sample").select("id", "st", "n")
    assert got == {tuple(r) for r in want.collect()}
    few = sampling.sample_sizes(df, "st", margin_of_error=0.02).where("st = 'big'").first()
    assert few.n == 42_000 and few["sample"] > 2000


def test_b2_weight_diagnostics(spark):
    w = [0.8, 1.0, 1.2, 0.9, 1.5, 0.7, 1.1, 1.3]
    df = spark.createDataFrame([(x,) for x in w], "w double")
    r = weight_diagnostics(df, "w").first()
    assert r.n == 8
    assert r.mean_weight == pytest.approx(1.0625)
    assert r.sd_weight == pytest.approx(0.2669269563)
    assert r.cv_weight == pytest.approx(0.2512253706)
    assert r.design_effect == pytest.approx(1.0631141869)
    assert r.effective_n == pytest.approx(7.5250618409)
    assert r.margin_of_error_95 == pytest.approx(35.7249014178)


def test_weight_diagnostics_tell_overall_from_a_null_group(spark):
    df = spark.createDataFrame([(1.0, "a", 1), (2.0, "a", None), (3.0, None, 1), (5.0, None, None)], "w double, g string, h int")
    got = {(r.grouped_by, r.g, r.h): r.n for r in weight_diagnostics(df, "w", by=["g", "h"]).collect()}
    assert got == {(None, None, None): 4, ("g", "a", None): 2, ("g", None, None): 2, ("h", None, 1): 2, ("h", None, None): 2}
    assert {r.grouped_by for r in weight_diagnostics(df, "w", by=["g", "h"], overall=False).collect()} == {"g, h"}
    assert "grouped_by" not in weight_diagnostics(df, "w").columns


def test_weight_diagnostics_edges(spark):
    one = weight_diagnostics(spark.createDataFrame([(1.0,)], "w double"), "w").first()
    assert one.n == 1 and one.sd_weight is None and one.design_effect is None
    nul = weight_diagnostics(spark.createDataFrame([(1.0,), (None,)], "w double"), "w").first()
    assert nul.n == 2 and nul.mean_weight is None
    zero = weight_diagnostics(spark.createDataFrame([(1.0,), (-1.0,)], "w double"), "w").first()
    assert zero.cv_weight is None
    with pytest.raises(ValueError):
        weight_diagnostics(spark.createDataFrame([("a",)], "w string"), "w")


def test_group_limit_above_default_threshold(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    df = stratified_sample(orders, "o_orderpriority", "o_orderkey", margin_of_error=0.02)
    assert spark.conf.get("spark.sql.optimizer.windowGroupLimitThreshold") == "1000"  # the session's settings stay
    got = df.groupBy("o_orderpriority").agg(F.count("*").alias("c"), F.first("n").alias("n"),
                                            F.first("sample").alias("s")).collect()
    assert all(r.c == r.s <= r.n for r in got)
