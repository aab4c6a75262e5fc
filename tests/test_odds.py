import pytest

from censa.operators.odds import odds_ratios


def _table(spark, counts):
    rows = []
    for lvl, (ones, zeros) in counts.items():
        rows += [(lvl, 1)] * ones + [(lvl, 0)] * zeros
    return spark.createDataFrame(rows, "g string, y int")


def test_b8_values(spark):
    df = _table(spark, {"a": (30, 70), "b": (45, 55), "c": (20, 80)})
    got = {r.term: r for r in odds_ratios(df, "y", {"g": "a"}).collect()}
    b, c = got["gb"], got["gc"]
    assert b.estimate == pytest.approx(1.9090909, abs=1e-6)
    assert b.conf_low == pytest.approx(1.0717568, abs=1e-6)
    assert b.conf_high == pytest.approx(3.4377998, abs=1e-6)
    assert b.p_value == pytest.approx(0.0292950, abs=1e-6)
    assert c.estimate == pytest.approx(0.5833333, abs=1e-6)
    assert c.conf_low == pytest.approx(0.3010402, abs=1e-6)
    assert c.conf_high == pytest.approx(1.1113980, abs=1e-6)
    assert c.p_value == pytest.approx(0.1043210, abs=1e-6)
    assert b.ref_group == "a" and not b.separated


def test_edges(spark):
    one_level = _table(spark, {"a": (3, 4)})
    assert odds_ratios(one_level, "y", {"g": "a"}).count() == 0
    zero = _table(spark, {"a": (3, 4), "b": (0, 5)})
    r = odds_ratios(zero, "y", {"g": "a"}).first()
    assert r.separated and r.estimate == 0.0 and r.conf_low is None and r.p_value is None
    with pytest.raises(Exception, match="reference level"):
        odds_ratios(_table(spark, {"a": (3, 4), "b": (2, 5)}), "y", {"g": "zz"}).collect()


def test_skips_are_reported_and_text_outcomes_left_out(spark):
    from censa.operators.odds import odds_ratio_skips
    df = spark.createDataFrame([("a", "m", None, 1, "yes"), ("b", "m", None, 0, "no"), ("a", "m", None, 0, "1")],
                               "g string, one string, none string, y int, t string")
    refs = {"g": "a", "one": "m", "none": "x"}
    assert {r.group_var: r.reason for r in odds_ratio_skips(df, "y", refs).collect()} == {
        "one": "fewer than two levels", "none": "no rows with outcome and level"}
    assert odds_ratios(df, "t", {"g": "a"}).count() == 0
    assert {r.reason for r in odds_ratio_skips(df, "t", {"g": "a"}).collect()} == {"outcome is not 0/1"}
    only = df.where("y = 0")
    assert [r.reason for r in odds_ratio_skips(only, "y", {"g": "a"}).collect()] == ["outcome has one value only"]


def test_limits_run_in_the_jvm(spark):
    plan = odds_ratios(_table(spark, {"a": (3, 4), "b": (2, 5)}), "y", {"g": "a"})._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def _deviance_at(a1, a0, k1, k0, beta):
    """2 * (max loglik - profile loglik at log-OR beta), by Newton on the intercept."""
    import numpy as np

    def ll(alpha, b):
        p_ref = 1 / (1 + np.exp(-alpha))
        p_lvl = 1 / (1 + np.exp(-(alpha + b)))
        return a1 * np.log(p_ref) + a0 * np.log(1 - p_ref) + k1 * np.log(p_lvl) + k0 * np.log(1 - p_lvl)

    alpha = np.log(a1 / a0)
    for _ in range(100):
        p_ref, p_lvl = 1 / (1 + np.exp(-alpha)), 1 / (1 + np.exp(-(alpha + beta)))
        grad = (a1 - (a1 + a0) * p_ref) + (k1 - (k1 + k0) * p_lvl)
        hess = -(a1 + a0) * p_ref * (1 - p_ref) - (k1 + k0) * p_lvl * (1 - p_lvl)
        alpha -= grad / hess
    lmax = ll(np.log(a1 / a0), np.log(k1 * a0 / (k0 * a1)))
    return 2 * (lmax - ll(alpha, beta))


def test_query_limits_satisfy_profile_condition(spark):
    import math
    from censa.registry import q_odds_ratio_counts, q_odds_ratios
    sf = "/root/testdata/sf0.001"
    counts = {r.term: r for r in q_odds_ratio_counts(spark, sf).collect()}
    full = {r.term: r for r in q_odds_ratios(spark, sf).collect()}
    assert counts.keys() == full.keys() and counts
    chi2 = 3.841458820694124
    for term, r in full.items():
        c = counts[term]
        if r.separated:
            assert r.conf_low is None and r.p_value is None
            continue
        for lim in (r.conf_low, r.conf_high):
            assert _deviance_at(c.a1, c.a0, c.k1, c.k0, math.log(lim)) == pytest.approx(chi2, abs=1e-3)
        assert r.conf_low < r.estimate < r.conf_high
        assert r.p_value == pytest.approx(math.erfc(abs(c.z) / math.sqrt(2)), abs=2e-6)


def test_udfs_run_without_package_on_worker_path(tmp_path):
    """Python workers started outside the repository still run the UDFs
    (their code is shipped with the task)."""
    import os
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = f"""
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
         .config("spark.checkpoint.dir", {str(tmp_path / "ckpt")!r}).getOrCreate())
from censa.registry import q_odds_ratios
print("ROWS", len(q_odds_ratios(spark, "/root/testdata/sf0.001").collect()))
"""
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=str(tmp_path), env=env,
                         capture_output=True, text=True, timeout=600)
    assert "ROWS" in out.stdout, out.stderr[-2000:]
