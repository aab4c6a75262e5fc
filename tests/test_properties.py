"""Property test: Spark estimates equal a numpy brute force of the definition."""
import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from censa.design import SurveyDesign
from censa.functions.stats import t_quantile
from censa.operators.estimates import Analysis, survey_results

rows_strategy = st.lists(
    st.tuples(st.sampled_from(["h1", "h2", "h3"]),          # stratum
              st.floats(0.1, 5.0, allow_nan=False),          # weight
              st.one_of(st.none(), st.sampled_from(["a", "b", "c"])),  # answer
              st.sampled_from(["g1", "g2"])),                # group
    min_size=6, max_size=40)


def brute(rows, value, group):
    h = np.array([r[0] for r in rows])
    w = np.array([r[1] for r in rows])
    x = [r[2] for r in rows]
    g = np.array([r[3] for r in rows])
    dom = np.array([xi is not None for xi in x]) & ((g == group) if group else True)
    if not dom.any():
        return None
    y = np.array([1.0 if xi == value else 0.0 for xi in x])
    W = w[dom].sum()
    est = (w[dom] * y[dom]).sum() / W
    z = np.where(dom, w * (y - est) / W, 0.0)
    var = 0.0
    for s in np.unique(h):
        m = h == s
        n = m.sum()
        if n > 1:
            var += n / (n - 1) * ((z[m] ** 2).sum() - z[m].sum() ** 2 / n)
    t = t_quantile(0.975, len(rows) - len(np.unique(h)))
    return est, est - t * math.sqrt(max(var, 0)), est + t * math.sqrt(max(var, 0))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_proportions_match_definition(spark, rows):
    df = spark.createDataFrame(rows, "h string, w double, x string, g string")
    res = survey_results(df, SurveyDesign("h", "w", lonely="skip"),
                         [Analysis("x", "prop_select_one"), Analysis("x", "prop_select_one", 0.95, "g")])
    got = {(r.analysis_var_value, r.group_var_value): r for r in res.collect()}
    for (value, group), r in got.items():
        exp = brute(rows, value, group)
        assert exp is not None
        assert r.stat == pytest.approx(exp[0], abs=1e-9)
        assert r.stat_low == pytest.approx(exp[1], abs=1e-9)
        assert r.stat_upp == pytest.approx(exp[2], abs=1e-9)
    # every observed (value, domain) pair is reported
    for r_ in rows:
        if r_[2] is not None:
            assert (r_[2], None) in got and (r_[2], r_[3]) in got


median_rows = st.lists(
    st.tuples(st.sampled_from(["h1", "h2"]),
              st.integers(1, 4).map(float),                       # integer weights: exact sums
              st.one_of(st.none(), st.integers(0, 12).map(float)),  # ties are common
              st.sampled_from(["g1", "g2"])),
    min_size=8, max_size=40)


def brute_median(rows, group):
    h = np.array([r[0] for r in rows])
    w = np.array([r[1] for r in rows])
    y = np.array([np.nan if r[2] is None else r[2] for r in rows])
    g = np.array([r[3] for r in rows])
    dom = ~np.isnan(y) & ((g == group) if group else True)
    if not dom.any():
        return None
    vals = np.unique(y[dom])
    cum = np.array([w[dom & (y <= v)].sum() for v in vals])
    W = cum[-1]
    q = lambda p: vals[np.argmax(cum >= p * W)] if (cum >= p * W).any() else vals.max()
    m = q(0.5)
    ind = np.where(dom & (y <= m), 1.0, 0.0)
    p_hat = (w * ind)[dom].sum() / W
    z = np.where(dom, w * (ind - p_hat) / W, 0.0)
    var = 0.0
    for s in np.unique(h):
        k = h == s
        n = k.sum()
        if n > 1:
            var += n / (n - 1) * ((z[k] ** 2).sum() - z[k].sum() ** 2 / n)
    t = t_quantile(0.975, len(rows) - len(np.unique(h)))
    se = math.sqrt(max(var, 0.0))
    return m, q(0.5 - t * se), q(0.5 + t * se), int(dom.sum())


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=median_rows, parts=st.integers(1, 6))
def test_medians_match_definition(spark, rows, parts):
    df = spark.createDataFrame(rows, "h string, w double, y double, g string")
    res = survey_results(df, SurveyDesign("h", "w", lonely="skip"),
                         [Analysis("y", "median"), Analysis("y", "median", 0.95, "g")],
                         range_partitions=parts)
    got = {r.group_var_value: r for r in res.collect()}
    for group in [None, "g1", "g2"]:
        exp = brute_median(rows, group)
        if exp is None:
            assert group not in got
            continue
        r = got[group]
        assert (r.stat, r.stat_low, r.stat_upp, r.n) == exp


multi_rows = st.lists(
    st.tuples(st.sampled_from(["h1", "h2", "h3"]),
              st.floats(0.2, 3.0, allow_nan=False),
              st.one_of(st.none(), st.sets(st.sampled_from(["a", "b", "c"]), max_size=3)
                        .map(lambda s: " ".join(sorted(s)))),
              st.sampled_from(["g1", "g2"])),
    min_size=8, max_size=30)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=multi_rows)
def test_multi_choice_match_definition(spark, rows):
    from censa.sources.multichoice import expand_select_multiple
    df = spark.createDataFrame(rows, "h string, w double, q string, g string")
    df = expand_select_multiple(df, "q", choices=["a", "b", "c"])
    res = survey_results(df, SurveyDesign("h", "w", lonely="skip"),
                         [Analysis("q", "prop_select_multiple"),
                          Analysis("q", "prop_select_multiple", 0.95, "g")])
    got = {(r.analysis_var_value, r.group_var_value): r for r in res.collect()}
    h = np.array([r[0] for r in rows])
    w = np.array([r[1] for r in rows])
    g = np.array([r[3] for r in rows])
    answered = np.array([r[2] is not None for r in rows])
    t = t_quantile(0.975, len(rows) - len(np.unique(h)))
    for choice in "abc":
        y = np.array([1.0 if r[2] is not None and choice in r[2].split() else 0.0 for r in rows])
        for group in [None, "g1", "g2"]:
            dom = answered & ((g == group) if group else True)
            if not dom.any():
                assert (choice, group) not in got
                continue
            W = w[dom].sum()
            est = (w[dom] * y[dom]).sum() / W
            z = np.where(dom, w * (y - est) / W, 0.0)
            var = sum(n / (n - 1) * ((z[k] ** 2).sum() - z[k].sum() ** 2 / n)
                      for s_ in np.unique(h) for k in [h == s_] for n in [k.sum()] if n > 1)
            r = got[(choice, group)]
            assert r.stat == pytest.approx(est, abs=1e-9)
            assert r.stat_upp == pytest.approx(est + t * math.sqrt(max(var, 0.0)), abs=1e-9)
            assert r.n == int(y[dom].sum()) and r.n_total == int(dom.sum())
