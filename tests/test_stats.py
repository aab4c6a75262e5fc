import math

import pytest

from censa.functions.columns import safe_name
from censa.functions.stats import normal_quantile, t_quantile


@pytest.mark.parametrize("p,df,expected", [
    (0.975, 1, 12.706204736), (0.975, 2, 4.302652730), (0.975, 5, 2.570581836),
    (0.975, 30, 2.042272456), (0.995, 10, 3.169272673), (0.95, 120, 1.657650899),
    (0.025, 5, -2.570581836), (0.5, 7, 0.0),
])
def test_t_quantile_table_values(p, df, expected):
    assert t_quantile(p, df) == pytest.approx(expected, abs=1e-8)


def test_one_formula_at_every_df():
    from censa.functions.stats import EXPAND_DF, _expanded, t_central
    for p in (0.9, 0.975, 0.9995):
        for df in (EXPAND_DF, 5 * EXPAND_DF):
            assert t_central(_expanded(p, df), df) == pytest.approx(p - 0.5, abs=2e-13)
        assert t_quantile(p, EXPAND_DF - 1) - _expanded(p, EXPAND_DF - 1) == pytest.approx(0, abs=2e-11)
    # no switch to the normal quantile: the difference keeps shrinking as 1 / df
    for df in (10**5, 10**6, 10**8):
        gap = t_quantile(0.975, df) - normal_quantile(0.975)
        assert gap * df == pytest.approx(2.3722712, rel=1e-3)
    assert normal_quantile(0.975) == pytest.approx(1.959963984540054, abs=1e-14)


def test_normal_tail_column(spark):
    from pyspark.sql import functions as F

    from censa.operators.odds import normal_two_sided
    zs = [0.0, 0.3, 1.959963984540054, -3.4, 3.6, 5.0, 9.0, 30.0]
    rows = spark.createDataFrame([(z,) for z in zs], "z double").select("z", normal_two_sided(F.col("z")).alias("p")).collect()
    for r in rows:
        assert r.p == pytest.approx(math.erfc(abs(r.z) / math.sqrt(2)), rel=1e-12)


def test_safe_name():
    assert safe_name(None) == "Overall"
    assert safe_name("Admin 1 / Region") == "admin_1_region"
    assert safe_name("2nd group") == "x2nd_group"
    assert safe_name("__A__") == "a"
