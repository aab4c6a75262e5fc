import pytest

from censa.plans.analysis_list import analysis_list

FORM = [("select_one fruit_list", "favorite_fruit"), ("text", "favorite_fruit_other"),
        ("select_multiple tool_list", "tools"), ("text", "tools_other"), ("integer", "age")]


def _sorted(items):
    return sorted(items, key=str)


def _rows(df):
    return sorted(((r.analysis_var, r.analysis_type, r.group_var) for r in df.collect()), key=str)


def test_form_only(spark):
    form = spark.createDataFrame(FORM, "type string, name string")
    assert _rows(analysis_list(spark, form=form)) == _sorted([
        ("favorite_fruit", "prop_select_one", None), ("tools", "prop_select_multiple", None),
        ("age", "mean", None), ("age", "median", None)])


def test_data_only(spark):
    data = spark.createDataFrame([], "uuid string, sex string, income double, ok boolean, "
                                     "tools string, `tools/hoe` int, `tools/rake` int")
    got = _rows(analysis_list(spark, data=data, group_vars=["sex"], level=0.9))
    assert got == _sorted([
        ("sex", "prop_select_one", None),
        ("income", "median", None), ("income", "mean", None),
        ("income", "median", "sex"), ("income", "mean", "sex"),
        ("tools", "prop_select_multiple", None), ("tools", "prop_select_multiple", "sex")])
    assert {r.level for r in analysis_list(spark, data=data, level=0.9).collect()} == {0.9}
    with pytest.raises(ValueError):
        analysis_list(spark, data=data, group_vars=["nope"])
    with pytest.raises(ValueError):
        analysis_list(spark)
