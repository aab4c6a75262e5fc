from censa.operators.cleaning import (choice_lists, choice_lists_wide, column_manifest,
                                      other_options, recode_others, validate_cleaning_log,
                                      variable_tracker)

FORM = [(1, "select_one fruit_list", "favorite_fruit", None),
        (2, "text", "favorite_fruit_other", "${favorite_fruit} = 'other'"),
        (3, "select_multiple tool_list", "tools", None),
        (4, "text", "tools_other", "selected(${tools}, 'other')"),
        (5, "integer", "age", None)]
CHOICES = [("fruit_list", "apple", 1), ("fruit_list", "banana", 2), ("fruit_list", "other", 3),
           ("tool_list", "hoe", 1), ("tool_list", "rake", 2), ("tool_list", "other", 3)]


def _form(spark):
    return (spark.createDataFrame(FORM, "pos int, type string, name string, relevant string"),
            spark.createDataFrame(CHOICES, "list_name string, name string, pos int"))


def test_b1_tracker(spark):
    raw = column_manifest(spark.createDataFrame([(1, 2, 3)], "a int, b int, c int"))
    clean = column_manifest(spark.createDataFrame([(1, 4)], "a int, d int"))
    got = sorted((r.Variable, r.Action, r.Rationale) for r in variable_tracker(raw, clean).collect())
    assert got == [("b", "remove", ""), ("c", "remove", ""), ("d", "added", "")]
    assert variable_tracker(raw, raw).count() == 0


def test_b4_other_options_and_lists(spark):
    form, choices = _form(spark)
    got = {r.other_question: r.choices for r in other_options(form, choices).collect()}
    assert got == {"favorite_fruit_other": "apple;\nbanana", "tools_other": "hoe;\nrake"}
    long = choice_lists(choices, form, others=True)
    sizes = {r.name: r.c for r in long.groupBy("name").count().withColumnRenamed("count", "c").collect()}
    assert sizes == {"change_type_validation": 4, "binaries_sm_options_lgl": 2,
                     "binaries_sm_options_num": 2, "favorite_fruit": 3, "tools": 3,
                     "favorite_fruit_other": 2, "tools_other": 2}
    assert choice_lists_wide(long).count() == 4


LOG = [("u1", "favorite_fruit_other", "change_response", "recode other", "apple"),
       ("u2", "tools_other", "change_response", "recode other", "rake"),
       ("u3", "favorite_fruit_other", "change_response", "recode other", "mango"),
       ("u1", "age", "change_response", "outlier", "30"),
       ("u4", "tools_other", "no_action", "recode other", "rake"),
       ("u2", "favorite_fruit_other", "change_response", "typo", "x")]


def test_b5_recode_others(spark):
    form, choices = _form(spark)
    log = spark.createDataFrame(LOG, "uuid string, question string, change_type string, "
                                     "issue string, new_value string")
    out = recode_others(form, choices, log)
    got = sorted((r.uuid, r.question, r.new_value, r.issue) for r in out.collect())
    assert got == sorted([
        ("u3", "favorite_fruit_other", "mango", "recode other"),
        ("u1", "age", "30", "outlier"),
        ("u4", "tools_other", "rake", "recode other"),
        ("u1", "favorite_fruit", "apple", None), ("u1", "favorite_fruit_other", None, None),
        ("u2", "tools/rake", "1", None), ("u2", "tools/other", "0", None),
        ("u2", "tools_other", None, None)])
    assert recode_others(form, choices, log, match="pair").count() == 9


def test_b6_validate(spark):
    form, choices = _form(spark)
    log = spark.createDataFrame(
        [("u1", "favorite_fruit", "change_response", "apple"),
         ("u1", "favorite_fruit", "change_response", "mango"),
         ("u5", "tools/rake", "change_response", "TRUE"),
         ("u5", "tools/rake", "change_response", "1"),
         ("all", "favorite_fruit", "change_response", "mango"),
         ("u1", "age", "bogus", "30")],
        "uuid string, question string, change_type string, new_value string")
    got = [(r.allowed_list, r.new_value_ok, r.change_type_ok)
           for r in validate_cleaning_log(log, form, choices).orderBy("uuid", "question", "new_value").collect()]
    assert sorted(got, key=str) == sorted([
        ("favorite_fruit", True, True), ("favorite_fruit", False, True),
        ("binaries_sm_options_lgl", True, True), ("binaries_sm_options_lgl", False, True),
        (None, None, True), (None, None, False)], key=str)
    num = validate_cleaning_log(log, form, choices, sm_dropdown_type="numerical") \
        .where("new_value = '1'").first()
    assert num.allowed_list == "binaries_sm_options_num" and num.new_value_ok


def test_other_options_strict(spark):
    import pytest
    form = spark.createDataFrame([(1, "integer", "age", None)],
                                 "pos int, type string, name string, relevant string")
    choices = spark.createDataFrame(CHOICES, "list_name string, name string, pos int")
    assert other_options(form, choices).count() == 0
    with pytest.raises(ValueError):
        other_options(form, choices, strict=True)


def test_write_cleaning_log(spark):
    import pytest
    from censa.plans.cleaning_log import write_cleaning_log
    from censa.session import scratch_path
    form, choices = _form(spark)
    log = spark.createDataFrame(LOG, "uuid string, question string, change_type string, "
                                     "issue string, new_value string")
    out = scratch_path(spark, "test-cleaning-log")
    paths = write_cleaning_log({"cleaning_log": log}, out, use_dropdown=True, use_others=True,
                               form=form, choices=choices)
    assert set(paths) == {"cleaning_log", "validation_rules", "readme"}
    assert spark.read.parquet(paths["readme"]).count() == 4
    assert "allowed_list" in spark.read.parquet(paths["cleaning_log"]).columns
    assert spark.read.parquet(paths["validation_rules"]).count() == 4
    with pytest.raises(ValueError):
        write_cleaning_log({"other": log}, out)
    with pytest.raises(ValueError):
        write_cleaning_log({"cleaning_log": log}, out, use_dropdown=True)


def test_recode_query_row_invariant(spark):
    """3 new rows per valid multi-choice recode, 2 per valid single-choice one."""
    from pyspark.sql import functions as F
    from censa.registry import MISSING_SEGMENT, q_recode_others
    sf = "/root/testdata/sf0.001"
    out = q_recode_others(spark, sf)
    new_rows = out.where(F.col("issue").isNull()).count()
    parts = spark.read.parquet(f"{sf}/part.parquet").where(F.col("p_type").isNotNull()).count()
    cust = spark.read.parquet(f"{sf}/customer.parquet") \
        .where(F.col("c_mktsegment") != MISSING_SEGMENT).count()
    assert new_rows == 3 * parts + 2 * cust


def test_manifest_schema_vs_values(spark):
    df = spark.createDataFrame([("x", 1, None), ("y", 2, None)], "ds string, a int, b int")
    schema = {(r.dataset, r.variable) for r in column_manifest(df, "ds").collect()}
    values = {(r.dataset, r.variable) for r in column_manifest(df, "ds", present="values").collect()}
    assert schema == {("x", "a"), ("x", "b"), ("y", "a"), ("y", "b")}
    assert values == {("x", "a"), ("y", "a")}
