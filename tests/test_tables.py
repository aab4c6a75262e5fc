from pyspark.sql import functions as F

from censa.design import SurveyDesign
from censa.operators.estimates import Analysis, survey_results
from censa.operators.tables import label_results, results_wide
from censa.plans.results import multi_results
from censa.session import scratch_path


def _res(spark):
    df = spark.createDataFrame(
        [("s1", 1.0, "yes", "NATION_0"), ("s1", 1.0, "no", "B"), ("s2", 2.0, "yes", "B"),
         ("s2", 2.0, "yes", "NATION_0")], "st string, w double, x string, g string")
    loa = [Analysis("x", "prop_select_one"), Analysis("x", "prop_select_one", 0.95, "g")]
    return df, loa, survey_results(df, SurveyDesign("st", "w"), loa)


def test_wide_shape(spark):
    _, _, res = _res(spark)
    wide = results_wide(res, "g")
    assert wide.columns[:3] == ["analysis_type", "analysis_var", "analysis_var_value"]
    assert wide.columns[3:7] == ["Overall_stat", "Overall_stat_upp", "Overall_stat_low", "Overall_n"]
    assert "NATION_0_stat" in wide.columns  # no NA -> Overall renaming
    assert wide.count() == 2


def test_labels_fall_back(spark):
    _, _, res = _res(spark)
    qs = spark.createDataFrame([("select_one yn", "x", "Answer")], "type string, name string, label string")
    ch = spark.createDataFrame([("yn", "yes", "Yes!")], "list_name string, name string, label string")
    got = {r.analysis_var_value: r for r in label_results(res, qs, ch, "label")
           .where("group_var IS NULL").collect()}
    assert got["yes"].label_analysis_var_value == "Yes!"
    assert got["no"].label_analysis_var_value == "no"
    assert got["yes"].label_analysis_var == "Answer"


def test_multi_results_summary(spark):
    df, loa, _ = _res(spark)
    out = scratch_path(spark, "test-multi-results")
    mr = multi_results(df, SurveyDesign("st", "w"), loa + [Analysis("zz", "mean")], out,
                       use_labels=False)
    summ = {(r.group, r.success) for r in mr.summary.collect()}
    assert ("g", True) in summ and (None, False) in summ
    assert mr.results.count() == 5  # NATION_0 answered only "yes"
    assert spark.read.parquet(f"{out}/Desc_Table__g").count() == 2


def test_design_error_in_summary(spark):
    df = spark.createDataFrame([("s1", 1.0, "a", "g1"), ("s2", 1.0, "b", "g1")],
                               "st string, w double, x string, g string")
    mr = multi_results(df, SurveyDesign("st", "w"),
                       [Analysis("x", "prop_select_one", 0.95, "g")],
                       scratch_path(spark, "test-multi-lonely"), use_labels=False)
    rows = mr.summary.collect()
    assert len(rows) == 1 and not rows[0].success and "single row" in rows[0].error


def test_csv_na_text(spark):
    df, loa, _ = _res(spark)
    out = scratch_path(spark, "test-multi-csv")
    mr = multi_results(df, SurveyDesign("st", "w"), loa, out, use_labels=False, fmt="csv",
                       na_text="NA")
    assert all(r.success for r in mr.summary.collect())
    text = spark.read.text(f"{out}/Desc_Table__g").collect()
    assert any(",NA," in r.value or r.value.endswith(",NA") for r in text)


def test_numeric_value_columns(spark):
    from censa.operators.tables import numeric_value_columns
    df = spark.createDataFrame([("a", "b", "c", "1.5", "NA")], "k1 string, k2 string, k3 string, "
                                                              "x string, y string")
    r = numeric_value_columns(df).first()
    assert r.k1 == "a" and r.x == 1.5 and r.y is None


def test_multi_results_with_labels(spark):
    df, loa, _ = _res(spark)
    qs = spark.createDataFrame([("select_one yn", "x", "Answer"), ("select_one gl", "g", "Group")],
                               "type string, name string, label string")
    ch = spark.createDataFrame([("yn", "yes", "Yes"), ("yn", "no", "Yes"), ("gl", "B", "Bee")],
                               "list_name string, name string, label string")
    out = scratch_path(spark, "test-multi-labels")
    mr = multi_results(df, SurveyDesign("st", "w"), loa, out, questions=qs, choices=ch,
                       label_column="label")
    assert all(r.success for r in mr.summary.collect())
    assert {r.issue for r in mr.label_review.collect()} == {"duplicated label"}
    wide = spark.read.parquet(f"{out}/Desc_Table__g")
    assert wide.columns[:3] == ["analysis_type", "label_analysis_var", "label_analysis_var_value"]
    assert wide.columns[3:5] == ["analysis_var", "analysis_var_value"]
    assert "Bee_stat" in wide.columns and wide.count() == 2  # two choices of one label stay two rows


def test_multi_choice_value_labels(spark):
    from censa.sources.multichoice import expand_select_multiple
    df = expand_select_multiple(spark.createDataFrame([("hoe rake", 1.0), ("rake", 1.0)],
                                                      "tools string, w double"), "tools")
    res = survey_results(df, SurveyDesign(None, "w"), [Analysis("tools", "prop_select_multiple")])
    qs = spark.createDataFrame([("select_multiple tl", "tools", "Tools")], "type string, name string, label string")
    ch = spark.createDataFrame([("tl", "hoe", "Hoe"), ("tl", "rake", "Rake")],
                               "list_name string, name string, label string")
    got = {r.analysis_var_value: r.label_analysis_var_value for r in label_results(res, qs, ch, "label").collect()}
    assert got == {"hoe": "Hoe", "rake": "Rake"}


def _long(spark, rows):
    return spark.createDataFrame(
        [("mean", v, vv, g, gv, s, s, s, 1) for v, vv, g, gv, s in rows],
        "analysis_type string, analysis_var string, analysis_var_value string, group_var string, "
        "group_var_value string, stat double, stat_upp double, stat_low double, n long")


def test_wide_keeps_overall_na_and_null_apart(spark):
    res = _long(spark, [("x", None, None, None, 5.0), ("x", None, "g", "Overall", 9.0), ("x", None, "g", "NA", 2.0),
                        ("x", None, "g", None, 1.0), ("x", None, "g", "na", 3.0)])
    wide = results_wide(res, "g", ("stat",))
    row = wide.first().asDict()
    assert row["Overall_stat"] == 5.0 and sorted(v for k, v in row.items() if k.endswith("_stat") or "stat" in k) == [1.0, 2.0, 3.0, 5.0, 9.0]
    assert len({c.lower() for c in wide.columns}) == len(wide.columns)
    assert row["Overall_2_stat"] == 9.0 and row["NA_stat"] == 1.0


def test_wide_with_equal_labels_keeps_rows_and_columns(spark):
    res = _long(spark, [("x", "a", None, None, 0.2), ("x", "b", None, None, 0.7), ("x", "a", "g", "1", 0.3),
                        ("x", "a", "g", "2", 0.4)])
    qs = spark.createDataFrame([("select_one l", "x", "X"), ("select_one gl", "g", "G")], "type string, name string, label string")
    ch = spark.createDataFrame([("l", "a", "Same"), ("l", "b", "Same"), ("gl", "1", "One"), ("gl", "2", "One")],
                               "list_name string, name string, label string")
    wide = results_wide(label_results(res, qs, ch, "label"), "g", ("stat",), use_labels=True)
    got = {r.analysis_var_value: (r.label_analysis_var_value, r.Overall_stat, r.One_stat, r.One_2_stat) for r in wide.collect()}
    assert got == {"a": ("Same", 0.2, 0.3, 0.4), "b": ("Same", 0.7, None, None)}


def test_folder_names_are_unique():
    from censa.plans.results import _unique_names
    names = _unique_names(["a b", "a-b", "a_b_1", "имя", "名"])
    assert names == ["a_b", "a_b_1", "a_b_1_1", "group", "group_1"]


def test_second_run_without_overwrite_reports(spark):
    df, loa, _ = _res(spark)
    out = scratch_path(spark, "test-multi-twice")
    run = lambda: multi_results(df, SurveyDesign("st", "w"), loa, out, use_labels=False, overwrite=False)
    assert all(r.success for r in run().summary.collect())
    again = run()
    rows = again.summary.collect()
    assert rows and not any(r.success for r in rows) and "exist" in rows[0].error and again.aggregated_path is None
    assert again.results.count() == 5


def test_tiles_hold_any_number_of_group_values(spark):
    from censa.operators.tables import result_tiles
    n = 100_000
    res = spark.range(n).selectExpr("'mean' AS analysis_type", "'x' AS analysis_var", "CAST(NULL AS string) AS analysis_var_value",
                                    "IF(id = 7, NULL, 'g') AS group_var", "IF(id IN (7, 8), NULL, concat('v', id)) AS group_var_value",
                                    "id * 1.5 AS stat")
    tiles = result_tiles(res, "g", ("stat",), width=200)
    header = tiles.header
    assert header.count() == n and header.selectExpr("max(tile)", "max(place)").first()[:] == (499, 199)
    first = header.where("tile = 0 AND place < 2").orderBy("place").collect()
    assert [(r.overall, r.group_var_value, r.label) for r in first] == [(True, None, "Overall"), (False, None, "NA")]
    assert tiles.rows.count() == 500
    cells = tiles.rows.select("tile", F.posexplode(F.array(*[f"b{i}_stat" for i in range(200)])).alias("place", "stat"))
    back = cells.join(header, ["tile", "place"]).where("group_var_value IS NOT NULL")
    assert back.where("stat <> 1.5 * CAST(substring(group_var_value, 2) AS int)").count() == 0
    assert back.count() == n - 2 and cells.where("tile = 0 AND place = 1").first().stat == 12.0


def test_a_wide_disaggregation_is_written_in_tiles(spark):
    from censa.plans.results import write_results
    out = scratch_path(spark, "test-tiles")
    rows = [("x", None, None, None, 5.0)] + [("x", None, "h", str(i), float(i)) for i in range(30)] + [("x", None, "g", "a", 1.0)]
    summary, _ = write_results(_long(spark, rows), out, max_values=10)
    assert {r.group: r.success for r in summary.collect()} == {"g": True, "h": True}
    assert spark.read.parquet(f"{out}/Desc_Table__g").columns[3:7] == ["Overall_stat", "Overall_stat_upp", "Overall_stat_low", "Overall_n"]
    header = {(r.tile, r.place): r.label for r in spark.read.parquet(f"{out}/Desc_Table__h__header").collect()}
    row = spark.read.parquet(f"{out}/Desc_Table__h").first()
    assert len(header) == 31 and row.b0_stat == 5.0
    assert all(row[f"b{p}_stat"] == float(v) for (_, p), v in header.items() if v != "Overall")
