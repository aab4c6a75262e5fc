import json

from censa import read_submissions, split_repeats, expand_select_multiple


def test_json_export_with_roster(spark, tmp_path):
    recs = [
        {"uuid": "u1", "sex": "f", "tools": "hoe rake",
         "hh_roster": [{"age": 30, "rel": "head"}, {"age": 4, "rel": "child"}],
         "_attachments": [{"media_file_basename": "audit.csv", "download_url": "x/a.csv"}]},
        {"uuid": "u2", "sex": "m", "tools": None, "hh_roster": [],
         "_attachments": []},
        {"uuid": "u3", "sex": "f", "tools": "rake"},
    ]
    p = tmp_path / "subs.jsonl"
    p.write_text("\n".join(json.dumps(r) for r in recs))
    df = read_submissions(spark, str(p), "json")
    subs = split_repeats(df, key="uuid")
    assert set(subs.repeats) == {"hh_roster"}
    assert "hh_roster" not in subs.main.columns and "_attachments" in subs.main.columns
    kids = sorted((r.uuid, r._index, r.age, r.rel) for r in subs.repeats["hh_roster"].collect())
    assert kids == [("u1", 1, 30, "head"), ("u1", 2, 4, "child")]
    wide = expand_select_multiple(subs.main, "tools")
    got = {r.uuid: (r["tools/hoe"], r["tools/rake"]) for r in wide.collect()}
    assert got == {"u1": (1, 1), "u2": (None, None), "u3": (0, 1)}


def test_form_versions_lose_no_column(spark, tmp_path):
    from censa.sources.submissions import read_form_versions
    recs = [{"uuid": "a", "__version__": "v1", "n": 3, "g/x y": 1.5, "o": {"k": 1}, "gone": None, "it's": 1, "big": 2 ** 70},
            {"uuid": "b", "__version__": "v2", "n": "three", "roster": [{"age": 3}, {"age": 4, "sex": "f"}], "B": True, "b": 1},
            {"uuid": "c", "__version__": "v3", "n": 4.25, "g/x y": 2, "o": {"k": "z", "VARIANT": 2}, "free text": "DECIMAL(3,2)"}]
    for k, r in enumerate(recs):
        (tmp_path / f"{k}.jsonl").write_text(json.dumps(r) + "\n" + ("{broken\n[1]\n" if k == 1 else ""))
    subs, versions = read_form_versions(spark, str(tmp_path))
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        rows = {r["uuid"]: r.asDict(recursive=True) for r in subs.collect()}
        assert set(subs.columns) == {c for r in recs for c in r}
    finally:
        spark.conf.unset("spark.sql.caseSensitive")
    assert [rows[u]["n"] for u in "abc"] == ["3", "three", "4.25"]
    assert rows["a"]["g/x y"] == 1.5 and rows["c"]["g/x y"] == 2.0 and rows["a"]["it's"] == 1
    assert rows["a"]["o"] == {"VARIANT": None, "k": "1"} and rows["c"]["o"] == {"VARIANT": 2, "k": "z"}
    assert rows["b"]["roster"] == [{"age": 3, "sex": None}, {"age": 4, "sex": "f"}] and rows["a"]["roster"] is None
    assert rows["c"]["free text"] == "DECIMAL(3,2)" and rows["a"]["gone"] is None
    assert {r.version: r.records for r in versions.collect()} == {"v1": 1, "v2": 1, "v3": 1, None: 2}
    plan = subs._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
    parts = split_repeats(subs.select("uuid", "roster"))
    assert sorted((r.uuid, r._index, r.age) for r in parts.repeats["roster"].collect()) == [("b", 1, 3), ("b", 2, 4)]
