"""Staged writes: whatever is lost, every table has a complete copy."""
import os

import pytest

from censa.plans.publish import Staged, read_published, recover
from censa.plans.results import write_results


def save(spark, path, values):
    spark.createDataFrame([(v,) for v in values], "v int").write.parquet(path)


def values(spark, folder, name):
    return sorted(r.v for r in read_published(spark, folder, name).collect())


def staged_run(spark, folder, number):
    run = Staged(spark, folder)
    for name in ("a", "b"):
        save(spark, run.staged(name), [number, number])
    return run


def test_publish_and_repeat(spark, tmp_path):
    folder = str(tmp_path / "out")
    for number in (1, 2):
        staged_run(spark, folder, number).publish(["a", "b"])
        assert values(spark, folder, "a") == values(spark, folder, "b") == [number, number]
    assert sorted(n for n in os.listdir(folder) if os.listdir(f"{folder}/{n}") and not n.startswith("_")) == ["a", "b"]
    assert not [x for d in ("_staging", "_old", "_journal") if os.path.exists(f"{folder}/{d}") for x in os.listdir(f"{folder}/{d}")
                if not x.startswith(".")]


@pytest.mark.parametrize("moves", [0, 1, 2, 3, 4])
def test_killed_while_tables_are_moved(spark, tmp_path, monkeypatch, moves):
    folder = str(tmp_path / "out")
    staged_run(spark, folder, 1).publish(["a", "b"])
    run = staged_run(spark, folder, 2)
    left, move = [moves], Staged._move

    def killed(self, source, target):
        if not left[0]:
            raise KeyboardInterrupt
        left[0] -= 1
        move(self, source, target)
    monkeypatch.setattr(Staged, "_move", killed)
    with pytest.raises(KeyboardInterrupt):
        run.publish(["a", "b"])
    monkeypatch.setattr(Staged, "_move", move)
    # before the journal is in place the old run counts, after it the new one
    assert recover(spark, folder) == ([run.run] if moves else [])
    want = [2, 2] if moves else [1, 1]
    assert values(spark, folder, "a") == values(spark, folder, "b") == want


def test_killed_while_writing_and_failed_tables(spark, tmp_path):
    folder = str(tmp_path / "out")
    rows = [("mean", "x", None, g, v, 1.0, 1.0, 1.0, 1) for g, v in [(None, None), ("g", "u"), ("h", "w")]]
    schema = ("analysis_type string, analysis_var string, analysis_var_value string, group_var string, "
              "group_var_value string, stat double, stat_low double, stat_upp double, n long")
    res = spark.createDataFrame(rows, schema)
    summary, path = write_results(res, folder)
    assert path and all(r.success for r in summary.collect())
    before = values_of(spark, folder)
    run = Staged(spark, folder)
    run.spark.createDataFrame(rows[:1], schema).write.parquet(run.staged("Desc_Table__g"))  # killed here
    assert values_of(spark, folder) == before
    summary, path = write_results(res.drop("n"), folder)  # no column n: the wide tables fail
    got = summary.collect()
    assert path and len(got) == 2 and not any(r.success for r in got) and all("column(s): n" in r.error for r in got)
    assert values_of(spark, folder) == before
    failing = res.selectExpr("*", "raise_error('broken') as broken").drop("n").withColumnRenamed("broken", "n")
    summary, path = write_results(failing, folder)
    assert path is None and "broken" in summary.first().error
    assert values_of(spark, folder) == before and not os.listdir(f"{folder}/_staging")


def values_of(spark, folder):
    return [sorted(map(tuple, spark.read.parquet(f"{folder}/Desc_Table__{g}").collect())) for g in "gh"]
