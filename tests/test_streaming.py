import pytest

from censa.streaming.duration import durations_from_parts, start_duration_stream
from tests.test_duration import FILE_A, FILE_B, FILE_D


def test_stream_matches_batch_definition(spark, tmp_path):
    d = tmp_path / "incoming"
    d.mkdir()
    (d / "a.csv").write_text(FILE_A)
    (d / "b.csv").write_text(FILE_B)
    att = lambda f: [{"media_file_basename": "audit.csv", "download_url": "file://" + str(d / f)}]
    subs = spark.createDataFrame(
        [("u1", att("a.csv")), ("u2", att("b.csv")), ("u3", None), ("u4", att("d.csv"))],
        "uuid string, _attachments array<struct<media_file_basename:string,download_url:string>>")
    out, ckpt = str(tmp_path / "parts"), str(tmp_path / "ckpt")
    q = start_duration_stream(spark, str(d), out, ckpt, remove_geo=False)
    q.awaitTermination(120)
    first = {r.uuid: r.interview_duration for r in durations_from_parts(spark, out, subs).collect()}
    assert first == {"u1": pytest.approx(11.0), "u2": pytest.approx(2.0), "u3": None, "u4": None}
    (d / "d.csv").write_text(FILE_D)  # a late upload
    q = start_duration_stream(spark, str(d), out, ckpt, remove_geo=False)
    q.awaitTermination(120)
    second = {r.uuid: r.interview_duration for r in durations_from_parts(spark, out, subs).collect()}
    assert second == {"u1": pytest.approx(11.0), "u2": pytest.approx(2.0), "u3": None, "u4": 0.0}
