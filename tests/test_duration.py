import os

import pytest

from censa.operators.duration import interview_duration
from censa.sources.audit import audit_log, read_audit_csv

FILE_A = """event,node,start,end,old-value,new-value
question,/x/a,1000,61000,,1
question,/x/geo,0,600000,,"multi
line"
group questions,,5,,,
"""
FILE_B = """event,latitude,node,start,end,old_value,new_value
question,1.5,/x/b,0,120000,a,b
"""
FILE_D = """event,node,start,end
form start,,7,
"""


@pytest.fixture()
def audit_setup(spark, tmp_path):
    d = tmp_path / "audit"
    d.mkdir()
    for name, body in [("a.csv", FILE_A), ("b.csv", FILE_B), ("d.csv", FILE_D)]:
        (d / name).write_text(body)
    att = lambda f: [{"media_file_basename": "audit.csv", "download_url": "file://" + str(d / f)}]
    subs = spark.createDataFrame(
        [("u1", att("a.csv")), ("u2", att("b.csv")), ("u3", None), ("u4", att("d.csv"))],
        "uuid string, _attachments array<struct<media_file_basename:string,download_url:string>>")
    rows = read_audit_csv(spark, str(d))
    return subs, audit_log(subs, rows)


def test_b7_interview_duration(spark, audit_setup):
    subs, audit = audit_setup
    on = {r.uuid: r.interview_duration
          for r in interview_duration(subs, audit, remove_geo=True).df_and_duration.collect()}
    off = {r.uuid: r.interview_duration
           for r in interview_duration(subs, audit, remove_geo=False).df_and_duration.collect()}
    assert on == {"u1": pytest.approx(1.0), "u2": pytest.approx(2.0), "u3": None, "u4": None}
    assert off == {"u1": pytest.approx(11.0), "u2": pytest.approx(2.0), "u3": None, "u4": 0.0}


def test_audit_harmonised(spark, audit_setup):
    _, audit = audit_setup
    got = {(r.uuid, r.node): (r.old_value, r.new_value) for r in audit.collect()}
    assert got[("u2", "/x/b")] == ("a", "b")
    assert got[("u1", "/x/geo")] == (None, "multi\nline")
    assert os.sep  # paths normalised without scheme


def test_wide_headers_and_quotes(spark, tmp_path):
    """Columns past any fixed width are read; quotes, doubled quotes, CRLF and
    a file without a header are handled; one scan, no shuffle."""
    d = tmp_path / "audit"
    d.mkdir()
    extra = ",".join(f"x{i}" for i in range(40))
    (d / "w.csv").write_text(f'event,{extra},node,start,end,old-value\r\nq,{"," * 39},"/a ""b"", c",5,65,"1,2"\r\n')
    (d / "v.csv").write_text("x,node,start,end\n,/first cell empty,1,2\n")
    (d / "none.csv").write_text("a,b\n1,2\n")
    rows = read_audit_csv(spark, str(d))
    got = [(r.node, r.start, r.end, r.old_value, r.new_value) for r in rows.collect()]
    assert sorted(got) == [('/a "b", c', 5, 65, "1,2", None), ("/first cell empty", 1, 2, None, None)]
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan


def test_audit_query_spreads_a_large_user_over_files(spark, tmp_path, monkeypatch):
    import duckdb

    from censa import registry
    (tmp_path / "sf").mkdir()
    events = str(tmp_path / "sf" / "events.parquet")
    con = duckdb.connect()
    con.execute(f"""COPY (SELECT i AS event_id, CASE WHEN i < 3000 THEN 4 ELSE i % 10 END::BIGINT AS user_id,
        TIMESTAMP '2024-01-01' + to_seconds(i) AS ts, 'click' AS event_type, i / 4.0::DOUBLE AS value,
        '{{"k": ' || i || '}}' AS props FROM range(4000) t(i)) TO '{events}' (FORMAT parquet)""")
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{events}')")
    monkeypatch.setattr(registry, "FILE_EVENTS", 200, raising=False)
    monkeypatch.setattr(registry, "scratch_path", lambda s, name: str(tmp_path / "audit"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the table is small
    try:
        df = registry.q_audit_attachments(spark, str(tmp_path / "sf"), "user_id")
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    sql = registry.ORACLE["audit_log"]
    columns = ["uuid", "node", "start", "end", "old_value", "new_value"]
    quoted = ", ".join(f'"{c}"' for c in columns)
    assert sorted(map(tuple, df.select(*columns).collect())) == sorted(con.execute(f"SELECT {quoted} FROM ({sql})").fetchall())
    files = sorted((tmp_path / "audit").rglob("*.csv"))
    assert max(f.read_text().count("question") for f in files) <= 200
    large = [f for f in files if "uuid=4" in str(f)]
    assert len(large) >= 15 and len({f.name[:10] for f in large}) > 1  # more than one task
    assert all(f.read_text().startswith("event,node,start,end,") for f in large)


def _csv_text(rng, n):
    """A CSV text with quoted line breaks, doubled quotes, both line ends and blank lines."""
    def cell():
        kind = rng.random()
        if kind < 0.25:
            return '"' + rng.choice(['a\nb', '""', '\n""x""\n\n', ',', 'end\n', '\r\n', 'node,start,end', '\n' * 40]) + '"'
        return rng.choice(["", "x", "7", "12", "é中", "long " * 5])
    lines = []
    for _ in range(n):
        lines.append(",".join(cell() for _ in range(6)) + rng.choice(["\n", "\r\n", "\n\n"]))
    lines.insert(rng.choice([0, 0, 3]), "a,node,end,start,old-value,instance ID\n")
    lines.insert(len(lines) // 2, "node,start,end\n")
    return "".join(lines) + rng.choice(["", "q,node,1,2,3,4", 'q,"open', '"'])


def test_split_scan_equals_the_single_reader(spark, tmp_path):
    import random

    from censa.sources.audit import normalise_path, parse_audit_files
    from pyspark.sql import functions as F
    rng = random.Random(8)
    d = tmp_path / "audit"
    d.mkdir()
    for k in range(6):
        (d / f"f{k}.csv").write_text(_csv_text(rng, rng.choice([3, 40, 120])), newline="")
    (d / "no_header.csv").write_text("a,b\n" * 30)
    (d / "empty.csv").write_text("")
    whole = parse_audit_files(spark.read.text(str(d), wholetext=True).select(
        "value", normalise_path(F.col("_metadata.file_path")).alias("file")), True)
    want = sorted(map(repr, whole.collect()))
    settings = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        for split_bytes, chunk_bytes in [(0, 50), (700, 100), (0, 1), (1 << 30, 50)]:
            rows = read_audit_csv(spark, str(d), True, split_bytes, chunk_bytes)
            assert sorted(map(repr, rows.collect())) == want
        lines = spark.read.option("lineSep", "\n").text(str(d))
        assert lines.rdd.getNumPartitions() > 20
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert len(want) > 150


def test_records_name_their_interview(spark, tmp_path):
    (tmp_path / "a.csv").write_text("instance ID,event,node,start,end\nu1,q,/a,0,60000\nu2,q,/b,0,30000\nu1,q,/c,5,60005\n")
    (tmp_path / "b.csv").write_text("node,start,end,uuid\n/d,0,60000,u2\n")
    audit = read_audit_csv(spark, str(tmp_path), instance=True).withColumnRenamed("instance", "uuid")
    subs = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "uuid string")
    got = {r.uuid: r.interview_duration for r in interview_duration(subs, audit).df_and_duration.collect()}
    assert got == {"u1": 2.0, "u2": 1.5, "u3": None}
