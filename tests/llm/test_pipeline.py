"""Each stage against brute force on what the stage before it wrote."""

from __future__ import annotations

import hashlib

import corpus_pipeline
from censa.llm import secrets

from .fixtures import frame, rows
from .test_packing import check
from .test_quality import brute as judge
from .test_secrets import VOCABULARY
from .test_simhash import brute_components, brute_fingerprint
from .test_suffix_dedup import brute as cut_earlier


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stages(spark, tmp_path):
    extra = [(3000, "password=hunter2222 " + " ".join(f"w{i}" for i in range(90)), "en", "s", 1, "k", "s")]
    data = [r for r in rows() if r[1] is None or len(r[1]) < 6000] + extra
    docs = frame(spark, data)
    columns = docs.columns
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        got = stage(spark, docs, str(tmp_path))
        if name != "packing":
            assert got.columns == columns
        path = str(tmp_path / name)
        got.write.parquet(path)
        before, docs = [tuple(r) for r in docs.collect()], spark.read.parquet(path)
        out[name] = plain(docs)
        if name == "quality_rules":
            assert out[name] == sorted((r for r in before if judge(r[0], r[1])[-1]), key=repr)
            assert 3 < len(out[name]) < len(data)
        if name == "simhash_near_dedup":
            comps = brute_components([brute_fingerprint(r[1]) for r in before], [r[0] for r in before], 4)
            assert sorted(r[0] for r in out[name]) == sorted(set(comps))
            assert set(out[name]) <= set(before)
        if name == "suffix_array_dedup":
            want = {w[0]: w for w in cut_earlier(before, 50)}
            assert sorted(want) == [r[0] for r in sorted(out[name])]
            for r in out[name]:
                assert r[4] == len(r[1])
                if r[1].isascii():
                    assert hashlib.sha256(r[1].encode()).hexdigest() == want[r[0]][4]
        if name == "secret_scan":
            assert [r[0] for r in out[name]] == sorted((r[0] for r in before), key=repr)
            text = {r[0]: r[1] for r in out[name]}
            assert text[3000].startswith("[SECRET] w0 w1")
            spans = {r.doc_id: r.spans for r in secrets.scan(frame(spark, before), VOCABULARY).collect()}
            assert all(text[r[0]] == r[1] for r in before if not spans[r[0]])
        if name == "packing":
            check(docs.collect(), [(r[0], r[1]) for r in before], 1024)


def test_run_and_empty(spark, tmp_path):
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
    assert corpus_pipeline.ORACLE_SQL is None


def test_the_row_that_stays_among_equal_ids(spark, tmp_path):
    """Smallest MD5 of id and text; of rows equal in both, the first by the other columns."""
    base = " ".join(f"w{i}" for i in range(200))
    data = [(k, base.replace("w7 ", f"{a} "), lang, "s", 1, "k", "s") for k in range(3)
            for a, lang in [("x", "en"), ("y", "en"), ("y", "de"), ("y", None)]]
    got = [tuple(r) for r in corpus_pipeline.simhash_near_dedup(spark, frame(spark, data), "").collect()]
    md5 = lambda r: hashlib.md5(f"{r[0]}:{r[1]}".encode()).digest()
    of_least = [r for r in data if r[0] == 0]
    stays = [r for r in of_least if md5(r) == min(map(md5, of_least))]
    assert got == [min(stays, key=lambda r: (r[2] is not None, r[2] or ""))]


def test_any_further_column_names(spark, tmp_path):
    names = ["kept_text", "n_bytes", "n_removed", "n_spans", "kept_sha256", "_redacted", "kept", "spans", "label", "fp",
             "component_id", "key", "_key", "_stay", "rid", "slot", "c0", "c1", "a.b", "verdict", "hash", "kept_text_"]
    data = [(r[0], r[1], *[f"{n} {i}" for n in names]) for i, r in enumerate(rows()) if r[1] is None or len(r[1]) < 6000]
    docs = spark.createDataFrame(data, "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names))
    path = str(tmp_path / "docs")
    docs.write.parquet(path)
    docs = spark.read.parquet(path)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, "")
        assert got.columns == docs.columns
        own = {r[2]: r for r in docs.collect()}
        assert all(tuple(r)[2:] == tuple(own[r[2]])[2:] for r in got.collect())
        got.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert 0 < docs.count() and corpus_pipeline.STAGES[-1][1](spark, docs, "").count() > 0
