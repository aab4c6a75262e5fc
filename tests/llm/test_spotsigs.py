"""SpotSigs against its DuckDB oracle on awkward rows, and the order rules."""

from __future__ import annotations

import duckdb
import pytest

from censa.llm import queries, spotsigs

from .fixtures import by_row, frame, rows


def compare(spark, tmp_path, data):
    path = str(tmp_path / "documents.parquet")
    frame(spark, data).write.parquet(path)
    got = by_row(queries.op2_spotsigs(spark, str(tmp_path)), *COLUMNS)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    want = sorted(con.execute(f"SELECT {', '.join(COLUMNS)} FROM ({queries.ORACLE['op2_spotsigs']})").fetchall(), key=repr)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    for g, w in zip(got, want, strict=True):
        assert abs(g[5] - w[5]) < 1e-12 and abs(g[6] - w[6]) < 1e-12
    return got


COLUMNS = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def test_awkward_rows_equal_oracle(spark, tmp_path):
    data = rows()
    got = compare(spark, tmp_path, data)
    assert len(got) == len(data)


def test_single_row_and_empty(spark, tmp_path):
    (got,) = compare(spark, tmp_path, [(7, "the house of the river and", *[None] * 5)])
    assert got[6] == 1.0
    assert spotsigs.compare_edited(frame(spark, [])).count() == 0


@pytest.mark.parametrize("buckets", [1, 2, 7, 64])
def test_next_document_across_ranges(spark, buckets):
    ids = [*range(0, 300, 3), 10_000_000, -5]
    data = [(i, f"text {i}", *[None] * 5) for i in ids]
    got = {r.doc_id: r.next_text for r in spotsigs.with_next(frame(spark, data), buckets).collect()}
    order = sorted(ids)
    assert got == {a: f"text {b}" for a, b in zip(order, order[1:] + order[:1], strict=True)}


def test_plan_has_no_python_and_one_shuffle_of_texts(spark):
    plan = spotsigs.compare_edited(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_jaccard_prunes_by_length(spark):
    from pyspark.sql import functions as F
    a, b = F.array(*(F.lit(str(i)) for i in range(10))), F.array(F.lit("1"))
    row = spark.range(1).select(spotsigs.jaccard(a, b).alias("exact"), spotsigs.jaccard(a, b, 0.5).alias("pruned"),
                                spotsigs.jaccard(a, a, 0.5).alias("same")).first()
    assert (row.exact, row.pruned, row.same) == (0.1, 0.0, 1.0)


@pytest.mark.parametrize("threshold", [0.2, 1 / 3, 0.5, 0.8])
def test_similar_pairs_equal_brute_force(spark, threshold):
    import random
    rng = random.Random(7)
    vocabulary = "the of a river house stone light water field night".split()
    texts = [" ".join(rng.choices(vocabulary, k=rng.choice([2, 5, 12, 40, 120]))) for _ in range(60)]
    texts += [texts[k] + " the old mill and the long road" for k in range(0, 60, 3)] + [texts[0], texts[0], "", None]
    docs = frame(spark, [(i, t, *[None] * 5) for i, t in enumerate(texts)])
    sets = {tuple(r.sigs) for r in spotsigs.spot_signatures(docs.fillna({"text": ""}), "text", "sigs").collect()}
    want = {}
    for a in sets:
        for b in sets:
            near = len({*a} & {*b}) / len({*a} | {*b})
            if a < b and near >= threshold:
                want[frozenset(("".join(a), "".join(b)))] = near
    rows_ = spotsigs.similar(docs, threshold).collect()
    got = {frozenset((r.fingerprint, r.other)): r.near for r in rows_}
    assert want and len(rows_) == len(got) and got == want


def test_similar_reaches_sets_at_the_bound(spark):
    words = [f"w{i}" for i in range(731)]  # no anchors: 729 triples, and 243 of them
    docs = frame(spark, [(1, " ".join(words), *[None] * 5), (2, " ".join(words[:245]), *[None] * 5)])
    (got,) = spotsigs.similar(docs, 1 / 3).collect()
    assert got.near == 243 / 729
    with pytest.raises(ValueError):
        spotsigs.similar(docs, 0.0)
