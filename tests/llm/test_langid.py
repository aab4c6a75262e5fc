"""Language profiles: explicit hypervectors, held-out accuracy, edge rules."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa

from censa.llm import langid

from .fixtures import frame, rows


def test_lookup_equals_explicit_vectors():
    """Bundling every trigram's bound vector and taking cosines gives the
    looked-up order and score."""
    texts = ["the house of the river", "der Fluß und das Haus", "", "Été à l'école; 中文 zz"]
    batch = pa.record_batch({"text": texts})
    grams, bounds, letters = langid.trigrams(batch)
    counts = [tuple(np.unique(grams[bounds[i]:bounds[i + 1]], return_counts=True)) for i in (0, 1)]
    table = langid.score_table(["en", "de"], counts, dimensions=256)
    base = np.random.default_rng(langid.SEED).choice(np.array([-1, 1], np.int8), (langid.SYMBOLS, 256)).astype(float)

    def bundle(i):
        out = np.zeros(256)
        for g in grams[bounds[i]:bounds[i + 1]]:
            a, b, c = g // langid.SYMBOLS ** 2, g // langid.SYMBOLS % langid.SYMBOLS, g % langid.SYMBOLS
            out += np.roll(base[a], 2) * np.roll(base[b], 1) * base[c]
        return out

    for i in (0, 1, 3):
        for k in (0, 1):
            prototype = bundle(k)
            want = bundle(i) @ prototype / np.linalg.norm(prototype)
            assert abs(table[k][grams[bounds[i]:bounds[i + 1]]].sum() - want) < 1e-3 * max(1, abs(want))
    assert letters.tolist() == [18, 17, 0, 14]


def test_trigrams_do_not_depend_on_neighbours():
    texts = ["abc.", "", ".x", "de", "  q  ", None]
    together, bounds, _ = langid.trigrams(pa.record_batch({"text": pa.array(texts, pa.string())}))
    for i, t in enumerate(texts):
        alone, _, _ = langid.trigrams(pa.record_batch({"text": pa.array([t], pa.string())}))
        assert together[bounds[i]:bounds[i + 1]].tolist() == alone.tolist()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langid.identify(docs.select("doc_id", "text", "lang")).toPandas().merge(docs.select("doc_id", "lang").toPandas())
    assert (got["held_out"] == got["doc_id"].map(lambda i: zlib.crc32(str(i).encode()) % 4 == 2)).all()
    out = got[got["held_out"]]
    assert len(out) > 100 and (out["lang_pred"] == out["lang"]).mean() > 0.97
    assert got["score"].between(0, 1).all()


def test_edges(spark):
    got = langid.identify(frame(spark)).collect()
    assert len(got) == len(rows())
    texts = {r[0]: r[1] for r in rows()}
    for r in got:
        if r.doc_id == 1000 or r.doc_id in (42, 45, 48):
            assert (r.lang_pred, r.score) == ("und", 0.0), (r, texts[r.doc_id])
        if r.doc_id is None:
            assert r.held_out is False
    assert langid.identify(frame(spark, [])).count() == 0
    nothing = langid.identify(frame(spark, [(1, "some text", None, None, None, None, None)])).collect()
    assert [(r.lang_pred, r.score) for r in nothing] == [("und", 0.0)]
