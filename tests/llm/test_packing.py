"""Packing: ids equal the tokenizers library, pieces tile documents and
sequences, padding is small, the linear program is optimal."""

from __future__ import annotations

import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import tokenizers

from censa.llm import packing

from .fixtures import frame, rows
from .test_bpe import HARD

PATH = public_tokenizers.path("byte_bpe_50k.json")
WHOLE = tokenizers.Tokenizer.from_file(PATH)


def check(got, data, capacity):
    """Every id lies in exactly one piece; sequences are gapless and short
    enough; checksums are those of the library's ids."""
    def ids_of(text):
        return np.array(WHOLE.encode(text or "", add_special_tokens=False).ids + [0], "<u4")
    want = sorted(((r[0], len(i), i.tobytes()) for r in data for i in [ids_of(r[1])]), key=repr)
    by_doc = defaultdict(list)
    for p in got:
        by_doc[p.doc_id, p.doc_tokens].append(p)
    copies = defaultdict(list)
    for d, n, raw in want:
        copies[d, n].append(raw)
    assert set(by_doc) == set(copies)
    for key, raws in copies.items():
        pieces = sorted((p.start, p.length, p.ids_crc32) for p in by_doc[key])
        expect = sorted((s, min(capacity, key[1] - s), zlib.crc32(raw[4 * s:4 * (s + capacity)]))
                        for raw in raws for s in range(0, key[1], capacity))
        assert pieces == expect
    sequences = defaultdict(list)
    for p in got:
        sequences[p.sequence_id].append((p.offset, p.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


@pytest.mark.parametrize("capacity", [1024, 64])
def test_pieces_and_sequences(spark, capacity):
    data = rows() + [(2000 + i, t, *[None] * 5) for i, t in enumerate(HARD)]
    check(packing.pack(frame(spark, data), PATH, capacity, salts=3).collect(), data, capacity)


def test_little_padding(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = packing.pack(docs, PATH).collect()
    sequences = check(got, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 1024)
    ids = sum(p.length for p in got)
    assert len(sequences) * 1024 <= 1.02 * ids


def test_columns_reach_the_bound():
    rng = np.random.default_rng(4)
    size = np.arange(1, 65)
    demand = rng.integers(50, 400, 64)
    plan = packing.plan(size, demand, 64)
    packed = np.zeros(65, int)
    for pattern, times in plan:
        assert sum(c * m for c, m in pattern.items()) <= 64
        for c, m in pattern.items():
            packed[c] += m * times
    assert packed[1:].tolist() == demand.tolist()
    assert sum(t for _, t in plan) <= 1.01 * np.ceil((size * demand).sum() / 64) + 2


def test_units_random_bytes():
    encoder = packing.UnitEncoder(PATH)
    rng = random.Random(9)
    parts = ["a", "bc", " ", "  ", "\n", "'", "'ll", "s", "1", "é", "!", " ", " ", "\x1c", "\u0085", "中", " x"]
    from censa.llm.common import binary_array, utf8
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(500)]
    raw = np.frombuffer("".join(texts).encode(), np.uint8)
    data, off = utf8(binary_array(raw, np.array([len(t.encode()) for t in texts])))
    ids, bounds = encoder.rows(data, off)
    for i, t in enumerate(texts):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == [*WHOLE.encode(t, add_special_tokens=False).ids, 0], repr(t)


def test_empty(spark):
    assert packing.pack(frame(spark, []), PATH).count() == 0
