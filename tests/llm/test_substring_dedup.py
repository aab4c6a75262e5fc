"""Level-wise doubling against brute force over all windows."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from censa.llm import anchors, substring_dedup
from censa.llm.queries import op7_doubling_dedup

from .fixtures import by_row, frame, rows


def brute(data, window):
    words = [re.findall(r"[^\x20\x09-\x0D]+", r[1] or "") for r in data]
    seen = Counter(tuple(w[i:i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(data, words, strict=True):
        gone = {j for i in range(len(w) - window + 1) if seen[tuple(w[i:i + window])] > 1 for j in range(i, i + window)}
        kept = " ".join(x for j, x in enumerate(w) if j not in gone)
        out.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


COLUMNS = ["doc_id", "n_words", "n_removed", "kept_sha256"]


def test_query_equals_brute_force(spark, tmp_path):
    data = rows()
    frame(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    got = by_row(op7_doubling_dedup(spark, str(tmp_path)), *COLUMNS)
    assert got == brute(data, 35)
    assert sum(g[2] for g in got) > 500


@pytest.mark.parametrize("window", [1, 5, 16, 35])
def test_random_repeats(spark, window):
    rng = random.Random(window)
    parts = [" ".join(rng.choice("abcdefgh") for _ in range(rng.randint(5, 60))) for _ in range(12)]
    data = [(i, " \n".join(rng.choice(parts) + f" u{rng.randint(0, 99)}" for _ in range(rng.randint(0, 6))), *[None] * 5)
            for i in range(50)]
    assert by_row(substring_dedup.remove_repeats(frame(spark, data), window), *COLUMNS) == brute(data, window)


def test_word_hash_by_value():
    text = np.frombuffer(b"abc abcdefgh abcdefghi abc " + b"x" * 100 + b" " + b"x" * 100 + b" abcdefghj", np.uint8)
    starts, ends, _ = __import__("censa.llm.common", fromlist=["x"]).word_bounds(text, np.array([0, len(text)]))
    h = substring_dedup.word_hashes(text, starts, ends, 7)
    assert h[0] == h[3] and h[4] == h[5] and len(set(h.tolist())) == 5


def test_slot_numbers_equal_spark(spark):
    from pyspark.sql import functions as F
    ids = [0, 1, 77, 1 << 33, (1 << 40) + 5]
    got = spark.createDataFrame([(i,) for i in ids], "rid long").select(F.pmod(F.xxhash64("rid"), F.lit(97)).cast("int")).collect()
    assert anchors.slot_numbers(np.array(ids), 97).tolist() == [r[0] for r in got]


def test_empty(spark):
    assert substring_dedup.remove_repeats(frame(spark, [])).count() == 0
