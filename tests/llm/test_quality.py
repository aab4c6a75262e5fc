"""Quality rules against a brute-force count."""

from __future__ import annotations

import random
import re
from collections import Counter

from censa.llm import quality

from .fixtures import by_row, frame, rows


def brute(doc_id, text, min_repeat=quality.MIN_REPEAT):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    n = len(words)
    chars = sum(map(len, words))
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(n - 2))
    repeat = {j for i in range(n - 2) if windows[tuple(words[i:i + 3])] > 1 for j in range(i, i + 3)}
    spans, longest = set(), 0
    for i in range(n):
        best = 0
        for j in range(n):
            k = 0
            while i != j and max(i, j) + k < n and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        longest = max(longest, best)
        if best >= min_repeat:
            spans |= set(range(i, i + best))
    failed = n < 50 or 100 * len(repeat) > 50 * n
    kept = not failed and len(spans) <= quality.MAX_COVERED * n and longest <= quality.MAX_LONGEST
    return doc_id, n, chars, symbols, len(lines) - len(set(lines)), len(repeat), len(spans), longest, failed, kept


COLUMNS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_span_words",
           "longest_repeat", "base_failed", "kept"]


def test_equals_brute_force(spark):
    data = [r for r in rows() if r[1] is None or len(r[1]) < 6000]
    got = by_row(quality.quality_rules(frame(spark, data)), *COLUMNS)
    assert got == sorted((brute(r[0], r[1]) for r in data), key=repr)


def test_random_small_alphabets(spark):
    rng = random.Random(7)
    data = [(i, "".join(rng.choice(["a ", "b ", "c\n", "a|", "\n"]) for _ in range(rng.randint(0, 90))),
             None, None, None, None, None) for i in range(60)]
    got = by_row(quality.quality_rules(frame(spark, data), min_repeat=4), *COLUMNS)
    assert got == sorted((brute(r[0], r[1], 4) for r in data), key=repr)


def test_long_copy_is_rejected_and_clean_text_kept(spark):
    rng = random.Random(3)
    clean = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(800))
    half = " ".join(f"w{rng.randint(0, 5000)}" for _ in range(500))
    data = [(1, clean, *[None] * 5), (2, half + " " + half, *[None] * 5)]
    kept = {r.doc_id: r.kept for r in quality.quality_rules(frame(spark, data)).collect()}
    assert kept == {1: True, 2: False}


def test_empty_table(spark):
    assert quality.quality_rules(frame(spark, [])).count() == 0
