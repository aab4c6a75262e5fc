"""Source divergence against a brute-force count."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import pyarrow as pa
import pytest

from censa.llm import divergence

from .fixtures import by_row, frame, rows

COLUMNS = ["lang", "source", "part", "item", "value", "rank"]


def brute(data, min_docs, top=50):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    groups, docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for _, text, lang, source, *_ in data:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        groups[lang, source].update(terms)
        docs[lang].update(set(terms))
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = sorted(t for t, n in docs[lang].items() if n >= min_docs)

        def shares(count, kept=kept):
            total = sum(count[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (count[t] + 5) // (total + 5 * len(kept)) for t in kept}
        p = {s: shares(groups[lang, s]) for s in sources}
        q = shares(sum((groups[lang, s] for s in sources), Counter()))
        for s in sources:
            pair = [(o, sum(abs(p[s][t] - p[o][t]) for t in kept)) for o in sources if o != s]
            term = [(t, p[s][t] - q[t]) for t in kept if groups[lang, s][t] and p[s][t] > q[t]]
            for part, found, limit in (("pair", pair, None), ("term", term, top)):
                found.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, item, value, k) for k, (item, value) in enumerate(found[:limit], 1)]
    return sorted(out, key=repr)


def sample(seed, n, sources, langs=("en", "de", None)):
    rng = random.Random(seed)
    words = [f"{a}{b}" for a in "abcdéß中" for b in "xyzXYZ"]
    weights = [1 / (k + 1) for k in range(len(words))]
    out = []
    for i in range(n):
        source = rng.choice(sources)
        drawn = rng.choices(words, [w * (1 + (hash_of(source) + k) % 3) for k, w in enumerate(weights)], k=rng.randint(0, 60))
        out.append((i, rng.choice([" ", "7", "\n"]).join(drawn), rng.choice(langs), source, None, "c", "c"))
    return out


def hash_of(source):
    return sum(map(ord, source or ""))


@pytest.mark.parametrize("min_docs", [1, 3, 1000])
def test_awkward_rows(spark, min_docs):
    data = [(*r[:3], ["s", "t", None, ""][i % 4], *r[4:]) for i, r in enumerate(rows())]
    got = by_row(divergence.audit(frame(spark, data), min_docs), *COLUMNS)
    assert got == brute(data, min_docs)


def test_more_sources_than_a_side_and_more_terms_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", 3)
    monkeypatch.setattr(divergence, "WORDS", 1)
    monkeypatch.setattr(divergence, "HELD", 50)
    data = sample(2, 300, [f"src{k}" for k in range(8)] + [None])
    more = [(900 + k, " ".join(f"t{j:03d}".translate(str.maketrans("0123456789", "ghijklmnop")) for j in range(k, k + 90)),
             "en", f"src{k % 5}", None, "c", "c") for k in range(60)]
    got = by_row(divergence.audit(frame(spark, data + more), 4, top=7), *COLUMNS)
    assert got == brute(data + more, 4, 7)


def test_hot_source_and_no_terms(spark):
    data = sample(3, 200, ["big"] * 6 + ["a", "b"], ["en"]) + [(999, "12 34", "en", "empty", None, "c", "c"),
                                                               (998, None, "xx", "only", None, "c", "c")]
    got = by_row(divergence.audit(frame(spark, data)), *COLUMNS)
    assert got == brute(data, 30)
    assert not [r for r in got if r[0] == "xx"]


def test_long_text_in_slices(monkeypatch):
    text = ("Wort-" * 10 + "é" * 30 + " x7y ").encode() * 50
    whole = divergence.TERM.findall(text.lower())
    monkeypatch.setattr(divergence, "SLICE", 17)
    assert [t for part in divergence.terms_of(text) for t in part] == whole


def test_kernel_counts_zero_by_complement():
    table = pa.table({"word": pa.array([None, None, 0, 0, 1], pa.int64()), "source": ["a", "b", "a", "b", "a"],
                      "p": [1, 2, 10, 20, 30], "bits": [6, 6, 0b011, 0b110, 0b1], "side": [2, 2, 2, 2, 2]})
    got = {(r["source"], r["item"]): r["value"] for r in divergence.joint_sums(table).to_pylist()}
    # word 0: |10-2| + |10-20| + |1-20|; word 1: |30-2|; two of the block's six terms in neither: |1-2| each
    assert got == {("a", "b"): 8 + 10 + 19 + 28 + 2, ("b", "a"): 67}


def test_empty_table(spark):
    assert divergence.audit(frame(spark, [])).count() == 0
