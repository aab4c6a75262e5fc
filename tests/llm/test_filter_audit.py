"""Filter interactions against a count of every order over all documents."""

from __future__ import annotations

import itertools
import random
import re

import pytest

from censa.llm import filter_audit

from .fixtures import by_row, frame, rows, sentence

LABELS = "doc_id long, quality int, toxic int, text string"
COLUMNS = ["part", *filter_audit.NAMES]


def brute(data, labels):
    docs = []
    for doc_id, text, lang, *_ in data:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        failed = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words),
                  "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": re.search(r"[#$%&*|]", text) is not None,
                  "E": doc_id is not None and any(o[0] is not None and o[0] < doc_id and (o[1] or "") == text for o in data)}
        own = [x for x in labels if x[0] is not None and x[0] == doc_id]
        docs.append((lang or "", failed, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = []
    for part in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == part]
        shapley, found = dict.fromkeys("ABCDE", 0), []
        for order in itertools.permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                shapley[f] += len(gone)
                found.append(("".join(order), step, len(left), len(gone), sum(d[1][f] for d in mine) - len(gone),
                              sum(d[1][f] and sum(d[1].values()) == 1 for d in mine), sum(d[2] for d in gone), sum(d[3] for d in gone)))
        out += [(part, *r, shapley[r[0][r[1] - 1]]) for r in found]
    return sorted(out, key=repr)


def sample():
    rng = random.Random(4)
    data = rows()
    for i in range(120):
        text = " ".join(f"w{rng.randint(0, rng.choice([40, 5000]))}" for _ in range(rng.choice([20, 99, 100, 101, 400])))
        if rng.random() < 0.3:
            text = text.upper()
        if rng.random() < 0.3:
            text += rng.choice(" #$%&*|")
        data.append((2000 + i, text, rng.choice(["en", "de", None, ""]), "s", None, "k", "s"))
        if rng.random() < 0.3:
            data.append((rng.choice([1500 - i, 2000 + i, 4000 + i]), text, "fr", "s", None, "k", "s"))
    labels = [(r[0], rng.choice([0, 1, None]), rng.choice([0, 1, None]), "clash") for r in data if rng.random() < 0.7]
    return data, labels + [(-5, 1, 1, "no such document"), (None, 1, 1, None)]


def test_equals_brute_force(spark):
    data, labels = sample()
    got = by_row(filter_audit.audit(frame(spark, data), spark.createDataFrame(labels, LABELS)), *COLUMNS)
    assert got == brute(data, labels)
    assert {r[0] for r in got} >= {"", "en", "de", "fr"} and len(got) == 600 * len({r[0] for r in got})


def test_empty_tables(spark):
    none = spark.createDataFrame([], LABELS)
    assert filter_audit.audit(frame(spark, []), none).count() == 0
    got = filter_audit.audit(frame(spark, [(1, None, None, None, None, None, None)]), none)
    assert by_row(got, *COLUMNS) == brute([(1, None, None)], [])


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6])
def test_adjacent_swaps_visit_every_order(n):
    order, seen = list(range(n)), set()
    seen.add(tuple(order))
    for k in filter_audit.adjacent_swaps(n):
        order[k], order[k + 1] = order[k + 1], order[k]
        assert tuple(order) not in seen
        seen.add(tuple(order))
    assert len(seen) == len(list(itertools.permutations(range(n))))


def test_swap_equals_a_fresh_diagram():
    rng = random.Random(9)
    masks = {m: (rng.randint(0, 3), rng.randint(0, 2), 0) for m in range(32) if rng.random() < 0.6}
    diagram = filter_audit.Diagram(masks, 5)
    for _ in range(50):
        diagram.swap(rng.randrange(4))
        left = dict(masks)
        for f, kept, removed in diagram.steps():
            gone = [w for m, w in left.items() if m >> f & 1]
            left = {m: w for m, w in left.items() if not m >> f & 1}
            assert removed == tuple(map(sum, zip(*gone, strict=True))) if gone else removed == (0, 0, 0)
            assert kept == tuple(map(sum, zip(*left.values(), strict=True))) if left else kept == (0, 0, 0)


def test_long_text_in_slices(monkeypatch):
    rng = random.Random(1)
    text = "\n \t".join(sentence(rng, 50) for _ in range(200)).encode()
    whole = filter_audit.text_mask(text)
    monkeypatch.setattr(filter_audit, "SLICE", 13)
    assert filter_audit.text_mask(text) == whole
    assert filter_audit.text_mask(b"x " * 99 + b"y") & 1 == 0 and filter_audit.text_mask(b"x " * 98 + b"y ") & 1 == 1
