"""License scan against a plain reading of its rules."""

from __future__ import annotations

import re

from censa.llm import licenses

from .fixtures import by_row, frame, rows

NOTICE = "Licensed under the Apache License, Version 2.0."
TEXTS = ["Licensed under CC BY-NC 4.0.", "cc by cc by cc-by", "All Rights\nReserved. GNU GENERAL PUBLIC LICENSE", NOTICE,
         "x " * 500 + NOTICE + " y" * 500 + " " + NOTICE, "the MIT license; éCC BY", "released under the MIT License!",
         "general public licenses all rights", "cc", "", None, "GNU Lesser General Public License (LGPL)",
         "Permission is hereby granted, free of charge, to any person holding a copy", "1cc by2"]


def brute(doc_id, text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places, labels = [], set()
    for phrase, label in licenses.BASE.items():
        p = phrase.split()
        at = [i for i in range(len(words)) if words[i:i + len(p)] == p]
        places += at
        if at:
            labels.add(label)
    base, score = sorted(labels), 0.0
    index = licenses.postings(licenses.TEMPLATES, licenses.RARE)
    for t, (label, notice, key) in enumerate(licenses.TEMPLATES):
        tw, kw = notice.split(), key.split()
        offset = next(i for i in range(len(tw)) if tw[i:i + len(kw)] == kw)
        for start in range(-len(tw), len(words)):
            rare = sum(1 for p, w in enumerate(tw) if w in index and 0 <= start + p < len(words) and words[start + p] == w)
            at = start + offset
            if rare >= licenses.AGREE and at >= 0 and words[at:at + len(kw)] == kw:
                labels.add(label)
                score = max(score, sum(0 <= start + p < len(words) and words[start + p] == w for p, w in enumerate(tw)) / len(tw))
    return (doc_id, len(words), len(places), min(places, default=None), max(places, default=None), ",".join(base),
            ",".join(sorted(labels)), 1.0 if places else score)


def test_equals_brute_force(spark):
    data = [(i, t, *[None] * 5) for i, t in enumerate(TEXTS)] + [r for r in rows() if r[1] is None or len(r[1]) < 3000]
    got = by_row(licenses.scan(frame(spark, data)).drop("found"),
                 "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")
    want = sorted((brute(r[0], r[1]) for r in data), key=repr)
    assert [g[:-1] for g in got] == [w[:-1] for w in want]
    assert all(abs(g[-1] - w[-1]) < 1e-12 for g, w in zip(got, want, strict=True))


def test_edited_notice_scores_below_one(spark):
    got = licenses.scan(frame(spark, [(1, TEXTS[12] + " of this software", *[None] * 5)])).first()
    assert got.labels == "mit" and got.n_base == 0 and 0.5 < got.score < 1


def test_key_phrase_alone_is_enough(spark):
    notices = {"Mozilla Public License, v. 2.0": "mpl", "Mozilla Public License Version 2.0": "mpl",
               "distributed under the terms of the Mozilla Public License": "mpl",
               "Licensed under the MIT License": "mit", "The MIT License (MIT)": "mit",
               "a public license of Mozilla": "", "the license of MIT": ""}
    got = licenses.scan(frame(spark, [(i, t, *[None] * 5) for i, t in enumerate(notices)]))
    assert {r.doc_id: r.labels for r in got.collect()} == dict(enumerate(notices.values()))


def test_every_key_phrase_is_found_alone(spark):
    data = [(i, f"x {key} y", *[None] * 5) for i, (_, _, key) in enumerate(licenses.TEMPLATES)]
    got = {r.doc_id: r.labels.split(",") for r in licenses.scan(frame(spark, data)).collect()}
    assert all(label in got[i] for i, (label, _, _) in enumerate(licenses.TEMPLATES))
    one_word = (("x", "under foo license", "foo"), ("y", "the bar baz", "bar baz"))
    assert [r.labels for r in licenses.scan(frame(spark, [(1, "foo", *[None] * 5)]), one_word).collect()] == ["x"]


def test_no_python_and_no_shuffle(spark):
    plan = licenses.scan(frame(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty(spark):
    assert licenses.scan(frame(spark, [])).count() == 0
