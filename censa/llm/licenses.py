"""License scan by a positional index of rare words, DataFrame functions only
(operator 5).

Words are runs of digits, letters a-z (A-Z lower-cased) and characters
outside ASCII. The templates below are indexed by word: each word's postings
are the templates and positions it has, and its inverse document frequency is
taken over the templates, where common words of the language and single
characters count as being in all. A file's licence words of the highest
frequencies (those in at most RARE templates, and as many more of a key phrase
that AGREE of its words are among them) are looked up; every posting says where
its template would have to start. Starts on which AGREE of a template's words
agree are kept, and a start counts if the template's mandatory key phrase
stands in its place. So a key phrase alone is enough: its own words agree.
The share of the template's words found in place is its score.

Everything is computed within the row from the places of its licence words,
so nothing is shuffled and a long file costs in proportion to its length.

Base labels: places where a base phrase's words stand consecutively; such a
file scores 1.

Edge rules: a null text is empty and has no label; labels are distinct and
sorted; repeated rows are scanned each on their own.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

# Base phrases and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Templates: label, notice, mandatory key phrase (part of the notice).
TEMPLATES = (
    ("agpl", "gnu affero general public license", "affero general public license"),
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    ("gpl", "this work is licensed under the gnu general public license", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is "
            "hereby granted", "with or without fee is hereby granted"),
    ("lgpl", "gnu lesser general public license", "lesser general public license"),
    ("mit", "released under the mit license", "the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge to any person"),
    ("mpl", "subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "unencumbered software released into the public domain"),
)
# Words of the templates that are common in any text.
COMMON = frozenset("and any are by code for form free in into is of or terms the this to under use with without work".split())
#: Words in at most so many templates are rare.
RARE = 3
#: Looked-up words of a template that must agree on its start.
AGREE = 2
_SPAN = 1 << 40


def postings(templates, rare: int, agree: int = AGREE) -> dict[str, list[tuple[int, int]]]:
    """Rare words, by falling inverse document frequency, with (template,
    position) of each. A key phrase with fewer than ``agree`` of them adds its
    next words of the highest frequencies."""
    where = defaultdict(list)
    for t, (_, notice, _) in enumerate(templates):
        for p, w in enumerate(notice.split()):
            where[w].append((t, p))
    plain = {w for w in where if len(w) == 1 or w in COMMON}
    idf = {w: 0.0 if w in plain else math.log(len(templates) / len({t for t, _ in at})) for w, at in where.items()}
    least = math.log(len(templates) / rare)
    order = sorted(where, key=lambda w: (-idf[w], w))
    chosen = {w for w in order if idf[w] >= least - 1e-9}
    for _, _, key in templates:
        words = sorted(key.split(), key=order.index)
        missing = agree - sum(w in chosen for w in words)
        chosen.update([w for w in words if w not in chosen][:max(missing, 0)])
    return {w: where[w] for w in order if w in chosen}


def in_place(start: Column, words: list[str], offset: int = 0) -> Column:
    """Whether ``words`` stand consecutively from ``start + offset``."""
    ok = F.lit(True)
    for k, w in enumerate(words):
        ok = ok & F.coalesce(F.get("_words", start + (offset + k)) == w, F.lit(False))
    return ok


def scan(docs: DataFrame, templates=TEMPLATES, rare: int = RARE, agree: int = AGREE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels,
    score, and ``found`` (label and start of each verified template)."""
    agree = min([agree, *(len(key.split()) for _, _, key in templates)])  # a key phrase alone is enough
    index = postings(templates, rare, agree)
    starts_of = sorted({p.split()[0] for p in BASE})
    vocabulary = sorted({*index, *starts_of})
    words = F.filter(F.split(ascii_lower(F.coalesce("text", F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    hits = F.filter(F.transform("_words", lambda w, i: F.struct(w.alias("w"), i.alias("i"))),
                    lambda x: x["w"].isin(vocabulary))
    out = (docs.select("doc_id", words.alias("_words")).withColumn("_hits", hits))

    def places(phrase: str) -> Column:
        first, *rest = phrase.split()
        return F.transform(F.filter("_hits", lambda x: (x["w"] == first) & in_place(x["i"] + 1, rest)), lambda x: x["i"])

    base = [(label, places(phrase)) for phrase, label in BASE.items()]
    out = out.withColumns({f"_base{k}": at for k, (_, at) in enumerate(base)})
    every = F.concat(*(F.col(f"_base{k}") for k in range(len(base))))
    base_labels = F.concat(*(F.when(F.size(f"_base{k}") > 0, F.array(F.lit(label))).otherwise(F.array().cast("array<string>"))
                             for k, (label, _) in enumerate(base)))

    def votes(x):  # where the templates of this word would start, as one number each
        out_ = F.array().cast("array<long>")
        for w, at in index.items():
            out_ = F.when(x["w"] == w, F.array(*(F.lit(t * _SPAN + _SPAN // 2 - p) + x["i"] for t, p in at))).otherwise(out_)
        return out_

    all_votes = F.sort_array(F.flatten(F.transform("_hits", votes)))
    agreed = F.array_distinct(F.filter("_votes", lambda v, i: F.coalesce(F.get("_votes", i + (agree - 1)) == v, F.lit(False))))
    template = lambda v: F.floor(v / _SPAN).cast("int")
    start = lambda v: (v % _SPAN - _SPAN // 2).cast("int")

    def verified(v):
        ok = F.lit(False)
        for t, (_, notice, key) in enumerate(templates):
            at = f" {notice} ".index(f" {key} ")
            offset = len(notice[:at].split())
            ok = F.when(template(v) == t, in_place(start(v), key.split(), offset)).otherwise(ok)
        return ok

    def share(v):
        out_ = F.lit(0.0)
        for t, (_, notice, _) in enumerate(templates):
            ws = notice.split()
            same = sum((F.when(F.get("_words", start(v) + k) == w, 1).otherwise(0) for k, w in enumerate(ws)), F.lit(0))
            out_ = F.when(template(v) == t, same / len(ws)).otherwise(out_)
        return out_

    names = F.array(*(F.lit(t[0]) for t in templates))
    found = F.transform(F.filter("_agreed", verified),
                        lambda v: F.struct(F.get(names, template(v)).alias("label"), start(v).cast("long").alias("start"), share(v).alias("share")))
    out = out.withColumn("_votes", all_votes).withColumn("_agreed", agreed).withColumn("found", found)
    joined = lambda labels: F.array_join(F.sort_array(F.array_distinct(labels)), ",")
    return out.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"), F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"), F.array_max(every).cast("long").alias("last_word"),
        joined(base_labels).alias("base_labels"),
        joined(F.concat(base_labels, F.transform("found", lambda x: x["label"]))).alias("labels"),
        F.when(F.size(every) > 0, 1.0).otherwise(F.coalesce(F.array_max(F.transform("found", lambda x: x["share"])), F.lit(0.0))).alias("score"),
        "found")
