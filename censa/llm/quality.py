"""Quality rules on repetition from a suffix array of words (operator 1).

Each text's words are sorted as suffixes (prefix doubling over word numbers,
texts kept apart), and the longest common prefixes of neighbouring suffixes
give each suffix's deepest interval: the longest stretch of words from there
that occurs again in the text. Where the stretch one word to the left does not
already contain it, it is a maximal repeated substring. The union of the
maximal repeats of ``min_repeat`` or more words gives the covered fraction. A
text is rejected when that fraction or its longest repeat passes its limit, or
when a base rule fails (fewer than 50 words, or over half of the words in
3-word windows that occur twice).

Edge rules: a null text has no words and fails; repeated rows are judged each
on their own; equal lines count from the second on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import binary_array, covered, pieces, prefix, utf8, word_bounds

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MIN_REPEAT = 8
MAX_COVERED = 0.4
MAX_LONGEST = 200

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def suffix_ranks(ids: np.ndarray, row: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... words, up to the
    length at which all differ. ``end`` is the end of each place's row; a
    suffix never compares equal to one of another row."""
    n = len(ids)
    key = row.astype(np.int64) * (int(ids.max()) + 1 if n else 1) + ids
    order = np.argsort(key, kind="stable")
    ranks = []
    rank = np.empty(n, np.int32)
    active, group = order, key[order]
    base = np.zeros(n, np.int64)  # rank of the group that each active suffix belongs to
    k = 1
    while True:
        new = np.ones(len(active), bool)
        new[1:] = (group[1:] != group[:-1]) | (base[1:] != base[:-1])
        first = np.maximum.accumulate(np.where(new, np.arange(len(active)), 0))
        outer = np.ones(len(active), bool)
        outer[1:] = base[1:] != base[:-1]
        start = np.maximum.accumulate(np.where(outer, np.arange(len(active)), 0))
        rank[active] = base + first - start
        ranks.append(rank.copy())
        alone = new & np.append(new[1:], True)
        active = active[~alone]
        if not len(active):
            return ranks
        base = rank[active].astype(np.int64)
        after = active + k
        inside = after < end[row[active]]
        second = np.where(inside, ranks[-1][np.minimum(after, n - 1)].astype(np.int64) + 1, 0)
        by = np.lexsort((second, base))
        active, base, group = active[by], base[by], second[by]
        k *= 2


def longest_repeats(ids: np.ndarray, row: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each place, the words from there on that also occur elsewhere in
    the row: the larger of the common prefixes with both neighbours in suffix
    order."""
    n = len(ids)
    longest = np.zeros(n, np.int64)
    if n < 2:
        return longest
    ranks = suffix_ranks(ids, row, end)
    order = np.empty(n, np.int64)
    order[ranks[-1]] = np.arange(n)
    pair = np.flatnonzero(ranks[0][order[1:]] == ranks[0][order[:-1]])
    i, j = order[pair], order[pair + 1]
    common = np.zeros(len(pair), np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        r, last = ranks[level], end[row[i]]
        a, b = i + common, j + common
        same = (a < last) & (b < last)
        same[same] = r[a[same]] == r[b[same]]
        common[same] += 1 << level
    np.maximum.at(longest, i, common)
    np.maximum.at(longest, j, common)
    return longest


def measure(batch: pa.RecordBatch, min_repeat: int) -> dict[str, np.ndarray]:
    """The counts of each row of a batch with a ``text`` column."""
    data, off = utf8(batch.column("text"))
    n = len(off) - 1
    starts, ends, begin = word_bounds(data, off)
    words = np.diff(begin)
    row = np.repeat(np.arange(n), words)
    is_word = np.zeros(len(data), bool) if not len(starts) else covered(len(data), starts, ends)
    chars = np.diff(prefix(is_word & ((data & 0xC0) != 0x80))[off])
    symbols = np.diff(prefix(_SYMBOL[data])[off])
    # lines with a word; all but one of each row's equal lines repeat an earlier one
    feed = np.flatnonzero(data == 10)
    line_row = np.concatenate([np.searchsorted(off, feed, "right") - 1, np.arange(n)])
    line_end = np.concatenate([feed, off[1:]])
    by = np.lexsort((line_end, line_row))
    line_row, line_end = line_row[by], line_end[by]
    line_start = np.concatenate([[0], line_end[:-1] + 1])
    line_start[np.concatenate([[True], line_row[1:] != line_row[:-1]])] = off[:-1]
    ids_of = binary_array(data[data != 10], line_end - line_start)
    seen = prefix(is_word)
    full = seen[line_end] > seen[line_start]
    lines = ids_of.filter(pa.array(full)).dictionary_encode()
    key = line_row[full] * (len(lines.dictionary) + 1) + lines.indices.to_numpy()
    distinct = np.unique(key) // (len(lines.dictionary) + 1)
    dup_lines = np.bincount(line_row[full], minlength=n) - np.bincount(distinct, minlength=n)
    # suffix array over word numbers
    ids = binary_array(data[is_word], ends - starts).dictionary_encode().indices.to_numpy().astype(np.int64)
    stop = begin[1:]
    length = longest_repeats(ids, row, stop)
    place = np.arange(len(ids))
    triple = place[length >= 3]
    repeat_words = np.diff(prefix(covered(len(ids), triple, triple + 3))[begin])
    left = np.concatenate([[0], length[:-1]])
    left[begin[:-1][words > 0]] = 0
    maximal = place[(length >= min_repeat) & (left <= length)]
    span_words = np.diff(prefix(covered(len(ids), maximal, maximal + length[maximal]))[begin])
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, row, length)
    return {"n_words": words, "word_chars": chars, "n_symbols": symbols, "n_dup_lines": dup_lines,
            "n_repeat_words": repeat_words, "n_span_words": span_words, "longest_repeat": longest,
            "n_maximal": np.bincount(row[maximal], minlength=n)}


def quality_rules(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED,
                  max_longest: int = MAX_LONGEST, keep: list[str] | None = None,
                  verdict: str | None = None) -> DataFrame:
    """doc_id, the counts, ``base_failed`` and ``kept`` of every row. With
    ``keep`` and ``verdict``: the columns named in ``keep``, whatever they are
    called, and the verdict under that name alone."""
    passed = keep or ["doc_id"]
    counts = [] if verdict else ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_span_words",
              "longest_repeat", "n_maximal"]
    frame = docs.select(*dict.fromkeys([*passed, "text"]))
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema if f.name in passed]
                       + [f"{c} long" for c in counts]
                       + ([f"`{verdict}` boolean"] if verdict else ["base_failed boolean", "kept boolean"]))
    last = [verdict] if verdict else ["base_failed", "kept"]
    passed = [c for c in frame.columns if c in passed]

    def run(batches):
        for whole in batches:
            for b in pieces(whole):
                m = measure(b, min_repeat)
                failed = (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])
                kept = ~failed & (m["n_span_words"] <= max_covered * m["n_words"]) & (m["longest_repeat"] <= max_longest)
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in passed),
                     *(pa.array(m[c].astype(np.int64)) for c in counts),
                     *([pa.array(kept)] if len(last) == 1 else [pa.array(failed), pa.array(kept)])],
                    [*passed, *counts, *last])

    return frame.mapInArrow(run, schema)
