"""Repeated-passage removal by level-wise doubling (operator 7).

Every word covered by a window of ``window`` words whose words also stand in
another place (of the same text or another) is removed; all occurrences go.
The windows are found level by level, each level about twice as long as the
last and the last of ``window`` words (35: 9, 18, 35). A window can only
repeat if the shorter windows within it do, so at each level only windows
whose anchored part repeated at the level before are looked at, until none
survive. Below the last level one anchored part stands for all windows around
it (see ``anchors``); at the last every surviving window is compared by a
128-bit hash of its words.

One task's rows at a time: a slot of a few MB of text, or one long text.

Edge rules: a null text has no words; equal rows are separate texts, so they
remove each other; texts shorter than the window stay whole. Judged on the
input alone.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .anchors import (DEALT, U64, anchor_flags, deal, deal_slot, groups_of, matched, mix, numbered, repeated,
                      sliding_min, slot_count)
from .common import covered, prefix, utf8, word_bounds

WINDOW = 35


def levels_of(window: int) -> list[int]:
    """Window lengths of the levels: halves, rounded up, down to 8 or so."""
    out = [window]
    while out[0] >= 16:
        out.insert(0, -(-out[0] // 2))
    return out


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int) -> np.ndarray:
    """64-bit hash of each word's bytes, eight at a time."""
    length = (ends - starts).astype(np.int64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded.tobytes(), strides=(1,))
    h = mix(length.astype(U64) + U64(seed))
    at, k = np.arange(len(starts)), 0
    while len(at):
        left = np.minimum(length[at] - k, 8)
        block = eight[starts[at] + k]
        cut = (U64(64) - U64(8) * left.astype(U64)) % U64(64)
        h[at] = mix(h[at] * U64(0x9E3779B97F4A7C15) ^ ((block << cut) >> cut))
        k += 8
        at = at[length[at] > k]
    return h


class Words:
    """Word hashes of a batch, and hashes of their windows."""

    def __init__(self, column, seed: int = 7):
        self.data, self.off = utf8(column)
        self.starts, self.ends, self.begin = word_bounds(self.data, self.off)
        self.counts = np.diff(self.begin)
        self.row = np.repeat(np.arange(len(self.counts)), self.counts)
        self.left = self.begin[1:][self.row] - np.arange(len(self.row))  # words from here to the row's end
        self.h = word_hashes(self.data, self.starts, self.ends, seed)

    def windows(self, length: int, seed: int) -> np.ndarray:
        """Hash of the ``length`` words from each place (rows not kept apart;
        see ``left``), by doubling: windows of powers of two, then two that
        overlap or touch."""
        h, reach = mix(self.h + U64(seed)), 1
        n = len(h)
        while 2 * reach <= length:
            later = np.concatenate([h[reach:], np.zeros(min(reach, n), U64)])
            h = mix(h * U64(0x9E3779B97F4A7C15) + later)
            reach *= 2
        if reach < length:
            step = length - reach
            later = np.concatenate([h[step:], np.zeros(min(step, n), U64)])
            h = mix(h * U64(0xD6E8FEB86659FD93) + later)
        return h | U64(1)


def level_anchors(w: Words, length: int, window: int, active: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Places (word numbers) of the anchored ``length``-windows of all active
    ``window``-windows, and the hashes of all places."""
    h = w.windows(length, length)
    whole = w.left >= window
    if active is not None:
        whole &= active
    return np.flatnonzero(anchor_flags(h, whole, window - length + 1)), h


def still_active(w: Words, length: int, window: int, row: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Windows whose anchored ``length``-part is among the surviving places."""
    h = w.windows(length, length)
    alive = np.zeros(len(h), bool)
    alive[w.begin[row] + place] = True
    span = window - length + 1
    if len(h) < span:
        return np.zeros(len(h), bool)
    least = sliding_min(h, span)
    best = sliding_min(np.where(alive, h, U64(0xFFFFFFFFFFFFFFFF)), span)
    out = np.zeros(len(h), bool)
    out[:len(least)] = best == least  # an anchor (tied ones are equal windows) survived
    return out & (w.left >= window)


def windows_repeated(rows: DataFrame, window: int, slots: int) -> DataFrame:
    """(slot, rids, places): starts (word numbers) of all windows that repeat."""
    sizes = levels_of(window)
    last = len(sizes) == 1

    def first(batches):
        for whole in batches:
            for b in groups_of(whole):
                w = Words(b.column("text"))
                at, h = level_anchors(w, sizes[0], window, None)
                more = Words(b.column("text"), 11).windows(window, window)[at] if last else None
                yield from deal(b.column("rid")[0].as_py(), w.row[at], at - w.begin[w.row[at]], h[at], more, slots,
                                b.column("slot").to_numpy(), False, 8 if last else 6)

    def level(before: int, size: int):
        def run(texts: pa.Table, found: pa.Table) -> pa.Table:
            out = []
            for rank, b, row, place in matched(texts, found):
                w = Words(b.column("text"))
                active = still_active(w, before, window, row, place)
                more = None
                if size < window:
                    at, h = level_anchors(w, size, window, active)
                else:
                    at, h = np.flatnonzero(active), w.windows(window, window)
                    more = Words(b.column("text"), 11).windows(window, window)[at]
                out.append((rank[w.row[at]], at - w.begin[w.row[at]], h[at], more))
            return deal_slot(texts.column("slot")[0].as_py() if texts.num_rows else 0, out, slots, False, 8 if size == window else 6)
        return run

    dealt = rows.mapInArrow(first, DEALT)
    for before, size in zip(sizes, sizes[1:], strict=False):
        found = repeated(dealt, slots, False)
        dealt = rows.groupBy("slot").cogroup(found.groupBy("slot")).applyInArrow(level(before, size), DEALT)
    return repeated(dealt, slots, False)


def remove_repeats(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by
    one space) and kept_text of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    slots = slot_count(docs)
    rows = numbered(docs, slots)
    starts = windows_repeated(rows, window, slots)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"]

    def finish(texts: pa.Table, found: pa.Table) -> pa.Table:
        out = []
        for _, b, row, place in matched(texts, found, every=True):
            data, off = utf8(b.column("text"))
            first, end, begin = word_bounds(data, off)
            at = begin[row] + place
            gone = covered(len(first), at, at + window)
            raw = data.tobytes()
            n = np.diff(begin)
            removed = np.diff(prefix(gone)[begin])
            kept = []
            for r, (a, z) in enumerate(zip(begin.tolist(), begin[1:].tolist(), strict=False)):
                if removed[r]:
                    stay = np.flatnonzero(~gone[a:z]) + a
                    kept.append(b" ".join(raw[x:y] for x, y in zip(first[stay].tolist(), end[stay].tolist(), strict=True)))
                else:
                    kept.append(b" ".join(raw[off[r]:off[r + 1]].split()))
            out.append(pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                 pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()),
                 pa.array([k.decode("utf-8", "replace") for k in kept], pa.string())], names))
        return pa.Table.from_batches(out) if out else pa.table({})

    return rows.groupBy("slot").cogroup(starts.groupBy("slot")).applyInArrow(
        finish, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string, kept_text string")
