"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 3).

A text's fingerprint has a bit set where more than half of its shingles'
64-bit hashes have it. Two fingerprints differ in at most d bits exactly if
some 64-bit word lies within ceil(d / 2) bits of the one and floor(d / 2) of
the other, so every distinct fingerprint emits all words (variants) of its
ball and those that share a variant are linked.

The shuffle goes by the variants' leading bits: a fingerprint is sent once to
each bucket that any of its variants falls in, and the bucket's task writes
out the rest of each variant, sorts, and verifies what collides. So the
variants (2,081 a fingerprint for 4 bits) are made where they meet, in memory
that a limit bounds: a bucket with more is worked on half by half. Within one
variant all members are linked to one centre, never pair by pair, and a bucket
hands on a spanning forest of its links.

Edge rules: a null text has no words and the fingerprint zero; equal
fingerprints are linked; the component's id is its smallest non-null id, null
if there is none; repeated rows come out as often as they went in.
"""

from __future__ import annotations

import math
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import pieces, utf8
from .components import connected_components

SHINGLE = 4
MAX_BITS = 4
SEED = 42
BITS = 64
#: Variants that a task holds at a time, and those aimed at for one bucket.
HOLD = 4 << 20


def fingerprint(words: list[bytes], shingle: int) -> int:
    """Unsigned 64-bit SimHash of a text's words."""
    import xxhash
    n = len(words)
    if not n:
        return 0
    if n < shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    text = b" ".join(words)
    starts = [0, *accumulate(len(w) + 1 for w in words)]
    digest = xxhash.xxh64_intdigest
    ends = [e - 1 for e in starts[shingle:]]
    ones = np.zeros(BITS, np.int64)
    total = len(ends)
    for at in range(0, total, 1 << 15):
        part = [digest(text[a:b], SEED) for a, b in zip(starts[at:at + (1 << 15)], ends[at:at + (1 << 15)], strict=False)]
        h = np.array(part, np.uint64).astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(h, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > total).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, keep: list[Column] | None = None) -> DataFrame:
    """Given columns (default: doc_id) and ``fp`` (signed long) of every row."""
    frame = docs.select(*(keep or [F.col("doc_id")]), F.col("text").alias("text"))
    names = frame.columns[:-1]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema][:-1] + ["fp long"])

    def run(batches):
        for whole in batches:
            for b in pieces(whole):
                data, off = utf8(b.column("text"))
                raw = data.tobytes().lower()  # bytes: A-Z alone
                fps = [fingerprint(raw[s:e].split(), shingle) for s, e in zip(off.tolist(), off[1:].tolist(), strict=False)]
                yield pa.RecordBatch.from_arrays(
                    [*(b.column(c) for c in names), pa.array(np.array(fps, np.uint64).view(np.int64))], [*names, "fp"])

    return frame.mapInArrow(run, schema)


def masks(bits: int, radius: int) -> list[np.ndarray]:
    """Words with exactly 0, 1, ... radius of the low ``bits`` set."""
    return [np.array([sum(1 << i for i in c) for c in combinations(range(bits), r)], np.uint64)
            for r in range(min(radius, bits) + 1)]


class Forest:
    """Groups of places, joined by links."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            while True:  # flatten
                up = self.root[self.root]
                if (up == self.root).all():
                    break
                self.root = up
            x, y = self.root[a], self.root[b]
            apart = x != y
            if not apart.any():
                return
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            np.minimum.at(self.root, np.maximum(x, y), np.minimum(x, y))


def collide(fps: np.ndarray, near: np.ndarray, bits: int, max_bits: int, forest: Forest, who: np.ndarray,
            hold: int = HOLD) -> None:
    """Link those of ``fps`` whose variants meet in a bucket. The bucket fixes
    all but the low ``bits`` bits, of which ``near`` already differ."""
    far = (max_bits + 1) // 2
    size = [sum(math.comb(bits, r) for r in range(left + 1)) for left in range(far + 1)]
    count = np.bincount(far - near, minlength=far + 1)
    if len(fps) < 2:
        return
    if sum(int(c) * s for c, s in zip(count, size, strict=True)) > hold and bits > 0:
        bit = np.uint64(1 << (bits - 1))
        for value in (False, True):  # the half of the bucket where the next bit is ``value``
            more = near + (((fps & bit) != 0) != value)
            inside = more <= far
            collide(fps[inside], more[inside], bits - 1, max_bits, forest, who[inside], hold)
        return
    low = np.uint64((1 << bits) - 1)
    kinds = masks(bits, far)
    variants, owners, distance = [], [], []
    for d in range(far + 1):
        own = np.flatnonzero(near == d)
        for r in range(far - d + 1):
            if len(own) and r < len(kinds):
                variants.append(((fps[own, None] & low) ^ kinds[r]).ravel())
                owners.append(np.repeat(own, len(kinds[r])))
                distance.append(np.full(len(own) * len(kinds[r]), d + r, np.int8))
    words = np.concatenate(variants)
    ordered = np.sort(words)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return
    hit = np.searchsorted(twice, words)
    hit[hit == len(twice)] = 0
    met = np.flatnonzero(twice[hit] == words)
    group, member, away = hit[met], np.concatenate(owners)[met], np.concatenate(distance)[met]
    by = np.lexsort((away, group))  # the nearest member of each variant first
    group, member, away = group[by], member[by], away[by]
    first = np.concatenate([[True], group[1:] != group[:-1]])
    centre = np.maximum.accumulate(np.where(first, np.arange(len(group)), 0))
    ok = ~first & (away[centre] <= max_bits // 2)
    a, b = member[centre[ok]], member[ok]
    ok = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
    forest.join(who[a[ok]], who[b[ok]])


def links(fps: DataFrame, max_bits: int = MAX_BITS, hold: int = HOLD) -> DataFrame:
    """(a, b): links whose components are those of all pairs of ``fps`` (fp
    long, distinct and stable) at ``max_bits`` or fewer differing bits."""
    far = (max_bits + 1) // 2
    ball = sum(math.comb(BITS, r) for r in range(far + 1))
    n = fps.count()
    lead = min(20, max(8, math.ceil(math.log2(max(1, n * ball / hold)))))
    rest = BITS - lead
    steps = [int(m) for kind in masks(lead, far) for m in kind]
    bucket = F.shiftrightunsigned("fp", rest).cast("int")
    sent = fps.select("fp", bucket.alias("own")).select(
        "fp", F.explode(F.array(*[F.col("own").bitwiseXOR(F.lit(m)) for m in steps])).alias("bucket"))

    def meet(table: pa.Table) -> pa.Table:
        f = table.column("fp").to_numpy().view(np.uint64)
        at = np.uint64(table.column("bucket")[0].as_py())
        near = np.bitwise_count((f >> np.uint64(rest)) ^ at).astype(np.int64)
        forest = Forest(len(f))
        collide(f, near, rest, max_bits, forest, np.arange(len(f)), hold)
        joined = np.flatnonzero(forest.root != np.arange(len(f)))
        return pa.table({"a": f[joined].view(np.int64), "b": f[forest.root[joined]].view(np.int64)})

    return sent.groupBy("bucket").applyInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS,
                    keep: list[Column] | None = None) -> DataFrame:
    """The given columns (default and at least: doc_id), ``fp``,
    ``component_id`` and ``label`` (a fingerprint that names the component) of
    every row."""
    ensure_checkpoint_dir(docs.sparkSession)
    rows = fingerprints(docs, shingle, keep).checkpoint()
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first")).checkpoint()
    labels = connected_components(links(distinct.select("fp"), max_bits))
    labelled = (distinct.join(labels, distinct["fp"] == labels["node"], "left")
                .select("fp", "first", F.coalesce("label", "fp").alias("label")))
    smallest = labelled.groupBy("label").agg(F.min("first").alias("component_id"))
    return rows.join(labelled.join(smallest, "label").select("fp", "component_id", "label"), "fp")
