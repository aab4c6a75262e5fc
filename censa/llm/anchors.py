"""Finding what repeats in a corpus from a thin set of anchored places.

Of every ``span`` places in a row the one with the smallest hash is an
anchor. Equal stretches have the same anchor, so a stretch can only repeat if
its anchor's hash does, and about two in ``span`` places are anchors.

Rows have a number (``rid``), given in the order of the input, and belong to a
slot, a hash of the number. ``deal`` sends hashes to parts, packed as arrays;
``repeated`` finds in each part the places whose hash comes up again and sends
them, packed again, to their rows' slots; there a cogroup brings them together
with the texts. Within a slot a row may go by its rank instead: a negative
number that holds slot and rank. The input must be stable (files, a table or a
checkpoint): row numbers are taken more than once.

Arrays travel as byte planes (all first bytes, then all second bytes, ...), so
the high bytes of small numbers compress to nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

U64 = np.uint64

DEALT = "part int, first long, hashes binary, more binary, rows binary, places binary, known binary"
FOUND = "slot int, rids binary, places binary"
DEALT_NAMES = [c.split()[0] for c in DEALT.split(", ")]

#: Text bytes whose anchors are dealt together.
DEAL_BYTES = 8 << 20
#: Rows whose anchors are dealt together (numbers of two bytes).
DEAL_ROWS = 1 << 16
#: Text bytes of a slot, about.
SLOT_BYTES = 64 << 20


def planes(a: np.ndarray, width: int | None = None) -> bytes:
    """The numbers' bytes, lowest first, plane by plane."""
    return np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize)[:, :width].T).tobytes()


def from_planes(raw: bytes, n: int, kind) -> np.ndarray:
    width = len(raw) // n if n else 0
    out = np.zeros((n, np.dtype(kind).itemsize), np.uint8)
    out[:, :width] = np.frombuffer(raw, np.uint8).reshape(width, n).T if n else 0
    return out.reshape(-1).view(kind)


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of 64-bit hashes (wraps around)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h ^= h >> U64(33)
    h *= U64(0xC4CEB9FE1A85EC53)
    h ^= h >> U64(33)
    return h


def sliding_min(a: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` values in a row, by doubling."""
    reach = 1
    while 2 * reach <= width:
        a = np.minimum(a[:len(a) - reach], a[reach:])
        reach *= 2
    if width > reach:
        a = np.minimum(a[:len(a) - (width - reach)], a[width - reach:])
    return a


def anchor_flags(h: np.ndarray, valid: np.ndarray, span: int) -> np.ndarray:
    """True where ``h`` (at least 1) is the minimum of some stretch of
    ``span`` values that starts at a valid place; ties all count."""
    n = len(h)
    if n < span:
        return np.zeros(n, bool)
    least = sliding_min(h, span)
    # a place is an anchor if the largest minimum of the stretches over it is its own hash
    over = np.zeros(n + span - 1, U64)
    over[span - 1:span - 1 + len(least)] = np.where(valid[:len(least)], least, U64(0))
    return ~sliding_min(~over, span)[:n] == h


def numbered(docs: DataFrame, slots: int) -> DataFrame:
    """rid, doc_id, text and slot of every row."""
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text")
    return rows.withColumn("slot", F.pmod(F.xxhash64("rid"), F.lit(slots)).cast("int"))


def text_bytes(docs: DataFrame) -> int:
    """About the bytes of all texts: files by their size (known from their
    listing, taken as compressed four times), any other input by a scan."""
    leaves = docs.select("text")._jdf.queryExecution().optimizedPlan().collectLeaves()
    leaves = [leaves.apply(i) for i in range(leaves.size())]
    if all(leaf.getClass().getSimpleName() == "LogicalRelation" for leaf in leaves):
        return 4 * sum(int(str(leaf.stats().sizeInBytes())) for leaf in leaves)
    return docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0


def slot_count(docs: DataFrame) -> int:
    """Slots, and parts: as many as shuffle partitions, and at least one for
    SLOT_BYTES of text, as a task takes a slot's texts at once. Every part sends
    every slot one packed row, so more would only make more and smaller rows."""
    return max(16, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-text_bytes(docs) // SLOT_BYTES))


def groups_of(batch: pa.RecordBatch, text: str = "text"):
    """Slices of a batch to be dealt together."""
    for piece in pieces(batch, text, DEAL_BYTES):
        for at in range(0, piece.num_rows, DEAL_ROWS):
            yield piece.slice(at, DEAL_ROWS)


def deal(first: int, row: np.ndarray, place: np.ndarray, hashes: np.ndarray, more: np.ndarray | None,
         parts: int, slot_of: np.ndarray, apart: bool, width: int = 8):
    """Record batches of ``DEALT`` for anchors (ordered by row and place) of
    rows numbered ``first + row`` (row below DEAL_ROWS, ``slot_of`` by row),
    with ``width`` bytes of their hashes. What repeats among them (``apart``: in another
    row) is known at once: one entry of such a hash goes to its part, and the
    other places go straight on, so a very common hash is no hot group."""
    if not len(row):
        return
    order = np.lexsort((hashes, more)) if more is not None else np.argsort(hashes, kind="stable")
    h = hashes[order]
    new = np.ones(len(h), bool)
    new[1:] = h[1:] != h[:-1]
    if more is not None:
        new[1:] |= more[order][1:] != more[order][:-1]
    start = np.flatnonzero(new)
    size = np.diff(np.append(start, len(h)))
    if apart:
        r = row[order]
        several = np.minimum.reduceat(r, start) != np.maximum.reduceat(r, start)
    else:
        several = size > 1
    known, lead = np.empty(len(h), bool), np.empty(len(h), bool)
    known[order], lead[order] = np.repeat(several, size), new
    send = np.flatnonzero(~known | lead)
    rest = np.flatnonzero(known & ~lead)
    out: dict[str, list] = {n: [] for n in DEALT_NAMES}

    def put(which: np.ndarray, part: np.ndarray, with_hash: bool) -> None:
        by = np.argsort(part, kind="stable")
        which, part = which[by], part[by]
        bounds = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1], [True]])) if len(part) else []
        for a, b in zip(bounds[:-1], bounds[1:], strict=True):
            own = which[a:b]
            out["part"].append(int(part[a]))
            out["first"].append(int(first))
            out["hashes"].append(planes(hashes[own], width) if with_hash else b"")
            out["more"].append(more[own].tobytes() if with_hash and more is not None else b"")
            out["rows"].append(planes(np.diff(row[own], prepend=0).astype(np.uint16)))
            out["places"].append(planes(place[own].astype(np.uint32)))
            out["known"].append(known[own].tobytes() if with_hash else b"")

    home = (mix(hashes) % U64(parts)).astype(np.int64)
    put(send, home[send], True)
    put(rest, slot_of[row[rest]].astype(np.int64), False)
    kinds = {"part": pa.int32(), "first": pa.int64()}
    yield pa.RecordBatch.from_arrays([pa.array(v, kinds.get(k, pa.binary())) for k, v in out.items()], DEALT_NAMES)


def entries(table: pa.Table, which: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and places of the given rows of a ``DEALT`` table."""
    if not which:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    first = table.column("first").to_numpy()
    rows, places = [], []
    for k in which:
        raw = table.column("places")[k].as_py()
        n = len(raw) // 4
        places.append(from_planes(raw, n, np.uint32).astype(np.int64))
        rows.append(first[k] + np.cumsum(from_planes(table.column("rows")[k].as_py(), n, np.uint16), dtype=np.int64))
    return np.concatenate(rows), np.concatenate(places)


def to_slots(rid: np.ndarray, place: np.ndarray, slots: int) -> pa.Table:
    """A ``FOUND`` table; within a slot, ordered by row and place."""
    slot = np.where(rid < 0, -(rid >> 32) - 1, slot_numbers(rid, slots))
    order = np.lexsort((place, rid, slot))
    rid, place, slot = rid[order], place[order], slot[order]
    bounds = np.flatnonzero(np.concatenate([[True], slot[1:] != slot[:-1], [True]])) if len(slot) else np.zeros(1, int)
    cut = list(zip(bounds[:-1], bounds[1:], strict=True))
    return pa.table({"slot": pa.array([int(slot[a]) for a, _ in cut], pa.int32()),
                     "rids": pa.array([planes(np.diff(rid[a:b], prepend=0)) for a, b in cut], pa.binary()),
                     "places": pa.array([planes(place[a:b].astype(np.uint32)) for a, b in cut], pa.binary())})


def slot_numbers(rid: np.ndarray, slots: int) -> np.ndarray:
    """Spark's ``pmod(xxhash64(rid), slots)`` (XXH64 of eight bytes, seed 42)."""
    p1, p2, p3, p4, p5 = (U64(x) for x in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                           0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))
    def turn(x, r):
        return (x << U64(r)) | (x >> U64(64 - r))
    with np.errstate(over="ignore"):
        h = np.full(len(rid), U64(42) + p5 + U64(8))
        h ^= turn(rid.astype(np.int64).view(U64) * p2, 31) * p1
        h = turn(h, 27) * p1 + p4
        h ^= h >> U64(33)
        h *= p2
        h ^= h >> U64(29)
        h *= p3
        h ^= h >> U64(32)
    return (h.view(np.int64) % slots).astype(np.int32)


def repeated(dealt: DataFrame, slots: int, apart: bool) -> DataFrame:
    """(slot, rids, places): the places in ``dealt`` whose hash comes up again
    (``apart``: in another row)."""
    def find(table: pa.Table) -> pa.Table:
        has = [len(p) // 4 if h else 0 for h, p in zip(table.column("hashes").to_pylist(), table.column("places").to_pylist(), strict=True)]
        done = [k for k, n in enumerate(has) if not n]
        asked = [k for k, n in enumerate(has) if n]
        rid, place = entries(table, done)
        if asked:
            h = np.concatenate([from_planes(table.column("hashes")[k].as_py(), has[k], U64) for k in asked])
            extra = [np.frombuffer(table.column("more")[k].as_py(), U64) for k in asked]
            m = np.concatenate(extra)
            known = np.concatenate([np.frombuffer(table.column("known")[k].as_py(), bool) for k in asked])
            r, p = entries(table, asked)
            order = np.lexsort((h, m)) if len(m) else np.argsort(h, kind="stable")
            h, r, p, known = h[order], r[order], p[order], known[order]
            new = np.ones(len(h), bool)
            new[1:] = h[1:] != h[:-1]
            if len(m):
                new[1:] |= m[order][1:] != m[order][:-1]
            start = np.flatnonzero(new)
            size = np.diff(np.append(start, len(h)))
            again = np.minimum.reduceat(r, start) != np.maximum.reduceat(r, start) if apart else size > 1
            hit = np.repeat(again | np.logical_or.reduceat(known, start), size)
            rid, place = np.concatenate([rid, r[hit]]), np.concatenate([place, p[hit]])
        return to_slots(rid, place, slots)

    return dealt.groupBy("part").applyInArrow(find, FOUND)


def rank_number(slot: int, rank: int = 0) -> int:
    """Number of a slot's row by its rank among the slot's row numbers."""
    return -((slot + 1) << 32) + rank


def matched(texts: pa.Table, found: pa.Table, every: bool = False):
    """A slot's texts with the places found in them: (ranks, batch, row,
    place) by pieces of a few MB; row counts within the batch, and (row,
    place) pairs are distinct and sorted. Rows without a place are left out
    unless ``every``."""
    rids = texts.column("rid").to_numpy()
    by = np.argsort(rids, kind="stable")
    row = place = np.zeros(0, np.int64)
    if found.num_rows:
        places = [(raw, len(raw) // 4) for raw in found.column("places").to_pylist()]
        place = np.concatenate([from_planes(raw, n, np.uint32) for raw, n in places]).astype(np.int64)
        rid = np.concatenate([np.cumsum(from_planes(raw, n, np.int64)) for raw, (_, n) in
                              zip(found.column("rids").to_pylist(), places, strict=True)])
        row = np.where(rid < 0, rid & 0xFFFFFFFF, np.searchsorted(rids[by], rid))
        order = np.lexsort((place, row))
        row, place = row[order], place[order]
        once = np.ones(len(row), bool)
        once[1:] = (row[1:] != row[:-1]) | (place[1:] != place[:-1])
        row, place = row[once], place[once]
    used = np.arange(len(rids)) if every else np.unique(row)
    if not len(used):
        return
    some = texts.take(pa.array(by[used])).combine_chunks()
    local = np.searchsorted(used, row)
    at = 0
    for batch in some.to_batches():
        for piece in pieces(batch):
            a, b = np.searchsorted(local, [at, at + piece.num_rows])
            yield used[at:at + piece.num_rows], piece, local[a:b] - at, place[a:b]
            at += piece.num_rows


def deal_slot(slot: int, dealt: list[tuple], parts: int, apart: bool, width: int = 8) -> pa.Table:
    """``deal`` for (rank, place, hashes, more) of a slot's rows, rising ranks."""
    empty = pa.schema([("part", pa.int32()), ("first", pa.int64()), ("hashes", pa.binary()), ("more", pa.binary()),
                       ("rows", pa.binary()), ("places", pa.binary()), ("known", pa.binary())])
    if not dealt:
        return empty.empty_table()
    rank, place, hashes = (np.concatenate([d[k] for d in dealt]) for k in range(3))
    more = None if dealt[0][3] is None else np.concatenate([d[3] for d in dealt])
    out = []
    for at in range(0, int(rank.max(initial=0)) + 1, DEAL_ROWS):
        a, b = np.searchsorted(rank, [at, at + DEAL_ROWS])
        out += deal(rank_number(slot, at), rank[a:b] - at, place[a:b], hashes[a:b], None if more is None else more[a:b],
                    parts, np.full(DEAL_ROWS, slot), apart, width)
    return pa.Table.from_batches(out, empty)
