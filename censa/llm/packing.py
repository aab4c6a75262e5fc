"""Packing into fixed-length sequences by cutting-stock column generation
(operator 4).

Each document's ids, with one end id, are cut into pieces of ``capacity`` ids
and a remainder. Piece lengths are counted in classes of ``grain`` ids; that
histogram (capacity / grain rows) is all the driver gets. There a linear
program over packing patterns is solved by column generation: a knapsack
dynamic program prices new patterns by the duals until none pays. The patterns
are rounded down, and what is left is filled greedily. Each piece then takes
the slot that its rank within its class points at, so documents never leave
the executors. Ranks are counted in ``salts`` parts of each class, so a length
that a third of all pieces share is not ranked in one task.

Edge rules: a null or empty text is the end id alone; ranks order by id, then
contents, and rows that agree in everything are interchangeable.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import binary_array, pieces, utf8
from .vocabulary import REMEMBER, json_ranks, unit_starts

CAPACITY = 1024
GRAIN = 4
SALTS = 64
END_ID = 0
TOLERANCE = 0.005


class UnitEncoder:
    """Ids of units of text (see ``unit_starts``), remembered by unit. The
    tokenizers library is used for texts that spell out a special token,
    which it cuts out first; for all others the ranks give the same ids."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken
        import tokenizers
        self.encoding = tiktoken.Encoding("units", pat_str=public_tokenizers.PATTERN,
                                          mergeable_ranks=json_ranks(path), special_tokens={})
        self.whole = tokenizers.Tokenizer.from_file(path)
        self.special = [t.content.encode() for t in self.whole.get_added_tokens_decoder().values()]
        self.forget()

    def forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids: list[list[int]] = []

    def rows(self, data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All rows' ids in turn, each row followed by the end id, and the
        n + 1 offsets of the rows."""
        starts = unit_starts(data, off)
        units = binary_array(data, np.diff(np.append(starts, len(data)))).dictionary_encode()
        if len(self.known) > REMEMBER:
            self.forget()
        number = np.empty(len(units.dictionary), np.int64)
        known, ids, encode = self.known, self.ids, self.encoding.encode_ordinary
        for k, unit in enumerate(units.dictionary.to_pylist()):
            i = known.get(unit)
            if i is None:
                i = known[unit] = len(ids)
                ids.append(encode(unit.decode("utf-8", "replace")))
            number[k] = i
        chosen = [ids[i] for i in number.tolist()]
        size = np.fromiter(map(len, chosen), np.int64, len(chosen))
        flat = np.fromiter((x for c in chosen for x in c), np.uint32, int(size.sum()))
        begin = np.cumsum(size) - size
        which = units.indices.to_numpy()
        length = size[which]
        out_begin = np.cumsum(length) - length
        total = int(length.sum())
        stream = flat[np.repeat(begin[which] - out_begin, length) + np.arange(total)]
        row = np.searchsorted(off, starts, "right") - 1
        per_row = np.bincount(row, weights=length, minlength=len(off) - 1).astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(per_row + 1)])
        out = np.full(total + len(off) - 1, END_ID, np.uint32)
        out[np.arange(total) + np.repeat(np.arange(len(off) - 1), per_row)] = stream
        return out, bounds


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens of every piece."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        encoder = UnitEncoder(tokenizer)
        for whole in batches:
            for b in pieces(whole):
                data, off = utf8(b.column("text"))
                ids, bounds = encoder.rows(data, off)
                odd = {}
                raw = data.tobytes()
                if any(s in raw for s in encoder.special):
                    for r in range(b.num_rows):
                        text = raw[off[r]:off[r + 1]]
                        if any(s in text for s in encoder.special):
                            odd[r] = np.array(encoder.whole.encode(text.decode("utf-8", "replace"), add_special_tokens=False).ids
                                              + [END_ID], np.uint32)
                row, start, length, crc, tokens = [], [], [], [], []
                view = memoryview(ids.astype("<u4").tobytes())
                for r in range(b.num_rows):
                    a, z = int(bounds[r]), int(bounds[r + 1])
                    own = view[4 * a:4 * z]
                    if r in odd:
                        own = memoryview(odd[r].astype("<u4").tobytes())
                    n = len(own) // 4
                    for s in range(0, n, capacity):
                        part = own[4 * s:4 * (s + capacity)]
                        row.append(r)
                        start.append(s)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                        tokens.append(n)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(row, pa.int64())),
                     *(pa.array(x, pa.int64()) for x in (start, length, crc, tokens))],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long")


def best_pattern(price: np.ndarray, size: np.ndarray, capacity: int) -> tuple[float, np.ndarray]:
    """Unbounded knapsack by dynamic programming: the pattern (count of each
    class) of the highest total price that fits."""
    value = np.zeros(capacity + 1)
    choice = np.full(capacity + 1, -1)
    for w, k in enumerate(np.searchsorted(size, np.arange(capacity + 1), "right").tolist()):
        if k:  # the k classes that fit
            got = value[w - size[:k]] + price[:k]
            best = got.argmax()
            if got[best] > value[w - 1] + 1e-12:
                value[w], choice[w] = got[best], best
                continue
        if w:
            value[w] = value[w - 1]
    pattern = np.zeros(len(size), np.int64)
    w = capacity
    while w > 0:
        if choice[w] < 0:
            w -= 1
        else:
            pattern[choice[w]] += 1
            w -= int(size[choice[w]])
    return float(value[capacity]), pattern


def generate_columns(size: np.ndarray, demand: np.ndarray, capacity: int, rounds: int = 4000) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (columns) and their fractional numbers that meet ``demand``:
    revised simplex on the patterns so far, one new pattern a round. The best
    new pattern's worth bounds the optimum from below (at least the present
    number of sequences divided by it), so it ends within TOLERANCE of it, or
    after ``rounds``."""
    single = capacity // size
    patterns, inverse = np.diag(single).astype(float), np.diag(1.0 / single)
    place = {int(c): i for i, c in enumerate(size)}
    for i, c in enumerate(size.tolist()):  # a start: classes that fill a sequence together are paired
        j = place.get(capacity - c)
        if j is not None and i < j:
            rare, other = (i, j) if demand[i] <= demand[j] else (j, i)
            patterns[[i, j], rare] = 1
            inverse[rare, rare] = 1
            inverse[other, rare] = -inverse[other, other]
            patterns[rare, rare] = 1
    amount = np.maximum((inverse * demand).sum(axis=1), 0)
    for k in range(rounds):
        price = inverse.sum(axis=0)
        worth, pattern = best_pattern(price, size, capacity)
        if worth <= 1 + TOLERANCE:
            break
        used = np.flatnonzero(pattern)
        change = (inverse[:, used] * pattern[used]).sum(axis=1)
        able = np.flatnonzero(change > 1e-9)
        out = able[np.argmin(amount[able] / change[able])]
        step = amount[out] / change[out]
        amount = amount - step * change
        amount[out] = step
        np.maximum(amount, 0, out=amount)
        patterns[:, out] = pattern
        row = inverse[out] / change[out]
        inverse -= change[:, None] * row
        inverse[out] = row
        if k % 50 == 49:  # fresh figures against rounding drift
            amount = np.maximum((inverse * demand).sum(axis=1), 0)
    return np.rint(patterns).astype(np.int64), amount


def plan(size: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[dict[int, int], int]]:
    """(pattern, number of sequences): the columns rounded down, then greedy
    patterns for what is left, largest class first."""
    if not len(size):
        return []
    # uneven crumbs on the demand keep the simplex from circling among ties; rounding takes them off
    crumbs = 0.01 * (np.arange(len(size)) * 0.618034 % 1)
    patterns, amount = generate_columns(size, demand + crumbs, capacity)
    left = demand.astype(np.int64).copy()
    out: dict[tuple, int] = {}
    for j in np.argsort(-amount, kind="stable"):
        used = np.flatnonzero(patterns[:, j])
        times = min(int(amount[j] + 0.02), *(int(left[i] // patterns[i, j]) for i in used))
        if times > 0:
            key = tuple((int(size[i]), int(patterns[i, j])) for i in used)
            out[key] = out.get(key, 0) + times
            left[used] -= times * patterns[used, j]
    by = np.argsort(-size, kind="stable")
    while left.any():
        room, used = capacity, []
        for i in by:
            m = min(int(left[i]), room // int(size[i]))
            if m:
                used.append((i, m))
                room -= m * int(size[i])
        times = min(int(left[i] // m) for i, m in used)
        for i, m in used:
            left[i] -= times * m
        key = tuple(sorted((int(size[i]), m) for i, m in used))
        out[key] = out.get(key, 0) + times
    return [(dict(k), v) for k, v in out.items()]


def assign(parts: DataFrame, capacity: int = CAPACITY, grain: int = GRAIN, salts: int = SALTS) -> DataFrame:
    """``parts`` with sequence_id and offset. ``parts`` must be stable (a
    checkpoint or table), since it is read for the histogram and again for
    the ranks."""
    spark = parts.sparkSession
    cls = F.ceil(F.col("length") / grain).cast("int")
    salt = F.pmod(F.xxhash64("doc_id", "start"), F.lit(salts)).cast("int")
    ranked = parts.withColumns({"_cls": cls, "_salt": salt})
    counts = ranked.groupBy("_cls", "_salt").agg(F.count(F.lit(1)).alias("n")).collect()  # classes x salts rows at most
    table = np.zeros((capacity // grain + 2, salts), np.int64)
    for r in counts:
        table[r["_cls"], r["_salt"]] = r["n"]
    demand = table.sum(axis=1)
    size = np.flatnonzero(demand)
    before = np.cumsum(table, axis=1) - table
    slots, sequences = [], 0
    taken = dict.fromkeys(size.tolist(), 0)
    for pattern, times in plan(size, demand[size], capacity // grain):
        for c, m in pattern.items():
            slots.append((c, taken[c], taken[c] + m * times, m, sequences))
            taken[c] += m * times
        sequences += times
    assert all(taken[c] == demand[c] for c in taken)
    by_class = [(int(c), [(lo, hi, m, base) for k, lo, hi, m, base in slots if k == c]) for c in size.tolist()]
    slot_table = spark.createDataFrame(by_class or [(0, [])], "_cls int, _slots array<struct<lo:long,hi:long,m:long,base:long>>")
    offsets = spark.createDataFrame([(int(c), s, int(before[c, s])) for c in size.tolist() for s in range(salts) if table[c, s]]
                                    or [(0, 0, 0)], "_cls int, _salt int, _before long")
    order = Window.partitionBy("_cls", "_salt").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")
    placed = (ranked.withColumn("_rank", F.row_number().over(order) - 1)
              .join(F.broadcast(offsets), ["_cls", "_salt"])   # classes x salts rows
              .join(F.broadcast(slot_table), "_cls")           # one row a class
              .withColumn("_rank", F.col("_rank") + F.col("_before"))
              .withColumn("_slot", F.element_at(F.filter("_slots", lambda s: (s["lo"] <= F.col("_rank")) & (F.col("_rank") < s["hi"])), 1))
              .withColumn("_nth", F.col("_rank") - F.col("_slot.lo"))
              .withColumn("sequence_id", F.col("_slot.base") + F.floor(F.col("_nth") / F.col("_slot.m")))
              .withColumn("_nth", F.col("_nth") % F.col("_slot.m")))
    ahead = (Window.partitionBy("sequence_id").orderBy(F.desc("_cls"), "_nth")
             .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id",
                         (F.sum("length").over(ahead) - F.col("length")).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = GRAIN, salts: int = SALTS) -> DataFrame:
    """Pieces of all documents with their places in the sequences."""
    ensure_checkpoint_dir(docs.sparkSession)
    return assign(token_pieces(docs, tokenizer, capacity).checkpoint(), capacity, grain, salts)
