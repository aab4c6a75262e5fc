"""Filter interaction audit (operator 12).

What each of several filters removes depends on the filters before it. For
every part of a corpus and every order of the filters this reports, step by
step, what stays, what goes, what an earlier filter had removed already, which
labelled documents are lost, and over all orders each filter's Shapley total.

Method: a document is a failure mask, one bit a filter, and a part is a table
of masks with their counts (documents, good ones, toxic ones). From it a
decision diagram is built: one level a filter, a node for every different
sub-table (equal ones are shared), weighted with the counts below it. All
orders are visited by swapping adjacent levels, each order one swap from the
one before. An order's all-pass path, read from the root, yields its steps: the
fail child's weight is what the step removes, the pass child's what it keeps.

On Spark: one scan turns texts into masks and digests (``mapInArrow``). A text
is a repeat if a smaller id has the same one: the least id of each text is a
grouped minimum, combined on the map side, and meets the documents by id, so
a text that a third of all documents share is no hot group; labels meet them
the same way. Masks are counted by part (2 ** filters rows a part), and each
part's diagram is one small task.

Filters (failure conditions): A, under MIN_WORDS words; B, under MIN_DISTINCT
percent distinct words; C, over MAX_UPPER percent capitals A-Z; D, a character
of SYMBOLS; E, the text of a smaller id.

Edge rules: null text is empty (fails A only, and E if it repeats), null part
is ''. Equal ids are not smaller than each other; a null id is neither smaller
than another nor larger, and has no labels. Texts are equal if their SHA-256
are. A document is good (toxic) if any of its label rows says so. Repeated rows
count each. A part without documents does not occur; an empty table gives no
rows. Columns other than those named are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import pieces

FILTERS = "ABCDE"
MIN_WORDS = 100
MIN_DISTINCT = 80
MAX_UPPER = 10
SYMBOLS = re.compile(rb"[#$%&*|]")
SPACE = re.compile(rb"[\x20\x09-\x0D]")
UPPER = bytes(range(0x41, 0x5B))
#: Bytes of a long text that are cut into words at a time.
SLICE = 1 << 20

Weight = tuple[int, int, int]


def text_mask(text: bytes) -> int:
    """Bits of the filters A to D that the text fails."""
    words, distinct, at = 0, set(), 0
    while at < len(text):  # slices end between words
        end = SPACE.search(text, min(at + SLICE, len(text)))
        to = end.start() if end else len(text)
        some = text[at:to].split()  # bytes.split() parts at \x20 and \x09 to \x0D
        words += len(some)
        distinct.update(some)
        at = to + 1
    points = len(text) - int(np.count_nonzero((np.frombuffer(text, np.uint8) & 0xC0) == 0x80))
    upper = len(text) - len(text.translate(None, UPPER))
    failed = (words < MIN_WORDS, 100 * len(distinct) < MIN_DISTINCT * words, 100 * upper > MAX_UPPER * points,
              SYMBOLS.search(text) is not None)
    return sum(f << k for k, f in enumerate(failed))


def text_features(docs: DataFrame, part: str = "lang") -> DataFrame:
    """(doc_id, part, mask, digest) of every row; the mask has A to D."""
    def features(batches):
        for whole in batches:
            for b in pieces(whole):
                texts = b.column("text").cast(pa.large_binary()).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("part"), pa.array([text_mask(t) for t in texts], pa.int32()),
                     pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                    ["doc_id", "part", "mask", "digest"])

    plain = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col(part), F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).alias("text"))
    return plain.mapInArrow(features, "doc_id long, part string, mask int, digest binary")


def mask_counts(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """(part, mask, n, good, toxic) over all rows of ``docs`` (doc_id, text,
    ``part``) with ``labels`` (doc_id, quality, toxic)."""
    ensure_checkpoint_dir(docs.sparkSession)
    # repeated rows are one from here on, so no id is a hot key
    rows = text_features(docs, part).groupBy("doc_id", "part", "mask", "digest").agg(F.count("*").alias("n")).checkpoint()
    least = (rows.where("doc_id is not null").groupBy(F.col("digest").alias("l_digest"))
             .agg(F.min("doc_id").alias("l_id")).withColumn("first", F.lit(True)))
    flags = (labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("f_id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).cast("int").alias("good"),
                  F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).cast("int").alias("toxic")))
    named = (rows.where("doc_id is not null")
             .join(least, (F.col("doc_id") == F.col("l_id")) & (F.col("digest") == F.col("l_digest")), "left")
             .join(flags, F.col("doc_id") == F.col("f_id"), "left")
             .select("part", "n", (F.col("mask") + F.when(F.col("first"), 0).otherwise(1 << 4)).alias("mask"),
                     F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic")))
    unnamed = rows.where("doc_id is null").select("part", "n", "mask", F.lit(0).alias("good"), F.lit(0).alias("toxic"))
    return (named.unionByName(unnamed).groupBy("part", "mask")
            .agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("good")).alias("good"),
                 F.sum(F.col("n") * F.col("toxic")).alias("toxic")))


class Diagram:
    """A count-weighted decision diagram over failure bits. Nodes are numbers;
    a node with children is (filter, pass child, fail child), a leaf a weight.
    Equal nodes are one, so equal sub-tables are kept and swapped once."""

    def __init__(self, masks: dict[int, Weight], filters: int):
        self.order = list(range(filters))
        self.nodes: list[tuple[int, int, int] | None] = []
        self.weights: list[Weight] = []
        self.numbers: dict[tuple, int] = {}
        self.root = self._build(masks, 0, 0)

    def _build(self, masks: dict[int, Weight], level: int, mask: int) -> int:
        if level == len(self.order):
            return self._leaf(masks.get(mask, (0, 0, 0)))
        return self._node(level, self._build(masks, level + 1, mask), self._build(masks, level + 1, mask | 1 << level))

    def _leaf(self, weight: Weight) -> int:
        return self._number(("leaf", weight), None, weight)

    def _node(self, name: int, passed: int, failed: int) -> int:
        weight = tuple(a + b for a, b in zip(self.weights[passed], self.weights[failed], strict=True))
        return self._number((name, passed, failed), (name, passed, failed), weight)

    def _number(self, key: tuple, node, weight: Weight) -> int:
        if key not in self.numbers:
            self.numbers[key] = len(self.nodes)
            self.nodes.append(node)
            self.weights.append(weight)
        return self.numbers[key]

    def swap(self, level: int) -> None:
        """Exchange the filters of ``level`` and the next one: nodes above keep
        their place, those of the two levels are made anew from their
        grandchildren, and everything below stays as it is."""
        done: dict[int, int] = {}

        def redo(node: int, depth: int) -> int:
            if node not in done:
                name, passed, failed = self.nodes[node]
                if depth < level:
                    done[node] = self._node(name, redo(passed, depth + 1), redo(failed, depth + 1))
                else:
                    (below, pp, pf), (_, fp, ff) = self.nodes[passed], self.nodes[failed]
                    done[node] = self._node(below, self._node(name, pp, fp), self._node(name, pf, ff))
            return done[node]

        self.root = redo(self.root, 0)
        self.order[level], self.order[level + 1] = self.order[level + 1], self.order[level]

    def steps(self) -> list[tuple[int, Weight, Weight]]:
        """(filter, kept, removed) along the all-pass path."""
        out, node = [], self.root
        for _ in self.order:
            name, passed, failed = self.nodes[node]
            out.append((name, self.weights[passed], self.weights[failed]))
            node = passed
        return out


def adjacent_swaps(n: int) -> Iterator[int]:
    """Places of the adjacent swaps that lead through all n! orders (plain
    changes: the last item walks through every order of the others)."""
    if n < 2:
        return
    down = True
    inner = adjacent_swaps(n - 1)
    while True:
        yield from range(n - 2, -1, -1) if down else range(n - 1)
        step = next(inner, None)
        if step is None:
            return
        yield step + down  # the walker stands in front of the others, or behind them
        down = not down


def order_steps(masks: dict[int, Weight], filters: str = FILTERS) -> list[tuple]:
    """(order, step, kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley) for every order of the filters."""
    k = len(filters)
    fails = [sum(w[0] for m, w in masks.items() if m >> f & 1) for f in range(k)]
    alone = [masks.get(1 << f, (0, 0, 0))[0] for f in range(k)]
    diagram = Diagram(masks, k)
    paths = [(list(diagram.order), diagram.steps())]
    for place in adjacent_swaps(k):
        diagram.swap(place)
        paths.append((list(diagram.order), diagram.steps()))
    shapley = [0] * k
    for _, steps in paths:
        for f, _, removed in steps:
            shapley[f] += removed[0]
    return [("".join(filters[f] for f in order), at, kept[0], removed[0], fails[f] - removed[0], alone[f],
             removed[1], removed[2], shapley[f])
            for order, steps in paths for at, (f, kept, removed) in enumerate(steps, 1)]


NAMES = ["filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


def audit(docs: DataFrame, labels: DataFrame, part: str = "lang") -> DataFrame:
    """One row per part, order and step, zeros included."""
    def walk(key, table):
        masks = {r["mask"]: (r["n"], r["good"], r["toxic"]) for r in table.to_pylist()}
        columns = list(zip(*order_steps(masks), strict=True))
        kinds = [pa.string(), pa.int32()] + [pa.int64()] * 7
        return pa.table({"part": pa.array([key[0].as_py()] * len(columns[0]), pa.string()),
                         **{n: pa.array(c, t) for n, c, t in zip(NAMES, columns, kinds, strict=True)}})

    schema = "part string, filter_order string, step int, " + ", ".join(f"{n} long" for n in NAMES[2:])
    return mask_counts(docs, labels, part).groupBy("part").applyInArrow(walk, schema)
