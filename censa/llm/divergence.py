"""Source divergence audit (operator 11).

Which sources of a language use words alike, and which words set a source
apart? A (lang, source) group gives each of the language's V kept terms (those
in at least MIN_DOCS of its documents) the smoothed share

    p = 1 + floor(SCALE * (count + SMOOTH) / (N + SMOOTH * V)),

N being the counts' sum over the kept terms. Two groups are compared by the sum
of |p - q| over all kept terms (part ``pair``), a group and its language by the
terms with p > q (part ``term``, the TOP of them).

Method: a share depends on the count alone, so a group is stored as count-level
bitmaps: for every count that occurs, the set of the terms that have it. Of two
groups, AND and popcount give the number of terms in each joint cell (count
here, count there), which is multiplied by the cell's |p - q|. Count zero is
the complement of a group's other sets among the kept terms.

On Spark: one scan counts terms and the documents that have them (each task
adds up its own before the shuffle). Term ids follow a range sort by the
language's count, so the 64 terms of a bitmap word have like counts and few
levels; ids number a stored table and need no task that sees a whole
vocabulary. Bitmaps lie as (lang, block of WORDS words, word, source, count,
bits). Blocks are compared independently, at most SOURCES x SOURCES sources at
a time, so a task's memory is bounded whatever the vocabulary and the number
of sources; its partial sums are added up by pair.

Edge rules: null text, lang and source count as ''. Every row is a document,
repeated rows count each. A group without kept terms has N = 0; a language
without kept terms has V = 0, value 0 for all its pairs, and no terms. A
language with one source has no pairs. An empty table gives no rows. Columns
other than text, lang and source are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.joins import lookup_join
from ..session import ensure_checkpoint_dir
from .common import pieces

MIN_DOCS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP = 50
#: Bitmap words (of 64 terms) that are compared in one go.
WORDS = 64
#: Sources on each side of a block's comparison.
SOURCES = 128
#: Counts that a task holds before it hands them over.
HELD = 400_000
#: Bytes of a long text that are cut into terms at a time.
SLICE = 1 << 20

TERM = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
BREAK = re.compile(rb"[\x00-\x40\x5B-\x60\x7B-\x7F]")
COUNTED = "lang string, source string, term string, n long, docs long"


def terms_of(text: bytes):
    """Lists of a text's terms, A-Z lower-cased, from slices that end between
    terms."""
    text, at = text.lower(), 0
    while at < len(text):
        end = BREAK.search(text, min(at + SLICE, len(text)))
        to = end.start() if end else len(text)
        yield TERM.findall(text[at:to])
        at = to + 1


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences of a term in a group and the
    documents that have it; a row with a null term for every group."""
    def count(batches):
        sums: dict[tuple, tuple[Counter, Counter]] = {}
        held = 0
        for whole in batches:
            for b in pieces(whole):
                for text, lang, source in zip(b.column("text").cast(pa.large_binary()).to_pylist(),
                                              b.column("lang").to_pylist(), b.column("source").to_pylist(), strict=True):
                    n, docs = sums.setdefault((lang, source), (Counter(), Counter()))
                    before, seen = len(n), set()
                    for terms in terms_of(text):
                        n.update(terms)
                        seen.update(terms)
                    docs.update(seen)
                    held += len(n) - before
                if held > HELD:
                    yield from handed(sums)
                    sums, held = {}, 0
        yield from handed(sums)

    def handed(sums):
        for (lang, source), (n, docs) in sums.items():
            terms = list(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(terms) + 1)), pa.array([source] * (len(terms) + 1)),
                 pa.array([*terms, None], pa.binary()).cast(pa.string()), pa.array([*(n[t] for t in terms), 0], pa.int64()),
                 pa.array([*(docs[t] for t in terms), 0], pa.int64())], ["lang", "source", "term", "n", "docs"])

    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("text", "lang", "source")])
    return (plain.mapInArrow(count, COUNTED).groupBy("lang", "source", "term")
            .agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


def share(count: Column, total: Column, kept: Column, smooth: int) -> Column:
    """p, exact in decimals of 38 digits (counts up to 10**28)."""
    wide = lambda c: c.cast("decimal(28,0)")
    return F.lit(1) + F.call_function("div", wide(count + smooth) * F.lit(SCALE).cast("decimal(10,0)"),
                                      wide(total + kept * F.lit(smooth)))


def block_of(word: Column) -> Column:
    return F.call_function("div", word, F.lit(WORDS))


def count_levels(counts: DataFrame) -> DataFrame:
    """The stored bitmaps: (lang, block, word, source, n, bits) from (lang,
    source, id, n)."""
    return (counts.groupBy("lang", F.shiftrightunsigned("id", 6).alias("word"), "source", "n")
            .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("id").bitwiseAND(63).cast("int"))).alias("bits"))
            .withColumn("block", block_of(F.col("word"))))


def joint_sums(table: pa.Table) -> pa.Table:
    """(source, item, value): the sum of |p - q| over the terms of one block's
    words, for every source of one side with every other of the other side,
    both ways. Rows without a word bring a source's share of count zero and, as
    bits, the number of the block's kept terms; the others are levels."""
    text = table.column("source").combine_chunks().dictionary_encode()
    names, source = text.dictionary, text.indices.to_numpy()
    no_word = table.column("word").is_null().to_numpy()
    side = table.column("side").to_numpy()
    bits, p = table.column("bits").to_numpy().view(np.uint64), table.column("p").to_numpy()
    p0 = np.zeros(len(names), np.int64)
    p0[source[no_word]] = p[no_word]
    left, right = (np.isin(np.arange(len(names)), source[no_word & (side != s)]) for s in (1, 0))
    a_of, b_of = np.flatnonzero(left), np.flatnonzero(right)
    rest = int(table.column("bits").to_numpy()[no_word][0])  # kept terms that no source here has
    sums = np.zeros((len(a_of), len(b_of)), np.int64)

    level = np.flatnonzero(~no_word)
    word = table.column("word").fill_null(-1).to_numpy()[level]
    order = np.argsort(word, kind="stable")
    level, word = level[order], word[order]
    for rows in np.split(level, np.flatnonzero(np.diff(word)) + 1):
        taken = np.zeros(len(names), np.uint64)
        np.bitwise_or.at(taken, source[rows], bits[rows])
        every = np.bitwise_or.reduce(taken)
        rest -= int(np.bitwise_count(every))
        s = np.concatenate([source[rows], np.arange(len(names))])
        b = np.concatenate([bits[rows], every & ~taken])  # count zero: the complement
        q = np.concatenate([p[rows], p0])
        order = np.argsort(s, kind="stable")
        s, b, q = s[order], b[order], q[order]
        bounds = np.searchsorted(s, np.arange(len(names) + 1))
        own = right[s]
        b_bits, b_share, first = b[own], q[own], np.flatnonzero(np.diff(s[own], prepend=-1))
        for n, k in enumerate(a_of):
            i, j = bounds[k], bounds[k + 1]
            cells = np.bitwise_count(b[i:j, None] & b_bits) * np.abs(q[i:j, None] - b_share)
            sums[n] += np.add.reduceat(cells.sum(axis=0), first)
    sums += rest * np.abs(p0[a_of, None] - p0[b_of])
    a, b = np.repeat(a_of, len(b_of)), np.tile(b_of, len(a_of))
    value, other = sums.ravel(), a != b
    if not np.array_equal(a_of, b_of):  # two sides: each pair came once
        a, b, value, other = np.append(a, b), np.append(b, a), np.tile(value, 2), np.tile(other, 2)
    return pa.table({"source": names.take(pa.array(a[other])), "item": names.take(pa.array(b[other])),
                     "value": pa.array(value[other], pa.int64())})


def pair_sums(levels: DataFrame, blocks: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of a language's
    sources, from bitmaps with shares, blocks (in_lang, block, kept terms) and
    the stored groups (lang, source, nth, sides, p0)."""
    group_of = ["lang", "block", "side_a", "side_b"]

    def compare(key, table):
        found = joint_sums(table)
        return found.add_column(0, "lang", pa.array([key[0].as_py()] * found.num_rows, pa.string()))

    def sided(rows: DataFrame) -> DataFrame:
        """A source's rows for every pair of sides that it is part of; ``side``
        is 0 on the left, 1 on the right, 2 where both are the same."""
        own = F.floor(F.col("nth") / SOURCES)
        pairs = F.transform(F.sequence(F.lit(0).cast("long"), F.col("sides") - 1), lambda k: F.struct(
            F.least(own, k).alias("side_a"), F.greatest(own, k).alias("side_b"),
            F.when(own == k, 2).when(own < k, 0).otherwise(1).alias("side")))
        return rows.select("lang", "block", "word", "source", "p", "bits", F.inline(pairs))

    zeros = (lookup_join(blocks, groups, [("in_lang", "lang")])
             .select("lang", "block", F.lit(None).cast("long").alias("word"), "source", F.col("p0").alias("p"),
                     F.col("terms").alias("bits"), "nth", "sides"))
    rows = levels.select("lang", "block", "word", "source", "p", "bits", "nth", "sides").unionByName(zeros)
    return (sided(rows).groupBy(*group_of).applyInArrow(compare, "lang string, source string, item string, value long")
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, smooth: int = SMOOTH, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank) as described above; ``rank``
    counts from 1 by falling value, then rising item (UTF-8)."""
    ensure_checkpoint_dir(docs.sparkSession)
    counted = term_counts(docs).checkpoint()
    # kept terms, numbered along a range sort: like counts lie together
    kept = (counted.where("term is not null").groupBy(F.col("lang").alias("k_lang"), F.col("term").alias("k_term"))
            .agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= min_docs)
            .drop("docs").checkpoint())
    kept = (kept.repartitionByRange("k_lang", "lang_n", "k_term").sortWithinPartitions("k_lang", "lang_n", "k_term")
            .withColumn("id", F.monotonically_increasing_id()).checkpoint())
    counts = (counted.join(kept, (F.col("lang") == F.col("k_lang")) & (F.col("term") == F.col("k_term")))
              .select("lang", "source", "term", "n", "lang_n", "id").checkpoint())

    sizes = kept.groupBy(F.col("k_lang").alias("s_lang")).agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = (counts.groupBy(F.col("lang").alias("t_lang"), F.col("source").alias("t_source")).agg(F.sum("n").alias("total")))
    groups = counted.where("term is null").select("lang", "source")
    groups = (groups.join(totals, (F.col("lang") == F.col("t_lang")) & (F.col("source") == F.col("t_source")), "left")
              .select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")).checkpoint())
    nth = Window.partitionBy("lang").orderBy("source")
    numbered = groups.withColumn("nth", (F.row_number().over(nth) - 1).cast("long"))
    sides = groups.groupBy(F.col("lang").alias("c_lang")).agg(F.ceil(F.count("*") / SOURCES).alias("sides"))
    groups = (numbered.join(sides, F.col("lang") == F.col("c_lang")).drop("c_lang")
              .join(sizes, F.col("lang") == F.col("s_lang"), "left").drop("s_lang")
              .withColumn("v", F.coalesce("v", F.lit(0))).withColumn("lang_total", F.coalesce("lang_total", F.lit(0)))
              .withColumn("p0", F.when(F.col("v") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("v"), smooth)))
              .checkpoint())

    of = groups.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), "total", "v", "lang_total", "nth", "sides")
    levels = lookup_join(count_levels(counts), of, [("lang", "g_lang"), ("source", "g_source")])
    levels = levels.withColumn("p", share(F.col("n"), F.col("total"), F.col("v"), smooth)).checkpoint()
    blocks = (kept.groupBy(F.col("k_lang").alias("in_lang"), block_of(F.shiftrightunsigned("id", 6)).alias("block"))
              .agg(F.count("*").alias("terms")))
    sums = pair_sums(levels, blocks, groups.where("v > 0").select("lang", "source", "nth", "sides", "p0"))

    one = groups.where("v = 0")
    none = (one.select("lang", "source").join(one.select("lang", F.col("source").alias("item")), "lang")
            .where("source <> item").select("lang", "source", "item", F.lit(0).cast("long").alias("value")))
    by = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    pairs = (sums.unionByName(none).withColumn("rank", F.row_number().over(by))
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank"))

    p = share(F.col("n"), F.col("total"), F.col("v"), smooth)
    q = share(F.col("lang_n"), F.col("lang_total"), F.col("v"), smooth)
    above = (lookup_join(counts, of, [("lang", "g_lang"), ("source", "g_source")])
             .select("lang", "source", F.col("term").alias("item"), (p - q).alias("value")).where("value > 0")
             .withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= top)
             .select("lang", "source", F.lit("term").alias("part"), "item", "value", "rank"))
    return pairs.unionByName(above)
