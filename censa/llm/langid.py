"""Language identification with hyperdimensional profiles (operator 8).

Every letter has a random vector of +1/-1. A trigram's vector is the
elementwise product (binding) of its letters' vectors, each shifted cyclically
(permuted) by its place; a text's vector is the sum (bundle) of its trigram
vectors, and a language's prototype the sum over its learning texts. A text
gets the language whose prototype has the largest cosine.

Bundles are sums, so the dot product of a text and a prototype is the sum of
the dot products of the text's trigrams with that prototype. Learning hence
needs only trigram counts by language (a grouped sum over all learning texts,
bounded by SYMBOLS ** 3 rows a language), and prediction looks up one number
per trigram and language: the exact cosine order, at any vector length.

Letters are folded to SYMBOLS classes: 0 is anything but a letter, then a-z,
then U+00DF to U+00FF, then all other letters spread over the rest by code
point. Case is ignored.

Edge rules: a null text or one without a letter gives ``und`` and score 0, as
does every text where nothing was learned. Texts with null language, or null
id, are not learned from; a null id is not held out. Equal cosines go to the
first language in code point order. Repeated rows count as often as they come.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pieces, prefix, utf8

SYMBOLS = 96
DIMENSIONS = 2048
SEED = 8


def symbol_table() -> np.ndarray:
    """Symbol of each code point of the basic plane; others use ``fold``."""
    out = np.zeros(0x10000, np.uint8)
    for cp in range(0x10000):
        c = chr(cp)
        if c.isalpha():
            low = ord(c.lower()[0])
            if 0x61 <= low <= 0x7A:
                out[cp] = low - 0x60
            elif 0xDF <= low <= 0xFF:
                out[cp] = 27 + low - 0xDF
            else:
                out[cp] = 60 + low % (SYMBOLS - 60)
    return out


_TABLE: list[np.ndarray] = []


def fold(points: np.ndarray) -> np.ndarray:
    if not _TABLE:
        _TABLE.append(symbol_table())
    table = _TABLE[0]
    high = np.flatnonzero(points > 0xFFFF)
    if not len(high):
        return table[points]
    out = table[np.where(points > 0xFFFF, 0, points)]
    distinct, where = np.unique(points[high], return_inverse=True)
    out[high] = np.array([60 + int(p) % (SYMBOLS - 60) if chr(p).isalpha() else 0 for p in distinct], np.uint8)[where]
    return out


def trigrams(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigram numbers of all rows in turn, the n + 1 offsets of each row's
    trigrams, and the letters in each row. Runs of other characters count as
    one boundary, and each text starts and ends with one."""
    data, off = utf8(batch.column("text"))
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = prefix((data & 0xC0) != 0x80)[off]  # code point offsets of the rows
    s = fold(points)
    n = len(at) - 1
    padded = np.zeros(len(s) + n + 1, np.uint8)  # a boundary before each text and after the last
    row = np.repeat(np.arange(n), np.diff(at))
    padded[np.arange(len(s)) + row + 1] = s
    marks = at + np.arange(n + 1)  # place of each row's boundary
    keep = padded != 0
    keep[1:] |= padded[:-1] != 0
    keep[marks] = True
    begin = prefix(keep)[marks]
    kept = padded[keep].astype(np.int32)
    if len(kept) < 3:
        return np.zeros(0, np.int32), np.zeros(n + 1, np.int64), np.zeros(n, np.int64)
    grams = (kept[:-2] * SYMBOLS + kept[1:-1]) * SYMBOLS + kept[2:]
    # a trigram belongs to the row of its middle symbol; the boundary between two texts is no middle
    middle = np.ones(len(grams), bool)
    middle[begin[1:-1] - 1] = False
    count = prefix(middle)
    first = np.minimum(begin, len(grams))  # the trigram after a row's boundary has its first symbol in the middle
    bounds = count[first]
    return grams[middle], bounds, np.diff(prefix(s != 0)[at])


def gram_counts(learn: DataFrame) -> DataFrame:
    """(lang, gram, n) over all rows of ``learn`` (text, lang); each task adds
    up its own counts before the shuffle."""
    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for whole in batches:
            for b in pieces(whole):
                grams, bounds, _ = trigrams(b)
                codes = b.column("lang").dictionary_encode()
                rows = np.repeat(codes.indices.to_numpy(zero_copy_only=False), np.diff(bounds))
                for k, lang in enumerate(codes.dictionary.to_pylist()):
                    got = np.bincount(grams[rows == k], minlength=SYMBOLS ** 3)
                    if lang in sums:
                        sums[lang] += got
                    else:
                        sums[lang] = got
                if len(sums) > 16:  # many languages: hand over what there is
                    yield from rows_of(sums)
                    sums = {}
        yield from rows_of(sums)

    def rows_of(sums):
        for lang, n in sums.items():
            grams = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(grams), pa.string()), pa.array(grams, pa.int32()),
                                              pa.array(n[grams], pa.int64())], ["lang", "gram", "n"])

    part = learn.mapInArrow(count, "lang string, gram int, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def score_table(langs: list[str], counts: list[tuple[np.ndarray, np.ndarray]],
                dimensions: int = DIMENSIONS, seed: int = SEED) -> np.ndarray:
    """[languages, SYMBOLS ** 3]: each trigram vector's dot product with each
    prototype, divided by the prototype's length. ``counts`` holds (trigrams,
    their counts) by language."""
    rng = np.random.default_rng(seed)
    letters = rng.choice(np.array([-1, 1], np.int8), (SYMBOLS, dimensions)).astype(np.float32)
    first, second = np.roll(letters, 2, axis=1), np.roll(letters, 1, axis=1)
    prototypes = np.zeros((len(langs), dimensions), np.float32)
    for k, (grams, n) in enumerate(counts):
        by_pair = np.zeros((SYMBOLS * SYMBOLS, SYMBOLS), np.float32)
        by_pair.reshape(-1)[grams] = n / n.sum()
        for pair in np.flatnonzero(by_pair.any(axis=1)):
            prototypes[k] += first[pair // SYMBOLS] * second[pair % SYMBOLS] * (by_pair[pair] @ letters)
    prototypes /= np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)
    table = np.empty((len(langs), SYMBOLS, SYMBOLS, SYMBOLS), np.float32)
    for k in range(len(langs)):
        for a in range(SYMBOLS):
            table[k, a] = (second * (first[a] * prototypes[k])) @ letters.T
    return table.reshape(len(langs), SYMBOLS ** 3)


def predict(docs: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of ``docs`` (doc_id,
    held_out, text). The score is the best cosine's share of all positive
    cosines, so the text vector's own length cancels out."""
    shared = docs.sparkSession.sparkContext.broadcast(table)  # SYMBOLS ** 3 numbers a language
    names = np.array([*langs, "und"], object)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        dots = shared.value
        for whole in batches:
            for b in pieces(whole):
                grams, bounds, letters = trigrams(b)
                n = b.num_rows
                sums = np.zeros((n, max(1, len(dots))))
                for k in range(len(dots)):
                    total = np.concatenate([[0.0], np.cumsum(dots[k][grams], dtype=np.float64)])
                    sums[:, k] = total[bounds[1:]] - total[bounds[:-1]]
                best = sums.argmax(axis=1)
                positive = np.maximum(sums, 0)
                total = positive.sum(axis=1)
                top = positive[np.arange(n), best]
                known = (letters > 0) & (len(dots) > 0)
                best = np.where(known, best, len(langs))
                score = np.where(known & (total > 0), top / np.where(total > 0, total, 1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("held_out"), pa.array(names[best], pa.string()),
                     pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return docs.mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """Learn from the rows that are not held out, predict every row."""
    learn = docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))
                       & F.col("lang").isNotNull() & F.col("text").isNotNull()).select("lang", "text")
    rows = gram_counts(learn).toPandas()  # at most SYMBOLS ** 3 rows a language
    langs = sorted(rows["lang"].unique())
    counts = [(g["gram"].to_numpy(), g["n"].to_numpy()) for _, g in sorted(rows.groupby("lang"))]
    table = score_table(langs, counts, dimensions)
    return predict(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), langs, table)
