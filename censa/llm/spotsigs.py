"""SpotSigs fingerprints, DataFrame functions only (operator 2).

Wherever a common word (anchor) stands, the next CHAIN content words (words
that are no anchors) form a chain; the anchor and its chain make a spot
signature, eight hexadecimal digits of its MD5. A text's fingerprint is its
set of signatures, sorted and run together. Likeness is the Jaccard index of
two sets.

``similar`` searches a table for the pairs of fingerprints that reach a
threshold. A pair can only do so if the smaller set's length is at least that
share of the larger one's, so sets are partitioned by length, met by their
rarest signatures within the partitions in reach, and the bound prunes pairs
before sets are compared. ``compare_edited``, the query, compares given pairs
alone: all are wanted, so nothing is partitioned or pruned there.

A text without a complete chain takes every three words in a row as a
signature, and one of fewer than three words the whole lower-case text, so
short texts differ too.

Edge rules: a null text is empty; documents are ordered by id, nulls first,
then text; the document after the last is the first (of a single row: itself).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHAIN = 2

# Common words of English, German, French and Spanish.
ANCHORS = (
    "a an and are as at be but by for from had has have he her his i in is it not of on or she that the they this to "
    "was were which will with you "
    "aber als auch auf aus das dem den der des die ein eine er es für hat ich im ist mit nicht sich sie sind so und "
    "von war wie wir zu zum "
    "au aux ce ces dans des du elle en est et il la le les leur mais nous ou où par pas pour que qui sa se ses son sur "
    "un une vous "
    "al como con de del el ella en era es ha la las lo los más no o para pero por que se si sin su sus un una y").split()


def words_of(text: Column) -> Column:
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")


def signature(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws(" ", *parts)), 1, 8)


def spot_signatures(frame: DataFrame, text: str, name: str, chain: int = CHAIN,
                    anchors: list[str] | tuple[str, ...] = tuple(dict.fromkeys(ANCHORS))) -> DataFrame:
    """``frame`` with the sorted set of signatures of its column ``text``."""
    content = F.filter(F.transform(F.col("_words"), lambda w, i: F.struct(i.alias("i"), w.alias("w"))),
                       lambda x: ~x["w"].isin(list(anchors)))
    before = lambda j: F.coalesce(F.get("_content", j - 1)["i"], F.lit(-1))

    def spots(c, j):
        links = [F.get("_content", j + k)["w"] for k in range(chain)]
        ready = links[-1].isNotNull()
        between = F.when(ready, F.slice("_words", before(j) + 2, c["i"] - before(j) - 1)).otherwise(F.array().cast("array<string>"))
        return F.transform(between, lambda a: signature(a, *links))

    chains = F.flatten(F.transform("_content", spots))
    triples = F.transform(F.sequence(F.lit(0), F.size("_words") - 3),
                          lambda i: signature(*(F.get("_words", i + k) for k in range(3))))
    found = (F.when(F.size("_spots") > 0, F.col("_spots")).when(F.size("_words") >= 3, triples)
             .otherwise(F.array(signature(F.lower(text)))))
    return (frame.withColumn("_words", words_of(F.col(text))).withColumn("_content", content)
            .withColumn("_spots", chains).withColumn(name, F.sort_array(F.array_distinct(found)))
            .drop("_words", "_content", "_spots"))


def jaccard(a: Column, b: Column, threshold: float = 0.0) -> Column:
    """Jaccard index of two sets; 0 without comparing them where their lengths
    keep it below ``threshold``."""
    shared = F.size(F.array_intersect(a, b))
    exact = shared / (F.size(a) + F.size(b) - shared)
    bound = F.least(F.size(a), F.size(b)) / F.greatest(F.size(a), F.size(b))
    return F.when(bound < threshold, F.lit(0.0)).otherwise(exact)


def length_partition(n: Column, threshold: float) -> Column:
    """Partition of a set length: lengths two or more partitions apart cannot
    reach the threshold together."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1 / threshold))).cast("int")


def similar(docs: DataFrame, threshold: float) -> DataFrame:
    """fingerprint, other, near: every pair of different fingerprints of
    ``docs`` with a Jaccard index of ``threshold`` or more, once each (the
    smaller set first). Documents with one fingerprint are alike in full and
    count once.

    Two such sets share a signature among the first n - ceil(threshold n) + 1
    of each in any common order; the order is by falling rarity, so common
    signatures seldom meet. A group of G alike sets has G * G / 2 pairs, all
    of which are rows of the result."""
    if not 0 < threshold < 1:
        raise ValueError("threshold must lie between 0 and 1")
    sets = (spot_signatures(docs.select(F.coalesce("text", F.lit("")).alias("text")), "text", "sigs")
            .select("sigs", F.array_join("sigs", "").alias("fingerprint"))
            .withColumn("key", F.md5("fingerprint")).dropDuplicates(["key"]))
    each = sets.select("key", F.explode("sigs").alias("sig"))
    order = (each.join(each.groupBy("sig").agg(F.count("*").alias("c")), "sig")
             .groupBy("key").agg(F.sort_array(F.collect_list(F.struct("c", "sig"))).alias("_order")))
    n, least = F.col("n"), F.ceil(F.col("n") * threshold - 1e-9).cast("int")
    first = (order.withColumn("n", F.size("_order"))
             .select("key", "n", F.explode(F.slice("_order", F.lit(1), n - least + 1)["sig"]).alias("sig")))
    small = first.select("sig", length_partition(n, threshold).alias("part"), F.col("key").alias("a"), F.col("n").alias("na"))
    reach = F.sequence(length_partition(least, threshold), length_partition(n, threshold))
    large = first.select("sig", F.explode(reach).alias("part"), F.col("key").alias("b"), F.col("n").alias("nb"))
    met = (small.join(large, ["sig", "part"])
           .where("na < nb OR na = nb AND a < b").where(F.col("na") >= F.col("nb") * threshold - 1e-9)
           .select("a", "b").distinct())
    side = lambda key, name: sets.select(
        F.col("key").alias(key), F.col("sigs").alias(f"_{key}"), F.col("fingerprint").alias(name))
    return (met.join(side("a", "fingerprint"), "a").join(side("b", "other"), "b")
            .select("fingerprint", "other", jaccard(F.col("_a"), F.col("_b"), threshold).alias("near"))
            .where(F.col("near") >= threshold))


def with_next(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """doc_id, text, next_text and both fingerprint sets (sigs, next_sigs).

    Rows are dealt by ranges of the id, cut at ids that percentiles find, and
    the rows at each cut are also sent to the range before it, so one shuffle
    brings each row together with the next. What the driver gets are the cuts,
    ``buckets`` of them (default: four for each shuffle partition)."""
    spark = docs.sparkSession
    buckets = buckets or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    share = [i / buckets for i in range(1, buckets)]
    seen = base.agg(F.percentile_approx("doc_id", share or [0.5], max(10_000, 10 * buckets)).alias("cuts"),
                    F.min("doc_id").alias("least"), F.max(F.col("doc_id").isNull()).alias("nulls")).first()
    cuts = sorted({c for c in seen["cuts"] or [] if c != seen["least"]} if share else [])
    kind = docs.schema["doc_id"].dataType
    array = F.lit(cuts).cast(f"array<{kind.simpleString()}>") if cuts else F.array().cast(f"array<{kind.simpleString()}>")
    steps = [1 << b for b in range(len(cuts).bit_length() - 1, -1, -1)] if cuts else []
    at = F.lit(0)
    if cuts:  # binary search: the number of cuts at or below the id
        at = F.aggregate(F.lit(steps), F.lit(0),
                         lambda pos, step: F.when(F.get(F.col("_cuts"), pos + step - 1) <= F.col("doc_id"), pos + step).otherwise(pos))
    first = F.col("doc_id").isNull() if seen["nulls"] else F.col("doc_id") == F.lit(seen["least"])
    place = lambda b, order: F.struct(b.cast("int").alias("b"), F.lit(order).alias("kind"))
    places = F.array(place(F.col("_at"), 0))
    if cuts:
        cut_row = (F.col("_at") > 0) & (F.get(F.col("_cuts"), F.col("_at") - 1) == F.col("doc_id"))
        places = F.concat(places, F.when(cut_row, F.array(place(F.col("_at") - 1, 1))).otherwise(F.array().cast("array<struct<b:int,kind:int>>")))
    places = F.concat(places, F.when(first, F.array(place(F.lit(len(cuts)), 2))).otherwise(F.array().cast("array<struct<b:int,kind:int>>")))
    dealt = (base.withColumn("_cuts", array).withColumn("_at", F.coalesce(at, F.lit(0)))
             .withColumn("_place", F.explode(places)).select("doc_id", "text", "_place.b", "_place.kind").repartition("b"))
    order = Window.partitionBy("b").orderBy("kind", F.col("doc_id").asc_nulls_first(), "text")
    return (spot_signatures(dealt, "text", "sigs")
            .select("doc_id", "text", "sigs", "kind", F.lead("text").over(order).alias("next_text"),
                    F.lead("sigs").over(order).alias("next_sigs"))
            .where("kind = 0").drop("kind"))


def compare_edited(docs: DataFrame, share: int = 4, threshold: float = 0.0) -> DataFrame:
    """Each document's fingerprint against that of its edited text (its last
    ``1 / share`` replaced by the beginning of the next document) and of the
    next document."""
    n = F.length("text")
    taken = F.floor(n / share).cast("int")
    edited = with_next(docs).withColumn(
        "edited", F.concat(F.left("text", n - taken), F.left("next_text", taken)))
    return (spot_signatures(edited, "edited", "edited_sigs")
            .select("doc_id", n.cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                    F.array_join("sigs", "").alias("fingerprint"), F.array_join("edited_sigs", "").alias("edited_fingerprint"),
                    jaccard(F.col("sigs"), F.col("edited_sigs"), threshold).alias("near_edited"),
                    jaccard(F.col("sigs"), F.col("next_sigs"), threshold).alias("near_next"),
                    F.size("sigs").cast("long").alias("n_signatures")))
