"""A training-data pipeline over the ``documents`` table.

STAGES are applied in order; each takes (spark, docs, sf_dir) and returns a
DataFrame that the runner writes as Parquet and rereads as the next stage's
``docs``. All but the last return the columns of ``documents``:

1. quality rules: documents the repetition rules reject go;
2. SimHash near-dedup: one document of each group stays, the one with the
   smallest id (of several rows with that id, the one with the smallest MD5 of
   id and text, of those with equal texts the first by the other columns);
3. suffix-array dedup: byte strings that an earlier document has are cut out;
   what is left of characters cut through goes, and n_chars is counted anew;
4. secret scan: every span found is replaced by ``[SECRET]``, n_chars anew;
5. packing: the pieces of all texts and their places in the sequences.

A group without any id keeps its row of the smallest MD5 likewise. Null texts
fail the quality rules. Further columns of documents may have any names: they
are called c0, c1, ... while an operator works.
"""

from __future__ import annotations

from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, VariantType

from censa.functions.columns import q
from censa.llm import packing, quality, secrets, simhash, suffix_dedup
from censa.llm.common import read_documents, row_key
from censa.session import scratch_path


def fresh(docs: DataFrame, name: str) -> str:
    """A column name that ``docs`` does not have."""
    while name.lower() in {c.lower() for c in docs.columns}:
        name += "_"
    return name


def plain(docs: DataFrame) -> DataFrame:
    """``docs`` with names for its further columns that no operator uses."""
    return docs.select("doc_id", "text", *[F.col(q(c)).alias(f"c{i}") for i, c in enumerate(further(docs))])


def further(docs: DataFrame) -> list[str]:
    return [c for c in docs.columns if c not in ("doc_id", "text")]


def restored(docs: DataFrame, done: DataFrame, text: str | None = None) -> DataFrame:
    """The columns of ``docs`` from ``done`` (see ``plain``); with ``text``
    that new text and its number of characters."""
    new = {c: F.col(f"c{i}") for i, c in enumerate(further(docs))} | {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if text is not None:
        new |= {"text": F.col(text), "n_chars": F.length(text).cast("long")}
    return done.select(*[new[c].alias(c) for c in docs.columns])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = plain(docs)
    return restored(docs, quality.quality_rules(rows, keep=rows.columns, verdict="_kept").where("_kept"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    key, stay, nth = (fresh(docs, n) for n in ("_key", "_stay", "_nth"))
    named = row_key(F.col("doc_id"), F.col("text"))
    groups = simhash.near_duplicates(docs, keep=[F.col("doc_id"), named.alias("key")])
    first = (groups.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
             .groupBy("label").agg(F.min("key").alias(stay)).select(stay))
    # rows of one id and text share a key; types without an order (maps, variants) go by their text
    order = [c.cast("string") if isinstance(t, (MapType, VariantType)) else c
             for c, t in ((F.col(q(f.name)), f.dataType) for f in docs.schema.fields)]
    copies = Window.partitionBy(key).orderBy(*order)
    return (docs.withColumn(key, named).join(first, F.col(key) == F.col(stay), "left_semi")
            .withColumn(nth, F.row_number().over(copies)).where(F.col(nth) == 1).select(*[q(c) for c in docs.columns]))


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = plain(docs)
    return restored(docs, suffix_dedup.remove_earlier(rows, keep=rows.columns), "kept_text")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    rows = plain(docs)
    return restored(docs, secrets.scan(rows, public_tokenizers.path("byte_bpe_50k.tiktoken"), keep=rows.columns), "_redacted")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("simhash_near_dedup", simhash_near_dedup),
          ("suffix_array_dedup", suffix_array_dedup), ("secret_scan", secret_scan), ("packing", pack)]

#: SQL cannot express fingerprints, suffix arrays and tokenizers; the tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_documents(spark, sf_dir)
    folder = scratch_path(spark, f"pipeline-{uuid4().hex}")
    for name, stage in STAGES:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
