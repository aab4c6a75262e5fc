"""Exported submissions (W1): lake scan and repeat-group split.

Submissions are read from exported files (JSON lines, parquet, CSV) instead
of a live server. A repeat group (e.g. a household roster) is an
``array<struct>`` column; :func:`split_repeats` turns each into a child table
keyed by the parent key and the 1-based position in the group.
Exports of drifting form versions are read by :func:`read_form_versions`.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from ..functions.columns import q, require_columns
from ..session import ensure_checkpoint_dir


def read_submissions(spark: SparkSession, path, fmt: str = "json", schema=None,
                     **options) -> DataFrame:
    """Scan exported submissions. JSON exports drop empty answers, so pass a
    ``schema`` (or rely on the inferred one, which JSON merges over all rows)
    to keep every column. For parquet files of differing schemas pass
    ``mergeSchema=True``; it reads every file's footer."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


class FormVersions(NamedTuple):
    submissions: DataFrame  # one row per record, the columns of all versions
    versions: DataFrame     # version, records, schema (as Spark writes it)


def _merged_type(schema: str) -> str:
    """DDL of a merged VARIANT schema. What is an object in one version and a
    text in another, or a number and a text, becomes text; so does what is
    always null. Numbers with decimals are doubles."""
    def plain(m: re.Match) -> str:
        kind = m[2]
        if kind.startswith("DECIMAL"):
            return m[1] + (kind if m[3] == "0" else "DOUBLE")
        return m[1] + ("STRUCT<" if kind == "OBJECT<" else "STRING")
    parts = re.split(r"(`(?:[^`]|``)*`)", schema.replace("OBJECT<>", "VOID"))  # names in back-ticks stay
    types = r"(^|: |ARRAY<)(OBJECT<|VARIANT\b|VOID\b|DECIMAL\(\d+,\s*(\d+)\))"
    return "".join(x if i % 2 else re.sub(types, plain, x) for i, x in enumerate(parts))


def _field(name: str) -> str:
    """Path of a top-level field; a name may hold one kind of quotes."""
    return f'$["{name}"]' if "'" in name else f"$['{name}']"


def read_form_versions(spark: SparkSession, path, version: str = "__version__") -> FormVersions:
    """Read JSON submissions of several form versions. Records are scanned as
    VARIANT, so a question that changes its type does not fail the scan; the
    schemas are united by one aggregate, grouped by version, which is
    result-sized (one row a version). ``submissions`` then is a single scan
    that extracts every column of every version, NULL where a version has
    none; no column is lost, whatever the order and the share of a version.
    Lines that are no JSON object are counted in ``versions`` (NULL version)
    and give no row."""
    raw = spark.read.format("json").option("singleVariantColumn", "v").load(path)
    tag = F.try_variant_get("v", _field(version), "string").alias("version")
    ensure_checkpoint_dir(spark)
    versions = raw.groupBy(tag).agg(F.count(F.lit(1)).alias("records"), F.schema_of_variant_agg("v").alias("schema")).checkpoint()
    objects = F.schema_of_variant("v").startswith("OBJECT<")
    merged = raw.where(objects).agg(F.schema_of_variant_agg("v")).first()[0]
    ddl = _merged_type(merged) if merged else "VOID"
    fields = StructType.fromDDL(f"r {ddl}")[0].dataType.fields if ddl.startswith("STRUCT<") else []
    rows = raw.where(objects).select(*[F.try_variant_get("v", _field(f.name), f.dataType.simpleString()).alias(f.name) for f in fields])
    return FormVersions(rows, versions)


class Submissions(NamedTuple):
    main: DataFrame
    repeats: dict[str, DataFrame]


def repeat_columns(df: DataFrame) -> list[str]:
    """Columns holding repeat groups (arrays of structs), except attachments."""
    return [f.name for f in df.schema.fields
            if isinstance(f.dataType, ArrayType) and isinstance(f.dataType.elementType, StructType)
            and f.name != "_attachments"]


def split_repeats(df: DataFrame, key: str = "uuid", repeats: list[str] | None = None,
                  index_col: str = "_index") -> Submissions:
    """Main table without the repeat columns, plus one child table per
    repeat group: (key, index_col, fields of the group). A field of the group
    named like the key or the index (exports have an ``_index`` of their own)
    is kept as ``<group>/<field>``. Parents with an empty or NULL group have
    no child rows."""
    require_columns(df, [key], "submissions")
    repeats = repeat_columns(df) if repeats is None else repeats
    require_columns(df, repeats, "submissions")
    main = df.drop(*repeats)
    children = {}
    for r in repeats:
        exploded = df.select(F.col(q(key)).alias(key),
                             F.posexplode(F.col(q(r))).alias("__pos", "__item"))
        fields = df.schema[r].dataType.elementType.fieldNames()
        taken = {key.lower(), index_col.lower()}
        children[r] = exploded.select(
            q(key), (F.col("__pos") + 1).alias(index_col),
            *[F.col("__item").getField(f).alias(f"{r}/{f}" if f.lower() in taken else f) for f in fields])
    return Submissions(main, children)
