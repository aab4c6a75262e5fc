"""List of analyses (W4): which statistic to run on which variable, per group.

The list is the plan of the results pipeline. It is derived from the form
(question types) and/or from the data's schema (column types); group rows
are added by exploding a literal array, so no join pairs analyses with
groups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType, StringType

from ..functions.columns import require_columns

# Server-metadata columns that are never analysed.
SURVEY_METADATA = [
    "_index", "_id", "__version__", "instanceID", "_xform_id_string",
    "uuid", "_uuid", "rootUuid", "_status", "_submission_time", "_validation_status",
    "_submitted_by", "_attachments", "weights", "weight",
]

def multi_choice_parents(columns: list[str], sm_sep: str = "/") -> set[str]:
    """A column p is a multi-choice parent when some column starts with p+sep."""
    cols = set(columns)
    starts = {c[:i] for c in cols for i in range(len(c)) if c.startswith(sm_sep, i)}
    return cols & starts


def type_from_form(type_col) -> F.Column:
    """Form question type -> analysis type (packed with ':' for two)."""
    t = type_col  # exact names, as in the form; selects match as substrings
    return (F.when(t.isin("integer", "decimal"), F.lit("mean:median"))
             .when(t.contains("select_one"), F.lit("prop_select_one"))
             .when(t.contains("select_mult"), F.lit("prop_select_multiple")))


def _schema_rows(data: DataFrame, sm_sep: str):
    parents = multi_choice_parents(data.columns, sm_sep)
    rows = []
    for f in data.schema.fields:
        name = f.name
        if name in SURVEY_METADATA or sm_sep in name:
            continue
        if name in parents:
            t = "prop_select_multiple"
        elif isinstance(f.dataType, StringType):
            t = "prop_select_one"
        elif isinstance(f.dataType, NumericType):
            t = "median:mean"
        else:
            continue  # logical, dates, nested: not analysed
        rows.append((name, t))
    return rows


def analysis_list(spark: SparkSession, form: DataFrame | None = None,
                  data: DataFrame | None = None, level: float = 0.95,
                  group_vars: list[str] | None = None, sm_sep: str = "/") -> DataFrame:
    """Columns: analysis_var, analysis_type, level, group_var (NULL = overall).

    Data-derived analyses come first, then the form's; a variable present in
    the form is taken from the form only. ``level`` applies to both paths.
    """
    if form is None and data is None:
        raise ValueError("must provide either form or data")
    group_vars = [g for g in (group_vars or []) if g is not None]
    if data is not None and group_vars:
        missing = [g for g in group_vars if g not in data.columns]
        if missing:
            raise ValueError(f"group_vars not present in data: {', '.join(missing)}")

    parts = []
    if form is not None:
        require_columns(form, ["type", "name"], "form")
        form_loa = (form.select(F.col("name").alias("analysis_var"),
                                type_from_form(F.col("type")).alias("packed"))
                        .where(F.col("packed").isNotNull())
                        .select("analysis_var",
                                F.explode(F.split("packed", ":")).alias("analysis_type")))
        parts.append(form_loa)
    if data is not None:
        rows = _schema_rows(data, sm_sep)
        data_loa = (spark.createDataFrame(rows, "analysis_var string, packed string")
                         .select("analysis_var",
                                 F.explode(F.split("packed", ":")).alias("analysis_type")))
        if form is not None:  # variables in the form come from the form only
            names = form.select(F.col("name").alias("__name")).distinct()
            data_loa = data_loa.join(names, F.col("analysis_var") == F.col("__name"), "left_anti")
        parts.insert(0, data_loa)
    loa = parts[0]
    for p in parts[1:]:
        loa = loa.unionByName(p)
    groups = F.array(F.lit(None).cast("string"), *[F.lit(g) for g in group_vars])
    return (loa.select("analysis_var", "analysis_type", F.lit(float(level)).alias("level"),
                       F.explode(groups).alias("group_var"))
               .where(F.col("group_var").isNull() | (F.col("group_var") != F.col("analysis_var"))))
