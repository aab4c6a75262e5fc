"""Results tables: labels (W6) and the variable x group layout (W7).

Inputs are the long results of :func:`censa.operators.estimates.survey_results`
(result-sized) and the form's survey/choices sheets (form-sized). Joins are
plain equi-joins; AQE turns them into broadcasts after measuring the sides.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q, require_columns
from ..session import ensure_checkpoint_dir
from .cumulative import running_sum

KEY_COLUMNS = ["analysis_type", "analysis_var", "analysis_var_value"]
LABEL_KEY_COLUMNS = ["analysis_type", "label_analysis_var", "label_analysis_var_value"]
VALUE_COLUMNS = ("stat", "stat_upp", "stat_low", "n")
OVERALL = "Overall"


def _key(t, v, vv, g, gv) -> F.Column:
    na = F.lit("NA")
    return F.concat_ws(" @/@ ", t,
                       F.concat_ws(" %/% ", v, F.coalesce(vv, na)),
                       F.concat_ws(" %/% ", F.coalesce(g, na), F.coalesce(gv, na)))


def add_analysis_key(results: DataFrame) -> DataFrame:
    """``type @/@ var %/% value @/@ group_var %/% group_value`` (NULL -> NA)."""
    return results.withColumn("analysis_key", _key(
        F.col("analysis_type"), F.col("analysis_var"), F.col("analysis_var_value"),
        F.col("group_var"), F.col("group_var_value")))


def _list_of(type_col) -> F.Column:
    # second blank-separated token of 'select_one <list>'
    return F.get(F.split(F.trim(type_col), " +"), 1)


def label_results(results: DataFrame, questions: DataFrame, choices: DataFrame,
                  label_column: str = "label::english") -> DataFrame:
    """Add label_analysis_var, label_analysis_var_value, label_group_var,
    label_group_var_value and label_analysis_key; a missing label falls back
    to the raw name. Duplicate names in the sheets resolve to the smallest
    label, so no result row is repeated."""
    require_columns(questions, ["type", "name", label_column], "questions")
    require_columns(choices, ["list_name", "name", label_column], "choices")
    qd = (questions.groupBy(F.col("name").alias("__qn"))
                   .agg(F.min(F.col(q(label_column))).alias("__ql"),
                        F.min(_list_of(F.col("type"))).alias("__qlist")))
    cd = (choices.groupBy(F.col("list_name").alias("__cl"), F.col("name").cast("string").alias("__cn"))
                 .agg(F.min(F.col(q(label_column))).alias("__clab")))

    def qjoin(df, on_col, prefix):
        d = qd.select(F.col("__qn").alias(f"{prefix}_qn"), F.col("__ql").alias(f"{prefix}_ql"),
                      F.col("__qlist").alias(f"{prefix}_list"))
        return df.join(d, F.col(on_col) == F.col(f"{prefix}_qn"), "left")

    def cjoin(df, list_col, val_col, prefix):
        d = cd.select(F.col("__cl").alias(f"{prefix}_cl"), F.col("__cn").alias(f"{prefix}_cn"),
                      F.col("__clab").alias(f"{prefix}_clab"))
        return df.join(d, (F.col(list_col) == F.col(f"{prefix}_cl"))
                       & (F.col(val_col) == F.col(f"{prefix}_cn")), "left")

    df = qjoin(results, "analysis_var", "__v")
    df = cjoin(df, "__v_list", "analysis_var_value", "__vv")
    df = qjoin(df, "group_var", "__g")
    df = cjoin(df, "__g_list", "group_var_value", "__gv")
    lv = F.coalesce(F.col("__v_ql"), F.col("analysis_var"))
    lvv = F.when(F.col("analysis_var_value").isNull(), F.lit(None).cast("string")) \
           .otherwise(F.coalesce(F.col("__vv_clab"), F.col("analysis_var_value")))
    lg = F.when(F.col("group_var").isNull(), F.lit(None).cast("string")) \
          .otherwise(F.coalesce(F.col("__g_ql"), F.col("group_var")))
    lgv = F.when(F.col("group_var_value").isNull(), F.lit(None).cast("string")) \
           .otherwise(F.coalesce(F.col("__gv_clab"), F.col("group_var_value")))
    out = df.select(*[F.col(q(c)) for c in results.columns],
                    lv.alias("label_analysis_var"), lvv.alias("label_analysis_var_value"),
                    lg.alias("label_group_var"), lgv.alias("label_group_var_value"))
    return out.withColumn("label_analysis_key", _key(
        F.col("analysis_type"), F.col("label_analysis_var"), F.col("label_analysis_var_value"),
        F.col("label_group_var"), F.col("label_group_var_value")))


def review_labels(questions: DataFrame, choices: DataFrame,
                  label_column: str = "label::english") -> DataFrame:
    """Label problems that make a labelled table ambiguous:
    (sheet, list_name, name, label, issue) for missing labels, labels shared
    by several questions, and labels shared by several choices of one list."""
    require_columns(questions, ["type", "name", label_column], "questions")
    require_columns(choices, ["list_name", "name", label_column], "choices")
    lab = F.col(q(label_column))
    qs = questions.select(F.lit("survey").alias("sheet"), F.lit(None).cast("string").alias("list_name"),
                          F.col("name").cast("string").alias("name"), lab.alias("label"))
    cs = choices.select(F.lit("choices").alias("sheet"), F.col("list_name").cast("string"),
                        F.col("name").cast("string").alias("name"), lab.alias("label"))
    # form-sized and read three times below: stored once
    ensure_checkpoint_dir(questions.sparkSession)
    both = qs.unionByName(cs).checkpoint(eager=True)
    missing = (both.where(F.col("label").isNull() | (F.trim(F.col("label")) == ""))
                   .withColumn("issue", F.lit("missing label")))
    dup_keys = (both.where(F.col("label").isNotNull() & (F.trim(F.col("label")) != ""))
                    .groupBy("sheet", "list_name", "label")
                    .agg(F.countDistinct("name").alias("k")).where(F.col("k") > 1)
                    .select(F.col("sheet").alias("__s"), F.col("list_name").alias("__l"),
                            F.col("label").alias("__lab")))
    dups = (both.join(dup_keys, (F.col("sheet") == F.col("__s"))
                      & F.col("list_name").eqNullSafe(F.col("__l"))
                      & (F.col("label") == F.col("__lab")))
                .select("sheet", "list_name", "name", "label")
                .withColumn("issue", F.lit("duplicated label")))
    return missing.unionByName(dups)


class GroupValue(NamedTuple):
    """A column block of a wide table: the raw value (``overall`` and a NULL
    value apart from any text) and what it is called."""
    overall: bool
    value: str | None
    label: str


def group_value_counts(results: DataFrame) -> dict[str, int]:
    """Number of group values of every disaggregation."""
    rows = (results.where(F.col("group_var").isNotNull()).select("group_var", F.col("group_var_value").cast("string")).distinct()
            .groupBy("group_var").count().collect())
    return {r["group_var"]: r["count"] for r in rows}


def group_values_of(results: DataFrame, use_labels: bool = False) -> dict[str, list[GroupValue]]:
    """The group values of every disaggregation in a stored results table, in
    one job. They become columns, so the driver gets as many as the widest
    wide tables have. Values with equal labels are all listed."""
    label = F.col("label_group_var_value") if use_labels else F.col("group_var_value")
    rows = (results.where(F.col("group_var").isNotNull())
            .groupBy("group_var", F.col("group_var_value").cast("string").alias("value"))
            .agg(F.min(label.cast("string")).alias("label")).collect())
    out: dict[str, list[GroupValue]] = {}
    for r in sorted(rows, key=lambda r: (r["group_var"], r["label"] or "NA", r["value"] is not None, r["value"] or "")):
        out.setdefault(r["group_var"], []).append(GroupValue(False, r["value"], r["label"] or "NA"))
    return out


def _headers(blocks: list[GroupValue], value_columns) -> list[list[str]]:
    """Header of each block's columns; a clash (also in letter case) gets a suffix."""
    seen: set[str] = set()
    out = []
    for b in blocks:
        k, name = 1, b.label
        while any(f"{name}_{c}".lower() in seen for c in value_columns):
            k += 1
            name = f"{b.label}_{k}"
        names = [f"{name}_{c}" for c in value_columns]
        seen |= {n.lower() for n in names}
        out.append(names)
    return out


def results_wide(results: DataFrame, group_var: str | None,
                 value_columns=VALUE_COLUMNS, use_labels: bool = False,
                 group_values: list[GroupValue] | None = None, stored: bool = False) -> DataFrame:
    """Variable x group table for one disaggregation: the key columns, then
    for ``Overall`` and each group value the ``value_columns`` in the given
    order, named ``<group value>_<value column>``. A NULL group value is
    called ``NA``. Rows and columns go by the raw names and values: with
    labels, the label columns stand first and the raw key columns beside
    them, so two choices of one label stay two rows, and headers that would
    be equal get a suffix. ``group_values`` (see :func:`group_values_of`)
    fixes the columns; else they are listed from the rows, which are stored
    first unless ``stored`` says they are."""
    labels = LABEL_KEY_COLUMNS[1:] if use_labels else []
    keys = [KEY_COLUMNS[0], *labels, *KEY_COLUMNS[1:]]
    require_columns(results, [*keys, "group_var", "group_var_value", *value_columns], "results")
    sel = F.col("group_var").isNull()
    if group_var is not None:
        sel = sel | (F.col("group_var") == group_var)
    rows = results.where(sel)
    if group_values is None:
        if group_var is not None and not stored:
            ensure_checkpoint_dir(results.sparkSession)
            rows = rows.checkpoint(eager=True)
        group_values = group_values_of(rows, use_labels).get(group_var, []) if group_var is not None else []
    blocks = [GroupValue(True, None, OVERALL), *(g for g in group_values if not g.overall)]
    # the pivot value: its kind in front keeps Overall, NULL and any text apart
    mark = F.when(F.col("group_var").isNull(), F.lit("O")) \
            .otherwise(F.coalesce(F.concat(F.lit("V"), F.col("group_var_value").cast("string")), F.lit("N")))
    marks = ["O" if b.overall else "N" if b.value is None else f"V{b.value}" for b in blocks]
    wide = (rows.withColumn("__pivot", mark).groupBy(*keys).pivot("__pivot", marks)
                .agg(*[F.max(F.col(q(c))).alias(c) for c in value_columns]))
    names = [n for block in _headers(blocks, value_columns) for n in block]
    return wide.toDF(*keys, *names)


class ResultTiles(NamedTuple):
    """A variable x group table in tiles of equal width."""
    rows: DataFrame    # tile, key columns, b<place>_<value column> ...
    header: DataFrame  # tile, place, overall, group_var_value, label


def result_tiles(results: DataFrame, group_var: str, value_columns=VALUE_COLUMNS, use_labels: bool = False,
                 width: int = 100) -> ResultTiles:
    """The table of :func:`results_wide` for any number of group values: the
    columns of ``width`` blocks at a time form a tile, and a header table says
    which group value stands in which place of which tile (Overall first, then
    by label; a NULL value is called ``NA``). Values are numbered by a
    distributed running sum, so neither the driver nor a task holds them all.
    A key has a row in the tiles where it has values."""
    labels = LABEL_KEY_COLUMNS[1:] if use_labels else []
    keys = [KEY_COLUMNS[0], *labels, *KEY_COLUMNS[1:]]
    require_columns(results, [*keys, "group_var", "group_var_value", *value_columns], "results")
    rows = results.where(F.col("group_var").isNull() | (F.col("group_var") == group_var))
    label = F.col("label_group_var_value") if use_labels else F.col("group_var_value")
    named = (rows.where(F.col("group_var").isNotNull()).groupBy(F.col("group_var_value").cast("string").alias("value"))
             .agg(F.coalesce(F.min(label.cast("string")), F.lit("NA")).alias("label"))
             # one sortable text per value: labels first, a NULL value before any other of its label
             .withColumn("order", F.concat("label", F.lit("\x00"), F.coalesce(F.concat(F.lit("v"), F.col("value")), F.lit(""))))
             .withColumn("one", F.lit(1)).withColumn("all", F.lit(0)))
    numbered = running_sum(named, ["all"], "order", "one", "number").rows
    overall = results.sparkSession.range(1).select(F.lit(True).alias("overall"), F.lit(None).cast("string").alias("value"),
                                                   F.lit(OVERALL).alias("label"), F.lit(0).cast("long").alias("number"))
    header = (overall.unionByName(numbered.select(F.lit(False).alias("overall"), "value", "label", F.col("number").cast("long").alias("number")))
              .select(F.floor(F.col("number") / width).cast("int").alias("tile"), (F.col("number") % width).cast("int").alias("place"),
                      "overall", F.col("value").alias("group_var_value"), "label").checkpoint(eager=True))
    at = header.select("tile", "place", F.col("overall").alias("__overall"), F.col("group_var_value").alias("__value"))
    placed = rows.join(at, F.col("group_var").isNull().eqNullSafe(F.col("__overall"))
                       & F.col("group_var_value").cast("string").eqNullSafe(F.col("__value")))
    wide = placed.groupBy("tile", *keys).pivot("place", list(range(width))).agg(*[F.max(F.col(q(c))).alias(c) for c in value_columns])
    return ResultTiles(wide.toDF("tile", *keys, *[f"b{i}_{c}" for i in range(width) for c in value_columns]), header)


def numeric_value_columns(wide: DataFrame, n_keys: int = 3) -> DataFrame:
    """Cast every column after the first ``n_keys`` (5 for a labelled table)
    to double (text that is not a number becomes NULL), e.g. for a wide table
    read back from CSV."""
    return wide.select(*[F.col(q(c)) if i < n_keys else F.col(q(c)).try_cast("double").alias(c)
                         for i, c in enumerate(wide.columns)])
