"""Results tables for every disaggregation in one plan, written out (W5-W8).

The estimates for all groups come from one :func:`survey_results` plan
(overall rows computed once, not once per group). The long table is written
once, partitioned by ``group_var``; each group's wide table is then built
from that stored, result-sized table with partition pruning, and written to
``{out_dir}/{prefix}__{safe_name}``. A status row per group forms the run
summary. All tables of a run are staged first and published together
(``publish``): a run that fails or is killed leaves the old tables as they are.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..design import SurveyDesign
from ..functions.columns import safe_name
from ..operators.estimates import plan_analyses, survey_results
from .publish import Staged, recover
from ..operators.tables import (VALUE_COLUMNS, add_analysis_key, group_value_counts, group_values_of, label_results,
                                result_tiles, results_wide, review_labels)

SUMMARY_SCHEMA = ("group string, safe_name string, success boolean, write_ok boolean, "
                  "path string, error string")


#: Group values that a wide table has as columns, at most; more are laid out in tiles.
MAX_VALUES = 1000
HEADER = "__header"

RESULT_SCHEMA = ("analysis_type string, analysis_var string, analysis_var_value string, group_var string, "
                 "group_var_value string, stat double, stat_low double, stat_upp double, n long")


class MultiResults(NamedTuple):
    results: DataFrame        # long results (stored copy), labelled if asked
    summary: DataFrame        # one status row per disaggregation
    aggregated_path: str | None  # the combined long table (all groups)
    label_review: DataFrame | None = None  # label problems, when labels are used


def _unique_names(groups):
    """Folder names: clean tokens, all different. A name without Latin letters
    or digits is called ``group``; a token already given gets the first free
    suffix."""
    given, out = set(), []
    for g in groups:
        base = safe_name(g) or "group"
        name, k = base, 0
        while name in given:
            k += 1
            name = f"{base}_{k}"
        given.add(name)
        out.append(name)
    return out


def _try(write) -> str | None:
    """Run a write; the full text of what went wrong, if anything did."""
    try:
        write()
        return None
    except Exception as e:  # noqa: BLE001 - reported in the summary
        return str(e)


def write_results(results: DataFrame, out_dir: str, file_prefix: str = "Desc_Table",
                  value_columns=VALUE_COLUMNS, overwrite: bool = True,
                  use_labels: bool = False, fmt: str = "parquet",
                  na_text: str | None = None, agg_filename: str | None = None,
                  max_values: int = MAX_VALUES) -> tuple[DataFrame, str | None]:
    """Write the long table partitioned by group_var and one wide table per
    disaggregation (``fmt`` parquet or csv; ``na_text`` is written for NULL
    in csv). All group values come from one job on the staged long table,
    and the wide tables are written side by side. A write that fails, the
    long table's included, becomes a status row with the full error, and the
    table of an earlier run stays in its place. Without ``overwrite`` a table
    that exists already is such a failure. A disaggregation of more than
    ``max_values`` group values is written in tiles (``result_tiles``,
    partitioned by tile) with their header in ``...__header``; its values are
    not listed on the driver. Returns (run summary, path of the
    long table or None if it could not be written)."""
    spark = results.sparkSession
    run = Staged(spark, out_dir)
    recover(spark, out_dir)
    long_name = agg_filename or file_prefix + "_aggregated_results"

    def stage(name: str, save) -> str | None:
        def checked():
            if not overwrite and run.exists(run.final(name)):
                raise FileExistsError(f"{run.final(name)} already exists")
            save(run.staged(name))
        return _try(checked)

    failed = stage(long_name, lambda path: results.write.partitionBy("group_var").parquet(path))
    if failed is not None:
        run.drop()
        return spark.createDataFrame([(None, safe_name(None), False, False, run.final(long_name), failed)], SUMMARY_SCHEMA), None
    stored = spark.read.parquet(run.staged(long_name))
    counts = group_value_counts(stored)
    tiled = {g for g, k in counts.items() if k > max_values}
    blocks = group_values_of(stored.where(~F.col("group_var").isin(*tiled)) if tiled else stored, use_labels)
    targets = sorted(counts) or [None]

    def write(g, name):
        def writer(table):
            out = table.write.format(fmt)
            if fmt == "csv":
                out = out.option("header", True)
                if na_text is not None:
                    out = out.option("nullValue", na_text)
            return out

        if g not in tiled:
            return stage(name, lambda path: writer(results_wide(stored, g, value_columns, use_labels, blocks.get(g, []))).save(path))

        def save(path):
            tiles = result_tiles(stored, g, value_columns, use_labels)
            writer(tiles.rows).partitionBy("tile").save(path)
            writer(tiles.header).save(path + HEADER)
        return stage(name, save)

    names = [f"{file_prefix}__{n}" for n in _unique_names(targets)]
    with ThreadPoolExecutor(max_workers=8) as pool:
        written = list(zip(names, pool.map(write, targets, names), strict=True))
    good = [n for n, error in written if error is None]
    headers = [n + HEADER for g, n in zip(targets, names, strict=True) if g in tiled and n in good]
    lost = _try(lambda: run.publish([long_name, *good, *headers]))
    statuses = [(g, n.removeprefix(f"{file_prefix}__"), (error or lost) is None, (error or lost) is None, run.final(n), error or lost)
                for g, (n, error) in zip(targets, written, strict=True)]
    summary = spark.createDataFrame(statuses, SUMMARY_SCHEMA)
    return summary, run.final(long_name) if lost is None else None


def multi_results(data: DataFrame, design: SurveyDesign, loa, out_dir: str,
                  file_prefix: str = "Desc_Table", questions: DataFrame | None = None,
                  choices: DataFrame | None = None, label_column: str = "label::english",
                  use_labels: bool = True, value_columns=VALUE_COLUMNS,
                  overwrite: bool = True, sm_sep: str = "/", ci_method: str = "wald",
                  fmt: str = "parquet", na_text: str | None = None,
                  agg_filename: str | None = None) -> MultiResults:
    """Estimates for every listed analysis and disaggregation, labelled,
    laid out per group and written. Analyses whose variable is missing are
    dropped and reported in the summary (``success = false``)."""
    spark = data.sparkSession
    kept, dropped = plan_analyses(data, loa, sm_sep)
    try:
        res = add_analysis_key(survey_results(data, design, kept, sm_sep, ci_method=ci_method))
    except ValueError as e:  # design problems (lonely strata, bad weights): one row per group
        groups = sorted({a.group_var for a in kept if a.group_var is not None}) or [None]
        rows = [(g, safe_name(g), False, False, None, str(e)) for g in groups]
        empty = spark.createDataFrame([], RESULT_SCHEMA)
        return MultiResults(empty, spark.createDataFrame(rows, SUMMARY_SCHEMA), None)
    labelled = use_labels and questions is not None and choices is not None
    if labelled:
        res = label_results(res, questions, choices, label_column)
    summary, long_path = write_results(res, out_dir, file_prefix, value_columns, overwrite,
                                       use_labels=labelled, fmt=fmt, na_text=na_text,
                                       agg_filename=agg_filename)
    if dropped:
        rows = [(a.group_var, safe_name(a.group_var), False, False, None,
                 f"analysis {a.analysis_type} of {a.analysis_var} dropped: {why}")
                for a, why in dropped]
        summary = summary.unionByName(spark.createDataFrame(rows, SUMMARY_SCHEMA))
    review = review_labels(questions, choices, label_column) if labelled else None
    return MultiResults(spark.read.parquet(long_path) if long_path else res, summary, long_path, review)
