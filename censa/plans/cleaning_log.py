"""Cleaning-log output (W16 sink): the workbook of the reference, as tables.

Each listed DataFrame is written to ``{out_dir}/{name}``; the allowed-value
lists go to ``validation_rules`` (wide, one column per list) and the meaning
of the change types to ``readme``. The log itself is written with the
validation columns of :func:`validate_cleaning_log` when drop-down rules are
asked for. All tables are staged and published together (``publish``), so a
rerun replaces its own output and a run that fails leaves the old tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.cleaning import (CHANGE_TYPES, choice_lists, choice_lists_wide,
                                  validate_cleaning_log)
from .publish import Staged, recover

# What each change type means (readme table).
CHANGE_TYPE_MEANING = [
    ("change_response", "Change the response to new.value"),
    ("blank_response", "Remove and NA the response"),
    ("remove_survey", "Delete the survey"),
    ("no_action", "No action to take."),
]


def write_cleaning_log(write_list: dict[str, DataFrame], out_dir: str,
                       cleaning_log_name: str = "cleaning_log",
                       change_type_col: str = "change_type", use_dropdown: bool = False,
                       use_others: bool = False, sm_dropdown_type: str | None = None,
                       form: DataFrame | None = None, choices: DataFrame | None = None,
                       fmt: str = "parquet") -> dict[str, str]:
    """Write every table of ``write_list`` plus ``validation_rules`` and
    ``readme``; returns {table name: path}."""
    if use_dropdown and (form is None or choices is None):
        raise ValueError("form and choices are needed to use drop-down lists")
    if sm_dropdown_type is not None and sm_dropdown_type.lower() not in ("logical", "numerical"):
        raise ValueError("sm_dropdown_type must be 'logical' or 'numerical'")
    if cleaning_log_name not in write_list:
        raise ValueError(f"{cleaning_log_name} not found in the given list")
    if change_type_col not in write_list[cleaning_log_name].columns:
        raise ValueError(f"{change_type_col} not found in {cleaning_log_name}")
    if "validation_rules" in write_list:
        raise ValueError("the list already has an element named validation_rules")
    spark = write_list[cleaning_log_name].sparkSession
    tables = dict(write_list)
    if use_dropdown:
        lists = choice_lists(choices, form, others=use_others)
        tables["validation_rules"] = choice_lists_wide(lists)
        tables[cleaning_log_name] = validate_cleaning_log(
            write_list[cleaning_log_name], form, choices, sm_dropdown_type, use_others,
            change_type_col)
    else:
        tables["validation_rules"] = spark.createDataFrame(
            [(c,) for c in CHANGE_TYPES], "change_type_validation string")
    tables["readme"] = spark.createDataFrame(CHANGE_TYPE_MEANING,
                                             "change_type_validation string, description string")
    run = Staged(spark, out_dir)
    recover(spark, out_dir)
    for name, df in tables.items():
        writer = df.write.format(fmt)
        if fmt == "csv":
            writer = writer.option("header", True)
        writer.save(run.staged(name))
    run.publish(list(tables))
    return {name: run.final(name) for name in tables}
