"""censa: survey analytics on Spark DataFrames.

Operators take DataFrames and return DataFrames; see README.md for the map
from survey tasks to functions.
"""

from .design import SurveyDesign
from .operators.cleaning import (choice_lists, choice_lists_wide, column_manifest, other_options,
                                 recode_others, validate_cleaning_log, variable_tracker)
from .operators.duration import interview_duration
from .operators.estimates import Analysis, survey_results
from .operators.odds import odds_ratio_counts, odds_ratios
from .operators.sampling import sample_sizes, stratified_sample, weight_diagnostics
from .operators.tables import add_analysis_key, label_results, results_wide, review_labels
from .plans.analysis_list import analysis_list
from .plans.cleaning_log import write_cleaning_log
from .plans.results import multi_results, write_results
from .sources.audit import audit_log, read_audit_csv
from .sources.multichoice import expand_select_multiple
from .sources.submissions import read_submissions, split_repeats

__all__ = [
    "SurveyDesign", "Analysis", "survey_results", "analysis_list", "label_results",
    "review_labels", "results_wide", "add_analysis_key", "multi_results", "write_results",
    "sample_sizes", "stratified_sample", "weight_diagnostics", "odds_ratio_counts",
    "odds_ratios", "interview_duration", "read_audit_csv", "audit_log", "read_submissions",
    "split_repeats", "expand_select_multiple", "column_manifest", "variable_tracker",
    "other_options", "choice_lists", "choice_lists_wide", "validate_cleaning_log",
    "recode_others", "write_cleaning_log",
]
