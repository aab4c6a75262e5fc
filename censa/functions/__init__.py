"""Scalar helpers: column checks, clean names, statistics on result rows."""

from .columns import col, q, require_columns, safe_name, safe_name_expr
from .stats import normal_quantile, t_quantile, two_sided_crit

__all__ = ["col", "q", "require_columns", "safe_name", "safe_name_expr",
           "normal_quantile", "t_quantile", "two_sided_crit"]
