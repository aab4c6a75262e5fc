"""Column helpers: argument checks, quoting, clean name tokens."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def q(name: str) -> str:
    """Back-tick a column name (names may hold '.', '/', spaces)."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(q(name))


def number(c: Column) -> Column:
    """The value as a double; text that is not a number, and NaN, are NULL."""
    v = c.try_cast("double")
    return F.when(~F.isnan(v), v)


def require_columns(df: DataFrame, names: Iterable[str], what: str = "input") -> None:
    """Raise ValueError before any job when required columns are missing."""
    have = set(df.columns)
    missing = [n for n in names if n not in have]
    if missing:
        raise ValueError(f"{what} is missing column(s): {', '.join(missing)}")


def epoch_millis(df: DataFrame, name: str) -> Column:
    """Milliseconds since 1970-01-01 for a TIMESTAMP or TIMESTAMP_NTZ column,
    independent of the session time zone for NTZ values."""
    from pyspark.sql.types import TimestampNTZType
    if isinstance(df.schema[name].dataType, TimestampNTZType):
        return F.expr(f"timestampdiff(MILLISECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', {q(name)})")
    return F.unix_millis(col(name))


def safe_name_expr(c: Column) -> Column:
    """Clean token for a file or folder name; NULL becomes 'Overall'.

    Lower case, runs of characters outside [a-z0-9] become one '_', leading
    and trailing '_' removed, and a leading digit gets an 'x' prefix.
    """
    s = F.regexp_replace(F.lower(c.cast("string")), "[^a-z0-9]+", "_")
    s = F.regexp_replace(s, "^_+|_+$", "")
    s = F.when(s.rlike("^[0-9]"), F.concat(F.lit("x"), s)).otherwise(s)
    return F.when(c.isNull(), F.lit("Overall")).otherwise(s)


def safe_name(value) -> str:
    """Driver-side twin of :func:`safe_name_expr` for one value."""
    if value is None:
        return "Overall"
    s = re.sub("[^a-z0-9]+", "_", str(value).lower()).strip("_")
    if re.match("^[0-9]", s):
        s = "x" + s
    return s
