"""Multi-choice answers (W2): ``"a c"`` -> 0/1 member columns ``q/a``, ``q/b``, ``q/c``."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q, require_columns

TOKEN_SPLIT = r"\s+"


def choice_tokens(df: DataFrame, column: str) -> list[str]:
    """Distinct answer tokens of a multi-choice column, sorted. They become
    column names, so they are listed on the driver: as many as the form's
    choice list has, whatever the number of answers."""
    toks = (df.select(F.explode(F.split(F.trim(F.col(q(column))), TOKEN_SPLIT)).alias("t"))
              .where(F.col("t") != "").distinct())
    return sorted(r["t"] for r in toks.collect())


def expand_select_multiple(df: DataFrame, column: str, choices: list[str] | None = None,
                           sm_sep: str = "/") -> DataFrame:
    """Add one int column ``column<sm_sep>choice`` per choice: 1 when the
    blank-separated answer holds the choice, 0 when not, NULL when the answer
    is NULL. Existing member columns of the same name are replaced."""
    require_columns(df, [column], "data")
    if choices is None:
        choices = choice_tokens(df, column)
    toks = F.split(F.trim(F.col(q(column))), TOKEN_SPLIT)
    names = [f"{column}{sm_sep}{c}" for c in choices]
    keep = [F.col(q(c)) for c in df.columns if c not in set(names)]
    tmp = "__tokens"
    out = df.select(*keep, toks.alias(tmp))
    members = [F.when(F.col(q(column)).isNull(), F.lit(None))
                .otherwise(F.array_contains(F.col(tmp), c).cast("int")).alias(n)
               for c, n in zip(choices, names)]
    return out.select(*keep, *members)


def members_long(df: DataFrame, column: str, key: str, sm_sep: str = "/") -> DataFrame:
    """Member columns back to long form: (key, choice, selected)."""
    pre = column + sm_sep
    mcols = [c for c in df.columns if c.startswith(pre)]
    if not mcols:
        raise ValueError(f"no member columns for {column}")
    stacked = F.inline(F.array(*[F.struct(F.lit(c[len(pre):]).alias("choice"),
                                           F.col(q(c)).alias("selected")) for c in mcols]))
    return df.select(F.col(q(key)), stacked)
