"""Univariate odds ratios of a 0/1 outcome by categorical groups (W12).

A logistic model with one categorical predictor is saturated, so its fit is
the 2 x k table of outcome counts: with (a1, a0) the 1/0 counts at the
reference level and (k1, k0) at another level,
``OR = k1*a0 / (k0*a1)``, ``se(log OR) = sqrt(1/a1 + 1/a0 + 1/k1 + 1/k0)``,
Wald ``p = erfc(|log OR / se| / sqrt 2)``, and the profile-likelihood limits
are the roots of the 2x2 profile deviance (the other levels profile out).

All grouping variables are unpivoted into (group_var, level) records and
counted in one aggregate; the statistics run on the count table (one row per
level) as column expressions. For a fixed log odds ratio the intercept solves
a quadratic, so the profile deviance has a closed form, and each limit is
found by a fixed number of bisections.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import number, q, require_columns
from ..functions.stats import normal_quantile
from ..session import ensure_checkpoint_dir

#: Bisections of a profile limit, and terms of the normal tail.
STEPS = 80
TERMS = 80


def normal_two_sided(z: Column) -> Column:
    """P(|Z| > |z|) of the standard normal: the power series of the error
    function near zero, its continued fraction further out."""
    x = F.abs(z) / math.sqrt(2.0)
    start = F.struct(x.alias("term"), x.alias("sum"))
    series = F.aggregate(F.sequence(F.lit(1), F.lit(TERMS)), start, lambda s, n: F.struct(
        (s["term"] * 2 * x * x / (2 * n + 1)).alias("term"), (s["sum"] + s["term"] * 2 * x * x / (2 * n + 1)).alias("sum")))
    near = 1 - 2 / math.sqrt(math.pi) * F.exp(-x * x) * series["sum"]
    tail = F.aggregate(F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1)), F.lit(0.0), lambda acc, k: k / 2 / (x + acc))
    return F.when(x < 2.5, near).otherwise(F.exp(-x * x) / math.sqrt(math.pi) / (x + tail))


def _let(value: Column, then) -> Column:
    """``then(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def profile_deviance(a1: Column, a0: Column, k1: Column, k0: Column, beta: Column) -> Column:
    """Twice the loss of log-likelihood of a 2 x 2 table (all cells positive)
    at log odds ratio ``beta``, the intercept profiled out."""
    total, ones = a1 + a0 + k1 + k0, a1 + k1
    best = (a1 * F.log(a1 / (a1 + a0)) + a0 * F.log(a0 / (a1 + a0)) + k1 * F.log(k1 / (k1 + k0)) + k0 * F.log(k0 / (k1 + k0)))

    # with u = exp(intercept): r (total - ones) u^2 + b u - ones = 0
    def at_ratio(r):
        return _let(a1 + a0 + (k1 + k0) * r - ones * (1 + r), lambda b: _let(
            F.sqrt(b * b + 4 * r * (total - ones) * ones), lambda root: _let(
                F.when(b > 0, 2 * ones / (b + root)).otherwise((root - b) / (2 * r * (total - ones))), lambda u:
                2 * (best + a1 * F.log1p(1 / u) + a0 * F.log1p(u) + k1 * F.log1p(1 / (r * u)) + k0 * F.log1p(r * u)))))
    return _let(F.exp(beta), at_ratio)


def profile_limits(a1: Column, a0: Column, k1: Column, k0: Column, level: float) -> Column:
    """Lower and upper profile-likelihood limit of the odds ratio, as an
    array. The deviance grows away from the estimate and passes the critical
    value well within the bracket. Both sides go through the same bisections."""
    crit = normal_quantile((1.0 + level) / 2.0) ** 2
    beta = F.log(k1 * a0 / (k0 * a1))
    se = F.sqrt(1 / a1 + 1 / a0 + 1 / k1 + 1 / k0)
    brackets = F.array(*[F.struct(beta.alias("inside"), (beta + side * (crit * se + crit + 20)).alias("outside")) for side in (-1, 1)])

    def halve(s, _):
        return _let((s["inside"] + s["outside"]) / 2, lambda mid: _let(
            profile_deviance(a1, a0, k1, k0, mid) < crit, lambda within: F.struct(
                F.when(within, mid).otherwise(s["inside"]).alias("inside"),
                F.when(within, s["outside"]).otherwise(mid).alias("outside"))))

    steps = F.sequence(F.lit(1), F.lit(STEPS))
    return F.transform(brackets, lambda s: F.aggregate(steps, s, halve, lambda e: F.exp((e["inside"] + e["outside"]) / 2)))


def odds_ratio_counts(df: DataFrame, question: str, group_vars_refs: dict[str, str]) -> DataFrame:
    """Counts and closed-form statistics per non-reference level.

    Columns: question, group_var, ref_group, term, a1, a0, k1, k0, estimate,
    se, z, separated. Rows with a NULL outcome or group are dropped per
    variable. A grouping variable with fewer than two levels, or whose
    outcome is not 0/1 (text, other numbers) with both values present, gives
    no rows (see :func:`odds_ratio_skips`). A reference level absent from the
    data raises an error when the plan runs.
    """
    counts, per_var = _level_counts(df, question, group_vars_refs)
    return _level_rows(counts, per_var.where(_skip_reason().isNull()), question)


def odds_ratio_skips(df: DataFrame, question: str, group_vars_refs: dict[str, str]) -> DataFrame:
    """(group_var, reason) of the grouping variables that give no odds ratios."""
    _, per_var = _level_counts(df, question, group_vars_refs)
    asked = df.sparkSession.createDataFrame([(g,) for g in group_vars_refs], "group_var string")
    return (asked.join(per_var, F.col("group_var") == F.col("__gv"), "left")
                 .select("group_var", F.when(F.col("__gv").isNull(), "no rows with outcome and level")
                                       .otherwise(_skip_reason()).alias("reason"))
                 .where(F.col("reason").isNotNull()))


def _skip_reason() -> Column:
    return (F.when(F.col("n_levels") < 2, "fewer than two levels")
             .when(F.col("n_other") > 0, "outcome is not 0/1")
             .when((F.col("n1") == 0) | (F.col("n0") == 0), "outcome has one value only"))


def _level_counts(df: DataFrame, question: str, group_vars_refs: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """Outcome counts per variable and level (stored), and per variable."""
    require_columns(df, [question, *group_vars_refs], "data")
    if not group_vars_refs:
        raise ValueError("group_vars_refs is empty")
    raw = F.col(q(question))
    # text that is no number stays in the table as an outcome that is not 0/1
    y = F.when(raw.isNotNull(), F.coalesce(number(raw), F.lit(-1.0)))
    if dict(df.dtypes)[question] in ("double", "float"):
        y = number(raw)
    recs = F.inline(F.array(*[F.struct(F.lit(g).alias("group_var"),
                                       F.col(q(g)).cast("string").alias("level"))
                              for g in group_vars_refs]))
    long = (df.select(y.alias("y"), recs)
              .where(F.col("y").isNotNull() & F.col("level").isNotNull()))
    counts = (long.groupBy("group_var", "level")
                  .agg(F.sum(F.when(F.col("y") == 1, 1).otherwise(0)).alias("k1"),
                       F.sum(F.when(F.col("y") == 0, 1).otherwise(0)).alias("k0"),
                       F.sum(F.when(~F.col("y").isin(0.0, 1.0), 1).otherwise(0)).alias("other")))
    ref_of = F.create_map(*[x for g, r in group_vars_refs.items() for x in (F.lit(g), F.lit(r))])
    ensure_checkpoint_dir(df.sparkSession)
    # one row per (variable, level): stored once, read by the per-variable
    # checks and by the level rows (a variable may have very many levels, so
    # no window holds a variable's levels in one task)
    counts = counts.withColumn("ref_group", F.element_at(ref_of, F.col("group_var"))) \
                   .checkpoint(eager=True)
    at_ref = F.col("level") == F.col("ref_group")
    per_var = (counts.groupBy(F.col("group_var").alias("__gv"))
                     .agg(F.count(F.lit(1)).alias("n_levels"), F.sum("k1").alias("n1"),
                          F.sum("k0").alias("n0"), F.sum("other").alias("n_other"),
                          F.max(F.when(at_ref, F.col("k1"))).alias("a1"),
                          F.max(F.when(at_ref, F.col("k0"))).alias("a0"))
               )
    return counts, per_var


def _level_rows(counts: DataFrame, per_var: DataFrame, question: str) -> DataFrame:
    rows = (counts.where(F.col("level") != F.col("ref_group"))
                  .join(per_var, F.col("group_var") == F.col("__gv")))
    a1 = F.col("a1").cast("double")
    a0, k1, k0 = F.col("a0").cast("double"), F.col("k1").cast("double"), F.col("k0").cast("double")
    separated = (F.col("a1") == 0) | (F.col("a0") == 0) | (F.col("k1") == 0) | (F.col("k0") == 0)
    checked_a1 = F.when(F.col("a1").isNull(), F.raise_error(F.concat(
        F.lit("reference level "), F.col("ref_group"), F.lit(" not found for "),
        F.col("group_var")))).otherwise(F.col("a1"))
    est = F.when(separated, F.try_divide(k1 * a0, k0 * a1)).otherwise(k1 * a0 / (k0 * a1))
    se = F.when(~separated, F.sqrt(1 / a1 + 1 / a0 + 1 / k1 + 1 / k0))
    return rows.select(
        F.lit(question).alias("question"), "group_var", "ref_group",
        F.concat(F.col("group_var"), F.col("level")).alias("term"),
        checked_a1.cast("long").alias("a1"), F.col("a0").cast("long").alias("a0"),
        F.col("k1").cast("long").alias("k1"), F.col("k0").cast("long").alias("k0"),
        est.alias("estimate"), se.alias("se"),
        F.when(~separated, F.log(est) / se).alias("z"), separated.alias("separated"))


def odds_ratios(df: DataFrame, question: str, group_vars_refs: dict[str, str],
                level: float = 0.95) -> DataFrame:
    """Columns: question, group_var, ref_group, term, estimate, conf_low,
    conf_high, p_value, separated (profile-likelihood limits, Wald p; NULL
    where a cell is empty)."""
    # stored: the limits read plain cells, not the expressions that count them
    c = odds_ratio_counts(df, question, group_vars_refs).checkpoint(eager=True)
    cells = [F.col(n).cast("double") for n in ("a1", "a0", "k1", "k0")]
    c = c.withColumn("limits", F.when(~F.col("separated"), profile_limits(*cells, level)))
    return c.select("question", "group_var", "ref_group", "term", "estimate",
                    F.get("limits", F.lit(0)).alias("conf_low"), F.get("limits", F.lit(1)).alias("conf_high"),
                    F.when(F.col("z").isNotNull(), normal_two_sided(F.col("z"))).alias("p_value"), "separated")
