"""Sample sizes, stratified draws and weight diagnostics (W9, W10, W11)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from ..functions.columns import q, require_columns
from ..functions.joins import lookup_join
from ..functions.stats import normal_quantile
from ..session import ensure_checkpoint_dir

#: A cut above every hash.
EVERY = "g"


def base_sample_size(conf_level: float, margin_of_error: float, prop: float = 0.5) -> float:
    """n0 = z^2 p (1-p) / e^2, the size before the finite-population correction."""
    z = normal_quantile((1.0 + conf_level) / 2.0)
    return z * z * prop * (1.0 - prop) / (margin_of_error * margin_of_error)


def sample_size_expr(N: Column, n0: float) -> Column:
    """ceil(n0 / (1 + (n0 - 1) / N)), never above N."""
    s = F.ceil(F.lit(n0) / (F.lit(1.0) + (F.lit(n0) - F.lit(1.0)) / N.cast("double")))
    return F.least(s, N.cast("long"))


def sample_sizes(df: DataFrame, strata: str, conf_level: float = 0.95,
                 margin_of_error: float = 0.05, prop: float = 0.5) -> DataFrame:
    """Required sample per stratum: (strata, n, sample). A NULL stratum is
    its own stratum."""
    require_columns(df, [strata], "data")
    n0 = base_sample_size(conf_level, margin_of_error, prop)
    return (df.groupBy(F.col(q(strata)).alias(strata)).agg(F.count(F.lit(1)).alias("n"))
              .withColumn("sample", sample_size_expr(F.col("n"), n0)))


def stratified_sample(df: DataFrame, strata: str, key: str, conf_level: float = 0.95,
                      margin_of_error: float = 0.05, prop: float = 0.5,
                      seed: int = 42) -> DataFrame:
    """Exact-size draw without replacement in every stratum.

    Rows are ranked inside their stratum by ``md5(seed:key)`` (then key), so
    the draw is reproducible and does not depend on partitioning; ``key``
    names a row. A stratum's size is known from the size table, so a cut of
    the hash is too: of n rows about s + 4 sqrt(s) + 10 lie below
    ``(s + 4 sqrt(s) + 10) / n`` of its range. Rows above the cut never leave
    their task, whatever the size of the sample and of the stratum. All rows
    below a cut rank before all others, so the draw is exact where at least s
    rows are below; a pass over stratum and key counts them, and strata that
    fall short (4 standard deviations) take all their rows. Every sample is at
    most ceil(n0), a literal known on the driver, so Spark plans
    ``WindowGroupLimit`` for the rank as well. The stratum table is stored
    (one row a stratum). Output: the data columns, ``n``, ``sample`` and
    ``incl`` = true.
    """
    require_columns(df, [strata, key], "data")
    bound = max(1, math.ceil(base_sample_size(conf_level, margin_of_error, prop)))
    ensure_checkpoint_dir(df.sparkSession)
    s = F.col("sample").cast("double")
    share = F.least((s + 4 * F.sqrt(s) + 10) / F.col("n"), F.lit(1.0))
    cut = F.lpad(F.lower(F.hex(F.floor(share * F.lit(float(1 << 48))).cast("long"))), 12, "0")
    sizes = (sample_sizes(df, strata, conf_level, margin_of_error, prop)
             .select(F.col(q(strata)).alias("__s"), "n", "sample", F.when(share < 1, cut).otherwise(EVERY).alias("__cut"))
             .checkpoint(eager=True))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(q(key)).cast("string")))

    def below(rows: DataFrame, sizes: DataFrame) -> DataFrame:
        named = rows.withColumnsRenamed({c: f"__own_{c}" for c in ("n", "sample") if c in rows.columns})
        return lookup_join(named.withColumn("__hash", F.coalesce(digest, F.lit(""))), sizes, [(strata, "__s")]).where("__hash < __cut")

    counted = (below(df.select(q(strata), q(key)) if strata != key else df.select(q(key)), sizes)
               .groupBy("__s").agg(F.count(F.lit(1)).alias("__found")))
    c = counted.withColumnRenamed("__s", "__c")
    sizes = (sizes.join(c, sizes["__s"].eqNullSafe(c["__c"]), "left")
             .withColumn("__cut", F.when(F.coalesce("__found", F.lit(0)) >= F.col("sample"), F.col("__cut")).otherwise(EVERY))
             .select("__s", "n", "sample", "__cut").checkpoint(eager=True))
    order = Window.partitionBy("__s").orderBy("__hash", F.col(q(key)))
    ranked = below(df, sizes).withColumn("__rank", F.row_number().over(order)).where(F.col("__rank") <= bound)
    own = [F.col(q(f"__own_{c}" if c in ("n", "sample") else c)).alias(c) for c in df.columns]
    return (ranked.where(F.col("__rank") <= F.col("sample"))
                  .select(*own, "n", "sample", F.lit(True).alias("incl")))


DIAG_COLUMNS = ["n", "mean_weight", "sd_weight", "cv_weight", "design_effect",
                "effective_n", "margin_of_error_95"]


def weight_diagnostics(df: DataFrame, weights: str, by: str | list[str] | None = None,
                       overall: bool = True) -> DataFrame:
    """Kish design effect of the weights, overall and/or per group.

    cv = sd/mean, n_eff = n/(1+cv^2), deff = n/n_eff,
    margin_of_error_95 = 100 * 1.96 * sqrt(0.25/n_eff). As with a mean that
    does not skip missing values, any NULL weight in a group makes every
    statistic NULL while ``n`` still counts the row. With ``by`` and
    ``overall`` both set, one grouping-sets aggregate gives the overall row
    (group columns NULL) and the per-group rows of each column in one pass.
    ``grouped_by`` then names the column a row is grouped by; it is NULL in the
    overall row alone, which tells that row from a NULL group.
    """
    require_columns(df, [weights], "data")
    if not isinstance(df.schema[weights].dataType, NumericType):
        raise ValueError(f"weights column {weights} is not numeric")
    by = [by] if isinstance(by, str) else list(by or [])
    require_columns(df, by, "data")
    w = F.col(q(weights)).cast("double")
    n_all, n_w = F.count(F.lit(1)), F.count(w)
    aggs = [n_all.alias("n"),
            F.when(n_w == n_all, F.avg(w)).alias("mean_weight"),
            F.when(n_w == n_all, F.stddev_samp(w)).alias("sd_weight")]
    if by and overall:
        sets = [[]] + [[F.col(q(b))] for b in by]
        own = F.coalesce(*[F.when(F.grouping(F.col(q(b))) == 0, F.lit(b)) for b in by])
        grouped = df.groupingSets(sets, *[F.col(q(b)) for b in by]).agg(own.alias("grouped_by"), *aggs)
    elif by:
        grouped = (df.groupBy(*[F.col(q(b)) for b in by]).agg(*aggs)
                   .withColumn("grouped_by", F.lit(", ".join(by))))
    else:
        grouped = df.agg(*aggs)
    cv = F.try_divide(F.col("sd_weight"), F.col("mean_weight"))
    n = F.col("n").cast("double")
    n_eff = n / (F.lit(1.0) + cv * cv)
    return grouped.select(
        *[F.col(q(b)) for b in by], *(["grouped_by"] if by else []), "n", "mean_weight", "sd_weight", cv.alias("cv_weight"),
        (n / n_eff).alias("design_effect"), n_eff.alias("effective_n"),
        (F.lit(1.96) * F.sqrt(F.lit(0.25) / n_eff) * F.lit(100.0)).alias("margin_of_error_95"))
