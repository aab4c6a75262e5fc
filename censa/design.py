"""Survey design: strata and weights columns, every row its own sampling unit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .functions.columns import number, q, require_columns

# Internal column names used by the estimators.
H = "__stratum"
W = "__weight"


@dataclass(frozen=True)
class SurveyDesign:
    """Stratified design without cluster ids (each row is its own PSU).

    ``strata`` / ``weights`` name columns of the data; either may be None
    (one stratum / unit weights). ``lonely`` decides what a stratum with a
    single row does to variances: ``'fail'`` raises, ``'skip'`` adds zero.
    """

    strata: str | None = None
    weights: str | None = None
    lonely: str = "fail"

    def __post_init__(self):
        if self.lonely not in ("fail", "skip"):
            raise ValueError("lonely must be 'fail' or 'skip'")

    def stratum_col(self) -> Column:
        return F.col(q(self.strata)) if self.strata else F.lit(None).cast("string")

    def weight_col(self) -> Column:
        # text that is not a number, and NaN, count as missing
        return number(F.col(q(self.weights))) if self.weights else F.lit(1.0)

    def check(self, df: DataFrame) -> None:
        require_columns(df, [c for c in (self.strata, self.weights) if c], "data")


@dataclass(frozen=True)
class DesignInfo:
    n: int
    n_strata: int
    lonely_strata: int
    null_weights: int
    negative_weights: int = 0

    @property
    def df(self) -> int:
        """Degrees of freedom of the full design: units minus strata."""
        return self.n - self.n_strata


def design_table(df: DataFrame, design: SurveyDesign, center_cols=(), range_cols=()):
    """Per-stratum design table, written once, and the design summary.

    One grouped aggregate by stratum gives the full-design size ``n_h`` (with
    the variance factors ``__f = n_h/(n_h-1)``, ``__g = 1/(n_h-1)``; a
    stratum of one row gets 0, i.e. ``lonely='skip'``), the count of NULL or
    non-numeric weights, sums for centring ``center_cols``, and the least and
    largest finite value of ``range_cols``. The table
    (one row per stratum) is checkpointed to ``spark.checkpoint.dir`` so the
    summary job and the estimation plan read it without rescanning the
    data. Returns (DesignInfo, centres, sizes DataFrame, ranges).
    """
    from .session import ensure_checkpoint_dir
    design.check(df)
    require_columns(df, [*center_cols, *range_cols], "data")
    per_h_aggs = [F.count(F.lit(1)).alias("n_h"),
                  F.sum(F.when(F.col(W).isNull(), 1).otherwise(0)).alias("nw"),
                  F.sum(F.when(F.col(W) < 0, 1).otherwise(0)).alias("neg")]
    tot_aggs = []
    for i, c in enumerate(center_cols):
        x = number(F.col(q(c)))
        per_h_aggs += [F.sum(x).alias(f"s{i}"), F.count(x).alias(f"c{i}")]
        tot_aggs += [F.sum(f"s{i}").alias(f"s{i}"), F.sum(f"c{i}").alias(f"c{i}")]
    for i, c in enumerate(range_cols):
        x = number(F.col(q(c)))
        finite = F.when(F.abs(x) < float("inf"), x)
        per_h_aggs += [F.min(finite).alias(f"lo{i}"), F.max(finite).alias(f"hi{i}")]
        tot_aggs += [F.min(f"lo{i}").alias(f"lo{i}"), F.max(f"hi{i}").alias(f"hi{i}")]
    ensure_checkpoint_dir(df.sparkSession)
    n_h = F.col("n_h")
    per_h = (df.select(design.stratum_col().alias(H), design.weight_col().alias(W),
                       *[F.col(q(c)) for c in dict.fromkeys([*center_cols, *range_cols])])
               .groupBy(H).agg(*per_h_aggs)
               .withColumn("__f", F.when(n_h > 1, n_h / (n_h - 1)).otherwise(0.0))
               .withColumn("__g", F.when(n_h > 1, 1.0 / (n_h - 1)).otherwise(0.0))
               .checkpoint(eager=True))
    row = per_h.agg(F.count(F.lit(1)).alias("H"), F.sum("n_h").alias("n"),
                    F.sum(F.when(F.col("n_h") == 1, 1).otherwise(0)).alias("lonely"),
                    F.sum("nw").alias("nw"), F.sum("neg").alias("neg"), *tot_aggs).first()
    centres = {}
    for i, c in enumerate(center_cols):
        s_, k = row[f"s{i}"], row[f"c{i}"]
        centres[c] = float(s_) / k if k else 0.0
    info = DesignInfo(int(row["n"] or 0), int(row["H"] or 0), int(row["lonely"] or 0),
                      int(row["nw"] or 0), int(row["neg"] or 0))
    ranges = {c: (row[f"lo{i}"] or 0.0, row[f"hi{i}"] or 0.0) for i, c in enumerate(range_cols)}
    return info, centres, per_h.select(H, "n_h", "__f", "__g"), ranges


def design_info(df: DataFrame, design: SurveyDesign,
                center_cols=()) -> tuple[DesignInfo, dict[str, float]]:
    """Design summary only (see :func:`design_table`)."""
    info, centres, *_ = design_table(df, design, center_cols)
    return info, centres


def prepared(df: DataFrame, design: SurveyDesign, columns) -> DataFrame:
    """Project the data to stratum, weight and the needed columns."""
    cols = list(dict.fromkeys(columns))
    return df.select(design.stratum_col().alias(H), design.weight_col().alias(W),
                     *[F.col(q(c)) for c in cols])
