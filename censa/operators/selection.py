"""Weighted quantiles of many domains by distributed selection.

The median of a domain (cell, group value) and the limits of its interval are
found without sorting its values: a histogram of weights over at most
``buckets`` ranges per domain tells which ranges can hold them, and only the
values inside that window are summed one by one. What lies below or above the
window is one sum per domain and stratum.

The window is safe: with p the share at or below the median, the interval's
half width is ``crit * SE`` and ``SE ** 2 <= f * max(p, 1 - p) ** 2 * sum w ** 2 /
W ** 2`` (f the largest stratum factor), and p is at most the share at the end
of the median's range. All three targets thus lie between the quantiles
``0.5 -/+ crit * bound``. Its values number about the square root of the domain
plus two ranges. While they are more than LIMIT (very skewed values), the
window's domain is cut again, over the window alone; a range of a single value
counts as one value, however many rows have it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..design import H, W
from ..functions.joins import lookup_join
from .cells import at

#: Ranges into which a domain is cut per pass.
BUCKETS = 1024
#: Values of one domain that are summed one by one (a task's window).
LIMIT = 500_000
DOMAIN = ["cid", "gval"]


def _range(y: Column, low: Column, high: Column, buckets: int) -> Column:
    """Number of the range of y in [low, high], rising with y; halves avoid
    an overflow of the width."""
    share = F.try_divide(y * 0.5 - low * 0.5, high * 0.5 - low * 0.5)
    inside = F.least(F.floor(share * buckets), F.lit(buckets - 1)).cast("int")
    return F.when(y <= low, 0).when(y >= high, buckets - 1).otherwise(inside)


def _histogram(rows: DataFrame, low: Column, high: Column, buckets: int) -> DataFrame:
    w, y = F.col(W), F.col("y")
    return (rows.groupBy(*DOMAIN, _range(y, low, high, buckets).alias("bucket"))
            .agg(F.sum(w).alias("ws"), F.sum(w * w).alias("tt"), F.count(F.lit(1)).alias("n"),
                 F.min(y).alias("ylo"), F.max(y).alias("yhi")))


def _windows(hist: DataFrame, spread: Column) -> DataFrame:
    """(cid, gval, lo, hi, below, values, total, squares, spread) per domain:
    the window that holds its targets and the number of values in it.
    ``hist`` has the domain's ``total``, ``squares`` and ``start`` (weight
    below its first range)."""
    by = Window.partitionBy(*DOMAIN).orderBy("bucket")
    h = (hist.withColumn("upto", F.col("start") + F.sum("ws").over(by.rowsBetween(Window.unboundedPreceding, 0)))
         .withColumn("spread", spread))
    total = F.col("total")
    mid = h.groupBy(*DOMAIN).agg(F.min(F.when(F.col("upto") >= 0.500000001 * total, F.col("upto"))).alias("m_upto"),
                                 F.max(total).alias("m_total"), F.max("squares").alias("m_squares"), F.max("spread").alias("m_spread"))
    share = F.least(F.greatest(F.try_divide(F.col("m_upto"), F.col("m_total")), F.lit(0.5)), F.lit(1.0))
    # a domain of zero weight has no shares: its first range is the window
    half = F.coalesce(F.col("m_spread") * share * F.try_divide(F.sqrt("m_squares"), F.col("m_total")), F.lit(1.0))
    half = half * 1.000001 + 1e-9
    mid = mid.select(F.col("cid").alias("m_cid"), F.col("gval").alias("m_gval"),
                     ((F.lit(0.5) - half) * F.col("m_total")).alias("from"), ((F.lit(0.5) + half) * F.col("m_total")).alias("to"))
    h = h.join(mid, (F.col("cid") == F.col("m_cid")) & F.col("gval").eqNullSafe(F.col("m_gval")))
    # the ranges from the first that reaches `from` to the first that reaches `to`
    inside = (F.col("upto") >= F.col("from")) & ((F.col("upto") - F.col("ws") < F.col("to")) | (F.col("bucket") == F.col("first")))
    h = h.withColumn("first", F.min(F.when(F.col("upto") >= F.col("from"), F.col("bucket"))).over(Window.partitionBy(*DOMAIN)))
    return (h.where(inside).groupBy(*DOMAIN)
            .agg(F.min("ylo").alias("lo"), F.max("yhi").alias("hi"), F.min(F.col("upto") - F.col("ws")).alias("below"),
                 F.sum(F.when(F.col("ylo") < F.col("yhi"), F.col("n")).otherwise(1)).alias("values"),
                 F.max("total").alias("total"), F.max("squares").alias("squares"), F.max("spread").alias("spread")))


def _named(stored: DataFrame) -> DataFrame:
    return stored.withColumnsRenamed({"cid": "__cid", "gval": "__gval"})


def within(rows: DataFrame, stored: DataFrame) -> DataFrame:
    """Rows of all domains with their domain's columns from a stored table; the
    overall domain has every row, so rows are not gathered by domain."""
    return lookup_join(rows, _named(stored), [("cid", "__cid"), ("gval", "__gval")]).drop("__cid", "__gval")


def window_sums(rows: DataFrame, ranges: list[tuple[float, float]], spreads: list[float],
                buckets: int = BUCKETS, limit: int = LIMIT) -> DataFrame:
    """Stored sums (cid, gval, stratum, side, y, ws, tt, n) of records
    (stratum, weight, cid, gval, y): ``side`` is -1 below the domain's window,
    0 inside (one row a value) and 1 above. ``ranges`` has the least and
    largest finite y of each cell, ``spreads`` its bound of crit * sqrt(f)."""
    numbers = lambda values: F.array(*[F.lit(float(v)) for v in values])
    cid = F.col("cid")
    spread = at(numbers(spreads), cid)
    low, high = at(numbers([r[0] for r in ranges]), cid), at(numbers([r[1] for r in ranges]), cid)
    hist = _histogram(rows, low, high, buckets).checkpoint()
    whole = Window.partitionBy(*DOMAIN)
    hist = (hist.withColumn("total", F.sum("ws").over(whole)).withColumn("squares", F.sum("tt").over(whole))
            .withColumn("start", F.lit(0.0)))
    windows = _windows(hist, spread).checkpoint()
    wide = windows.where(F.col("values") > limit)
    while not wide.isEmpty():
        # cut these windows again; one that does not get smaller stays as it is
        cut = within(rows, wide.select(*DOMAIN, "lo", "hi", "below", "total", "squares"))
        finer = (_histogram(cut.where((F.col("y") >= F.col("lo")) & (F.col("y") <= F.col("hi"))),
                            F.greatest("lo", low), F.least("hi", high), buckets).checkpoint())
        known = _named(wide.select(*DOMAIN, "total", "squares", F.col("below").alias("start"), F.col("values").alias("before")))
        match = (finer["cid"] == known["__cid"]) & finer["gval"].eqNullSafe(known["__gval"])
        finer = finer.join(known, match).drop("__cid", "__gval")
        before = known.select("__cid", "__gval", "before")
        again = _windows(finer.drop("before"), spread).checkpoint()
        match = (windows["cid"] == again["cid"]) & windows["gval"].eqNullSafe(again["gval"])
        windows = windows.join(again, match, "left_anti").unionByName(again).checkpoint()
        match = (again["cid"] == before["__cid"]) & again["gval"].eqNullSafe(before["__gval"])
        wide = (again.join(before, match).where((F.col("values") > limit) & (F.col("values") <= F.col("before") / 2))
                .drop("__cid", "__gval", "before").checkpoint())
    y = F.col("y")
    side = F.when(y < F.col("lo"), -1).when(y > F.col("hi"), 1).otherwise(0)
    w = F.col(W)
    return (within(rows, windows.select(*DOMAIN, "lo", "hi"))
            .select(*DOMAIN, F.col(H).cast("string").alias(H), W, side.alias("side"), F.when(side == 0, y).alias("y"))
            .groupBy(*DOMAIN, H, "side", "y")
            .agg(F.sum(w).alias("ws"), F.sum(w * w).alias("tt"), F.count(F.lit(1)).alias("n")).checkpoint())
