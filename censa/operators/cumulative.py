"""Distributed running sum ordered within groups.

A plain ``sum().over(partitionBy(keys).orderBy(x))`` puts a whole group into
one task; for the overall domain of a continuous variable that group can hold
billions of distinct values. Here the table is range-partitioned on
``(keys, x)`` (balanced by Spark's sampling), each range keeps its own running
sum, and per-range totals (at most partitions x groups rows) give the offsets.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir


class RunningSum(NamedTuple):
    rows: DataFrame     # input columns + the running sum
    totals: DataFrame   # per group: __total (= last running sum), __count, __max_order


def running_sum(df: DataFrame, keys: list[str], order: str, value: str,
                out: str = "__cum", partitions: int | None = None,
                count: str | None = None) -> RunningSum:
    """Add ``out`` = sum of ``value`` over rows of the same ``keys`` with
    ``order`` less than or equal to this row's. ``order`` must be unique
    within ``keys`` (aggregate to distinct values first).

    One branch computes, per range partition and group, the running sum and
    the range totals with a single window; that table is checkpointed. The
    offsets (sum of earlier ranges' totals, at most partitions x groups rows)
    are then joined back, so later scans only repeat that small join. The
    per-group totals (last running sum, sum of ``count``, largest ``order``)
    come from the same small table, without another pass over the rows."""
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ensure_checkpoint_dir(spark)
    within = Window.partitionBy("__pid", *keys)
    cnt = F.col(count) if count else F.lit(1)
    local = (df.repartitionByRange(partitions, *keys, order)
               .withColumn("__pid", F.spark_partition_id())
               .withColumn("__local", F.sum(value).over(
                   within.orderBy(order).rowsBetween(Window.unboundedPreceding,
                                                     Window.currentRow)))
               .withColumn("__ptot", F.sum(value).over(within))
               .withColumn("__pcnt", F.sum(cnt).over(within))
               .withColumn("__pmax", F.max(order).over(within))
               .checkpoint(eager=True))
    totals = local.groupBy(*keys, "__pid").agg(F.max("__ptot").alias("__ptot"),
                                                F.max("__pcnt").alias("__pcnt"),
                                                F.max("__pmax").alias("__pmax"))
    offsets = totals.withColumn(
        "__off", F.coalesce(F.sum("__ptot").over(
            Window.partitionBy(*keys).orderBy("__pid")
            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
    joined = local.join(offsets.select(*[offsets[k].alias(f"__o_{k}") for k in keys],
                                       offsets["__pid"].alias("__o_pid"), "__off"),
                        [local["__pid"] == F.col("__o_pid")]
                        + [local[k].eqNullSafe(F.col(f"__o_{k}")) for k in keys])
    rows = joined.select(*df.columns, (F.col("__off") + F.col("__local")).alias(out))
    # the last range's offset + total is exactly the last running sum
    group_totals = offsets.groupBy(*keys).agg(
        F.max(F.col("__off") + F.col("__ptot")).alias("__total"),
        F.sum("__pcnt").alias("__count"), F.max("__pmax").alias("__max_order"))
    return RunningSum(rows, group_totals)
