"""Joins of data-sized rows to stored, usually small tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .columns import q

#: Rows up to which a stored table is broadcast (its size is counted first).
BROADCAST_ROWS = 100_000


def lookup_join(rows: DataFrame, stored: DataFrame, on: list[tuple[str, str]], how: str = "inner",
                bound: int = BROADCAST_ROWS, salts: int = 32) -> DataFrame:
    """``rows`` with the columns of ``stored`` (a checkpoint or table), NULL
    keys equal, without gathering all rows of a key in one task: a table of at
    most ``bound`` rows is broadcast; beyond it the rows of a key are spread
    over ``salts`` tasks and the table is repeated for each. ``how`` is inner
    or left. ``on`` pairs column names of the two, which must be different."""
    match = [rows[q(a)].eqNullSafe(stored[q(b)]) for a, b in on]
    if stored.limit(bound + 1).count() <= bound:
        return rows.join(F.broadcast(stored), match, how)
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(*[F.col(q(c)) for c in rows.columns]), F.lit(salts)))
    copies = stored.withColumn("__copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    match = [salted[q(a)].eqNullSafe(copies[q(b)]) for a, b in on] + [F.col("__salt") == F.col("__copy")]
    return salted.join(copies, match, how).drop("__salt", "__copy")
