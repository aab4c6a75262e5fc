"""Interview duration from audit logs (W3).

``interview_duration = coalesce(sum((end - start) / 60000), 0)`` minutes over
the audit events of a submission, after dropping events whose node contains
the excluded pattern (``geo`` by default; a NULL node is dropped too).
Submissions without audit events get NULL. One keyed aggregate and one
left join on ``uuid``.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import q, require_columns


class DurationResult(NamedTuple):
    df_and_duration: DataFrame   # submissions + interview_duration, interview_start
    audit: DataFrame             # audit events kept, with their minutes


def audit_minutes(audit: DataFrame, remove_geo: bool = True,
                  exclude_pattern: str = "geo", key: str = "uuid") -> DataFrame:
    """Audit events kept after the node filter, with ``metadata_duration``
    (minutes) per event."""
    require_columns(audit, [key, "node", "start", "end"], "audit")
    a = audit
    if remove_geo:
        a = a.where(~F.col("node").contains(exclude_pattern))
    return a.withColumn("metadata_duration",
                        (F.col("end") - F.col("start")).cast("double") / F.lit(60000.0))


def interview_duration(submissions: DataFrame, audit: DataFrame, remove_geo: bool = True,
                       exclude_pattern: str = "geo", key: str = "uuid") -> DurationResult:
    """Submissions with ``interview_duration`` (minutes) and
    ``interview_start`` (first event start, ms); existing columns of those
    names are replaced. Joined on ``key`` only."""
    require_columns(submissions, [key], "submissions")
    events = audit_minutes(audit, remove_geo, exclude_pattern, key)
    summary = (events.groupBy(F.col(q(key)).alias(key))
                     .agg(F.coalesce(F.sum("metadata_duration"), F.lit(0.0)).alias("interview_duration"),
                          F.min("start").alias("interview_start")))
    base = submissions.drop("interview_duration", "interview_start")
    out = base.join(summary, base[q(key)] == summary[q(key)], "left").drop(summary[q(key)])
    return DurationResult(out, events)
