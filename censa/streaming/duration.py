"""Interview durations kept up to date while audit files keep arriving.

Audit files land in a folder as interviews are uploaded. A file-source
stream picks up new files; each micro-batch parses them with the batch
header logic (a file is read whole, so header and rows share a batch) and
writes per-file minutes to ``{output}/batch_id=<id>``, overwriting that one
folder, so a retried batch replaces its own output instead of duplicating
it. :func:`durations_from_parts` then sums the parts per submission with a
plain grouped aggregate. Progress is kept in ``checkpoint_location`` (a
shared folder), so a restarted query resumes after the last committed batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.duration import audit_minutes
from ..sources.audit import audit_attachments, normalise_path, parse_audit_files


def audit_file_stream(spark: SparkSession, audit_dir: str,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.text(audit_dir, wholetext=True).select(
        "value", normalise_path(F.col("_metadata.file_path")).alias("file"))


def start_duration_stream(spark: SparkSession, audit_dir: str, output: str,
                          checkpoint_location: str, remove_geo: bool = True,
                          exclude_pattern: str = "geo",
                          available_now: bool = True) -> StreamingQuery:
    """Start the stream; ``available_now`` processes what is there and stops."""
    out = output.rstrip("/")

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        rows = parse_audit_files(batch)
        per_file = (audit_minutes(rows, remove_geo, exclude_pattern, key="file")
                    .groupBy("file")
                    .agg(F.sum("metadata_duration").alias("minutes"),
                         F.min("start").alias("first_start"), F.count(F.lit(1)).alias("events")))
        per_file.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")

    writer = (audit_file_stream(spark, audit_dir).writeStream
              .foreachBatch(write_batch).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()


def durations_from_parts(spark: SparkSession, output: str, submissions: DataFrame,
                         key: str = "uuid") -> DataFrame:
    """Submissions with interview_duration / interview_start from the parts
    written so far (same definition as the batch operator)."""
    parts = spark.read.parquet(output)
    files = audit_attachments(submissions, key)
    per_sub = (parts.join(files, "file").groupBy(key)
                    .agg(F.coalesce(F.sum("minutes"), F.lit(0.0)).alias("interview_duration"),
                         F.min("first_start").alias("interview_start")))
    base = submissions.drop("interview_duration", "interview_start")
    return base.join(per_sub, key, "left")
