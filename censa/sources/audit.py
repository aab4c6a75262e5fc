"""Audit logs of interviews (W3 source).

Each submission has an ``audit.csv`` attachment, or an export holds the logs
of many interviews with their ``instance ID``. The files come from different
form versions, so their headers differ (``old-value`` vs ``old_value``, extra
columns, any order and number). Fields are picked by their position in the
file's header: the first record whose cells include ``node``, ``start`` and
``end``. There is no limit on the number of columns.

``read_audit_csv`` reads files of up to ``split_bytes`` as one row each: cut
into records and cells, quotes observed, nothing joined or shuffled. Larger
files are read by byte ranges, in as many tasks as Spark splits them into
(``split_audit_files``): a range's lines are put together into chunks; a
prefix pass counts the quotes of the chunks before, which tells whether a
chunk starts inside a quoted cell; records that go beyond their chunk are put
together from its end, whole chunks and the next one's start; and the file's
header goes along with its chunks. Both ways give the same rows.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import q, require_columns
from ..functions.joins import lookup_join
from ..session import ensure_checkpoint_dir

AUDIT_COLUMNS = ["file", "node", "start", "end", "old_value", "new_value"]

#: Names of the column that says whose interview a record belongs to.
INSTANCE_COLUMNS = ("instance ID", "instance_id", "instanceID", "uuid")

#: Files of more bytes are read by byte ranges.
SPLIT_BYTES = 64 << 20

#: Bytes of lines that are put together into one chunk.
CHUNK_BYTES = 1 << 20


def normalise_path(c: Column) -> Column:
    """Strip a ``file:`` scheme so lake paths and attachment URLs compare."""
    return F.regexp_replace(c, r"^file:(//)?", "")


# a record: quoted parts (which may hold line breaks) and other characters;
# possessive, so matching neither backtracks nor recurses on long files
_RECORD = r'((?:"(?:[^"]++|"")*+"|[^"\r\n]++)++)'
_CELL = r',((?:"(?:[^"]++|"")*+"|[^",]++)*+)'  # of a record with a comma put in front


def _records(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(_RECORD), F.lit(1))


def _cells(record: Column) -> Column:
    """Cells of a CSV record; an empty cell without quotes is NULL."""
    def plain(cell: Column) -> Column:
        quoted = cell.startswith('"') & cell.endswith('"') & (F.length(cell) > 1)
        return F.when(quoted, F.replace(F.substring(cell, F.lit(2), F.length(cell) - 2), F.lit('""'), F.lit('"'))) \
                .otherwise(F.nullif(cell, F.lit("")))
    return F.transform(F.regexp_extract_all(F.concat(F.lit(","), record), F.lit(_CELL), F.lit(1)), plain)


def _is_header(cells: Column) -> Column:
    return F.coalesce(F.array_contains(cells, "node") & F.array_contains(cells, "start")
                      & F.array_contains(cells, "end"), F.lit(False))


def _picked(rows: DataFrame, instance: bool) -> DataFrame:
    """The audit columns of rows (file, __hdr, __cells)."""
    def pick(name: str) -> Column:
        pos = F.array_position(F.col("__hdr"), name).cast("int")
        return F.when(pos > 0, F.get(F.col("__cells"), pos - 1))

    return rows.select(
        "file", pick("node").alias("node"),
        pick("start").try_cast("bigint").alias("start"),
        pick("end").try_cast("bigint").alias("end"),
        F.coalesce(pick("old_value"), pick("old-value")).alias("old_value"),
        F.coalesce(pick("new_value"), pick("new-value")).alias("new_value"),
        *([F.coalesce(*[pick(c) for c in INSTANCE_COLUMNS]).alias("instance")] if instance else []))


def parse_audit_files(raw: DataFrame, instance: bool = False) -> DataFrame:
    """Audit rows of whole files: ``raw`` has ``value`` (a file's text) and
    ``file``. Works on a batch scan and on a micro-batch of a stream alike.
    A file without a header gives no rows."""
    rows = (raw.select("file", F.transform(_records(F.col("value")), _cells).alias("__all"))
               .withColumn("__hdr", F.get(F.filter("__all", _is_header), 0)).where(F.col("__hdr").isNotNull())
               .select("file", "__hdr", F.explode(F.filter("__all", lambda c: ~_is_header(c))).alias("__cells")))
    return _picked(rows, instance)


def _chunks(lines: DataFrame, chunk_bytes: int) -> DataFrame:
    """(file, block, nth, text): consecutive lines of one byte range, put
    together where Spark reads them. A range's lines come in order, and the
    cuts depend on the lines alone, so a second pass finds the same chunks."""
    def gather(batches):
        at, nth, held, size = None, 0, [], 0

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([nth], pa.int32()), pa.array(["\n".join(held)])],
                ["file", "block", "nth", "text"])

        for b in batches:
            for line, file, block in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and (size >= chunk_bytes or at != (file, block)):
                    yield row()
                    nth, held, size = nth + 1, [], 0
                if at != (file, block):
                    at, nth = (file, block), 0
                held.append(line)
                size += len(line) + 1
        if held:
            yield row()

    return lines.mapInArrow(gather, "file string, block long, nth int, text string")


def split_audit_files(lines: DataFrame, instance: bool = False, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Audit rows of large files from their lines (value, file, block), as read
    by byte ranges; the same rows as :func:`parse_audit_files`. A line of its
    own may not exceed what one Spark string can hold."""
    ensure_checkpoint_dir(lines.sparkSession)
    chunks = _chunks(lines, chunk_bytes)
    key = ["file", "block", "nth"]
    quotes = F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))
    # prefix pass: does a chunk start, and end, inside a quoted cell?
    before = Window.partitionBy("p_file").orderBy("p_block", "p_nth").rowsBetween(Window.unboundedPreceding, 0)
    parity = (chunks.select(*[F.col(c).alias(f"p_{c}") for c in key], (quotes % 2).alias("odd"))
              .withColumn("closes", (F.sum("odd").over(before) % 2).cast("int"))
              .withColumn("opens", ((F.col("closes") + F.col("odd")) % 2).cast("int"))
              .withColumn("no", F.row_number().over(Window.partitionBy("p_file").orderBy("p_block", "p_nth")))
              .drop("odd").checkpoint())
    known = lookup_join(chunks, parity, [(c, f"p_{c}") for c in key])
    # a chunk inside a cell gets the quote (and line break) that opened it, one that ends inside it a closing one
    known = known.withColumns({"opened": F.col("opens") == 1, "closed": F.col("closes") == 1})
    text = F.concat(F.when(F.col("opened"), F.lit('"\n')).otherwise(""), F.col("text"),
                    F.when(F.col("closed"), F.lit('"')).otherwise(""))
    cut = known.select("file", "no", "opened", "closed", _records(text).alias("r"))
    opened, closed, n = F.col("opened"), F.col("closed"), F.size("r")
    whole = F.slice("r", F.when(opened, 2).otherwise(1), F.greatest(n - opened.cast("int") - closed.cast("int"), F.lit(0)))
    inner = cut.select("file", "no", F.lit(0).alias("late"), F.transform(whole, _cells).alias("cells"))

    head, tail = F.get("r", F.lit(0)), F.get("r", n - 1)
    piece = lambda begins, c: F.array(F.struct(F.lit(begins).alias("begins"), c.alias("piece")))
    loose = (F.when(opened & closed & (n == 1), piece(0, F.substr(head, F.lit(3), F.length(head) - 3)))
             .otherwise(F.concat(F.when(opened, piece(0, F.substr(head, F.lit(3)))).otherwise(F.array()),
                                 F.when(closed, piece(1, F.substr(tail, F.lit(1), F.length(tail) - 1))).otherwise(F.array()))))
    # records beyond one chunk: the piece that begins one and those up to the next beginning
    pieces = cut.select("file", "no", F.posexplode(loose).alias("at", "p")).select("file", "no", "at", "p.begins", "p.piece")
    order = Window.partitionBy("file").orderBy("no", "at").rowsBetween(Window.unboundedPreceding, 0)
    joined = (pieces.withColumn("record", F.sum("begins").over(order)).groupBy("file", "record")
              .agg(F.min("no").alias("no"), F.sort_array(F.collect_list(F.struct("no", "at", "piece"))).alias("p"))
              .select("file", "no", F.lit(1).alias("late"),
                      F.transform(_records(F.array_join("p.piece", "\n")), _cells).alias("cells")))
    every = inner.unionByName(joined)
    first = F.get(F.filter("cells", _is_header), 0)
    headers = (every.select(F.col("file").alias("h_file"), first.alias("header"), "no", "late").where(F.col("header").isNotNull())
               .groupBy("h_file").agg(F.min_by("header", F.struct("no", "late")).alias("__hdr")).checkpoint())
    rows = (lookup_join(every, headers, [("file", "h_file")])
            .select("file", "__hdr", F.explode(F.filter("cells", lambda c: ~_is_header(c))).alias("__cells")))
    return _picked(rows, instance)


def read_audit_csv(spark: SparkSession, paths, instance: bool = False, split_bytes: int = SPLIT_BYTES,
                   chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Audit rows of many files: file, node, start (ms), end (ms),
    old_value, new_value (hyphenated header names are folded in), and with
    ``instance`` the interview named by the record (INSTANCE_COLUMNS)."""
    paths = [paths] if isinstance(paths, str) else list(paths)
    file, size = normalise_path(F.col("_metadata.file_path")).alias("file"), F.col("_metadata.file_size")
    large = spark.read.format("binaryFile").load(paths).where(F.col("length") > split_bytes).select("length")
    small = spark.read.text(paths, wholetext=True)
    if large.isEmpty():
        return parse_audit_files(small.select("value", file), instance)
    lines = (spark.read.option("lineSep", "\n").text(paths).where(size > split_bytes)
             .select("value", file, F.col("_metadata.file_block_start").alias("block")))
    return (parse_audit_files(small.where(size <= split_bytes).select("value", file), instance)
            .unionByName(split_audit_files(lines, instance, chunk_bytes)))


def audit_attachments(submissions: DataFrame, key: str = "uuid",
                      url_field: str = "download_url",
                      basename: str = "audit.csv") -> DataFrame:
    """(uuid, file) of each submission's audit attachment; submissions
    without attachments produce nothing."""
    require_columns(submissions, [key, "_attachments"], "submissions")
    att = submissions.select(F.col(q(key)).alias(key), F.explode("_attachments").alias("a"))
    return (att.where(F.col("a.media_file_basename") == basename)
               .select(key, normalise_path(F.col(f"a.{url_field}")).alias("file")))


def audit_log(submissions: DataFrame, audit_rows: DataFrame, key: str = "uuid",
              url_field: str = "download_url") -> DataFrame:
    """Audit rows tagged with the submission they belong to."""
    files = audit_attachments(submissions, key, url_field)
    return audit_rows.join(files, "file").select(key, *[c for c in AUDIT_COLUMNS])
