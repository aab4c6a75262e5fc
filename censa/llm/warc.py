"""WARC archives in seekable Zstandard bundles (operator 13).

``write_archives`` turns a table of pages into WARC 1.1 records, gives equal
payloads one response record (the others are revisit records that refer to
it), and writes the records to bundle files. ``read_archives`` reads every
record of the bundles back, ``lookup`` single ones by identifier.

Method: records are grouped into frames of about FRAME_BYTES, each compressed
on its own, so that any of them can be read alone. A bundle ends with a seek
table in a skippable frame (the seekable format of Zstandard: compressed size,
size and checksum of each frame, then the footer with their number); ordinary
readers of Zstandard skip it and see one long WARC file. The index table maps a
record's identifier to its file, frame, and offset and length within the frame.

On Spark: digests are computed in one scan, which leaves narrow rows (equal
rows of a task are one row with a count). The response of a digest is a grouped
maximum. Its payload is any one of the group, kept by an aggregate that
combines on the map side: copies do not travel. Revisits carry no payload; they
find their response by digest, the copies of a very common payload by a
broadcast table (one of at most HOT digests, see ``with_response``). Tasks
write their own bundles and return the index rows, which Spark commits with the
index table: a file of a task that was lost or ran twice is in no index row,
and nothing reads it. Reading spreads the frames, not the files, over tasks.

The folder must be one that all executors see, without an index yet; it may be
a path or a URI that Arrow's file systems know (file, hdfs, s3, gs). URLs are
percent-encoded where a WARC header needs it.

Edge rules: a null html is an empty payload. Of equal payloads of at least
``min_bytes`` bytes that with the largest page_id is the response (null is the
smallest; of several such rows one, by url); smaller payloads are all responses.
A repeated row is a record of its own. A null url gives no WARC-Target-URI. An
empty table writes no bundles and reads back as no rows. Columns other than
page_id, url and html are not read. A damaged frame or payload raises an error.
"""

from __future__ import annotations

import base64
import hashlib
import posixpath
import re
import struct
from urllib.parse import quote
from uuid import uuid4

import pyarrow as pa
import pyarrow.fs as pafs
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .common import pieces

#: Record bytes after which a frame is closed, and bundle bytes after which a file is.
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
LEVEL = 3
#: Digests that are looked up by a broadcast table, at most.
HOT = 50_000
#: Date of all records, unless another is given.
DATE = "2026-01-01T00:00:00Z"
MIN_BYTES = 0

# fixed values of the seekable Zstandard format
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
CHECKSUMS = 0x80
FOOTER, FOOTER_SIZE = "<IBI", 9
ENTRY, ENTRY_SIZE = "<III", 12
HEAD, HEAD_SIZE = "<II", 8

INDEX = ("record_id string, page_id long, file string, frame int, frame_start long, frame_bytes long, "
         "record_offset long, record_bytes long")
RECORD = ("record_id string, page_id long, url string, record_type string, payload_bytes long, "
          "payload_digest string, refers_to long, payload binary")
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def file_system(path: str) -> tuple[pafs.FileSystem, str]:
    """Arrow's file system and path of a folder or file."""
    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    if path.startswith("/"):
        return pafs.LocalFileSystem(), path
    return pafs.FileSystem.from_uri(path)


# ---------------------------------------------------------------- records

def digest_text(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_bytes(record_id: str, url: str | None, digest: bytes, size: int, payload: bytes | None,
                 refers_to: str | None, date: str) -> bytes:
    """One WARC record. The payload's size is an extension field: a revisit's
    block ends with the HTTP header."""
    block = HTTP + (payload or b"")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers_to else 'response'}", f"WARC-Record-ID: <{record_id}>",
            f"WARC-Date: {date}", *([f"WARC-Target-URI: {quote(url, safe=';/?:@&=+$,#%[]!*()~')}"] if url is not None else []),
            f"WARC-Payload-Digest: sha1:{digest_text(digest)}", f"WARC-Block-Digest: sha1:{digest_text(hashlib.sha1(block).digest())}",
            f"X-Payload-Length: {size}", "Content-Type: application/http; msgtype=response"]
    if refers_to:
        head += [f"WARC-Refers-To: <{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_records(data: bytes):
    """(offset, length, fields, block) of the records in ``data``."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        version, *lines = data[at:end].decode().split("\r\n")
        if version != "WARC/1.1":
            raise ValueError(f"no WARC record at {at}: {version[:40]!r}")
        fields = {k.lower(): v for k, v in (x.split(": ", 1) for x in lines)}
        start = end + 4
        stop = start + int(fields["content-length"])
        if data[stop:stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} does not end where its length says")
        yield at, stop + 4 - at, fields, data[start:stop]
        at = stop + 4


PAGE = re.compile(r"<urn:page:(-?\d+|null):")


def page_of(field: str | None) -> int | None:
    number = PAGE.match(field)[1] if field else "null"
    return None if number == "null" else int(number)


def record_row(fields: dict, block: bytes) -> tuple:
    """The ``RECORD`` row of a record; a response's payload is checked."""
    kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
    if fields["warc-block-digest"] != "sha1:" + digest_text(hashlib.sha1(block).digest()):
        raise ValueError(f"{fields['warc-record-id']}: the block does not match its digest")
    payload = block[block.index(b"\r\n\r\n") + 4:] if kind == "response" else None
    size = int(fields["x-payload-length"])
    if payload is not None and (len(payload) != size or digest_text(hashlib.sha1(payload).digest()) != digest):
        raise ValueError(f"{fields['warc-record-id']}: the payload does not match its digest")
    own = fields["warc-record-id"]
    return (own.strip("<>"), page_of(own), fields.get("warc-target-uri"), kind, size, digest,
            page_of(fields.get("warc-refers-to")), payload)


# ---------------------------------------------------------------- bundles

class Bundle:
    """Writes one bundle file. ``add`` takes records and returns index rows of
    the frames that got closed."""

    def __init__(self, folder: str, name: str, frame_bytes: int):
        self.name, self.frame_bytes = name, frame_bytes
        self.fs, base = file_system(folder)
        self.out = self.fs.open_output_stream(posixpath.join(base, name), compression=None)
        self.zstd = zstandard.ZstdCompressor(level=LEVEL, write_content_size=True)
        self.table: list[tuple[int, int, int]] = []
        self.size, self.held, self.waiting = 0, bytearray(), []

    def add(self, record_id: str, page_id: int | None, record: bytes) -> list[tuple]:
        self.waiting.append((record_id, page_id, len(self.held), len(record)))
        self.held += record
        return self.close_frame() if len(self.held) >= self.frame_bytes else []

    def close_frame(self) -> list[tuple]:
        if not self.waiting:
            return []
        data = bytes(self.held)
        packed = self.zstd.compress(data)
        self.out.write(packed)
        rows = [(record_id, page_id, self.name, len(self.table), self.size, len(packed), offset, length)
                for record_id, page_id, offset, length in self.waiting]
        self.table.append((len(packed), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))
        self.size += len(packed)
        self.held, self.waiting = bytearray(), []
        return rows

    def close(self) -> list[tuple]:
        rows = self.close_frame()
        table = b"".join(struct.pack(ENTRY, *e) for e in self.table) + struct.pack(FOOTER, len(self.table), CHECKSUMS, SEEKABLE)
        self.out.write(struct.pack(HEAD, SKIPPABLE, len(table)) + table)
        self.out.close()
        return rows


def seek_table(folder: str, name: str) -> list[tuple[int, int, int, int, int]]:
    """(frame, start, compressed size, size, checksum) of a bundle's frames,
    from its footer alone."""
    fs, base = file_system(folder)
    with fs.open_input_file(posixpath.join(base, name)) as f:
        end = f.size()
        count, descriptor, magic = struct.unpack(FOOTER, f.read_at(FOOTER_SIZE, end - FOOTER_SIZE))
        if magic != SEEKABLE or descriptor != CHECKSUMS:
            raise ValueError(f"{name} does not end with a seek table")
        size = count * ENTRY_SIZE + FOOTER_SIZE
        head = struct.unpack(HEAD, f.read_at(HEAD_SIZE, end - size - HEAD_SIZE))
        if head != (SKIPPABLE, size):
            raise ValueError(f"{name}: the seek table is damaged")
        raw = f.read_at(count * ENTRY_SIZE, end - size)
    out, start = [], 0
    for frame, (packed, plain, check) in enumerate(struct.iter_unpack(ENTRY, raw)):
        out.append((frame, start, packed, plain, check))
        start += packed
    return out


class Frames:
    """Reads frames; keeps the file last used open."""

    def __init__(self, folder: str):
        self.fs, self.base = file_system(folder)
        self.name, self.file = None, None
        self.zstd = zstandard.ZstdDecompressor()

    def read(self, name: str, start: int, packed: int, check: int | None = None) -> bytes:
        if name != self.name:
            self.close()
            self.file, self.name = self.fs.open_input_file(posixpath.join(self.base, name)), name
        data = self.zstd.decompress(self.file.read_at(packed, start))
        if check is not None and xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"{name}: the frame at {start} does not match its checksum")
        return data

    def close(self) -> None:
        if self.file is not None:
            self.file.close()
        self.file = self.name = None


# ---------------------------------------------------------------- Spark

ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}


def batch_of(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(c.split() for c in schema.split(", ")), strict=True)
    columns = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, ARROW[k]) for c, k in zip(columns, kinds, strict=True)], names)


def record_id(page_id: Column, url: Column, digest: Column, task: Column, copy: Column) -> Column:
    """``urn:page:<page_id>:<hash>``, another one for every record."""
    text = lambda c: F.coalesce(c.cast("string"), F.lit("null"))
    mark = F.md5(F.concat_ws("|", text(task), text(copy), F.hex(digest), F.when(url.isNull(), "-").otherwise(F.concat(F.lit("+"), url))))
    return F.concat(F.lit("urn:page:"), text(page_id), F.lit(":"), mark)


def described(pages: DataFrame) -> DataFrame:
    """(page_id, url, digest, size, task, n): pages without their payload,
    equal ones of a task as one row."""
    payload = F.coalesce(F.col("html"), F.lit(""))
    return (pages.select(F.col("page_id").cast("long"), "url", F.unhex(F.sha1(payload)).alias("digest"),
                         F.octet_length(payload).cast("long").alias("size"), F.spark_partition_id().alias("task"))
            .groupBy("page_id", "url", "digest", "size", "task").agg(F.count("*").alias("n")))


def with_response(rows: DataFrame, best: DataFrame) -> DataFrame:
    """``rows`` joined with the response (``to_id``, ``to_record``) of their
    digest. Digests of more than 1 / HOT of all rows, of which there are fewer
    than HOT, are looked up in a broadcast table where the rows lie; no other
    digest has more rows than that in one task."""
    several = best.where("rows > 1")
    bar = (best.agg(F.sum("rows")).first()[0] or 0) // HOT  # fewer than HOT digests have more rows than this
    hot = F.broadcast(several.where(F.col("rows") > bar).withColumn("is_hot", F.lit(True)))
    marked = rows.join(hot, rows["digest"] == hot["to_digest"], "left").drop("to_digest", "rows")
    found = marked.where("is_hot").drop("is_hot")
    others = marked.where("is_hot is null").select(*rows.columns)
    cold = several.where(F.col("rows") <= bar)
    return found.unionByName(others.join(cold, others["digest"] == cold["to_digest"]).drop("to_digest", "rows"))


def records(pages: DataFrame, min_bytes: int = MIN_BYTES) -> DataFrame:
    """(record_id, page_id, url, digest, size, payload, refers_to): one row
    per record to write; revisits have no payload."""
    ensure_checkpoint_dir(pages.sparkSession)
    rows = described(pages).checkpoint()
    shared = rows.where(F.col("size") >= min_bytes)
    top = F.struct("page_id", "url", "task")
    best = shared.groupBy(F.col("digest").alias("to_digest")).agg(F.max(top).alias("top"), F.sum("n").alias("rows"))
    named = lambda t, digest: record_id(t["page_id"], t["url"], digest, t["task"], F.lit(0))
    best = best.select("to_digest", "top", "rows").checkpoint()

    payload = F.coalesce(F.col("html"), F.lit(""))
    bodies = (pages.select(F.unhex(F.sha1(payload)).alias("digest"), payload.alias("payload"))
              .where(F.octet_length("payload") >= min_bytes).groupBy("digest").agg(F.any_value("payload").alias("payload")))
    responses = (bodies.join(best, F.col("digest") == F.col("to_digest"))
                 .select(named(F.col("top"), F.col("digest")).alias("record_id"), F.col("top.page_id").alias("page_id"),
                         F.col("top.url").alias("url"), "digest", F.octet_length("payload").cast("long").alias("size"),
                         "payload", F.lit(None).cast("string").alias("refers_to")))

    targets = best.select("to_digest", "rows", F.col("top.page_id").alias("to_id"), F.col("top.url").alias("to_url"),
                          F.col("top.task").alias("to_task"), named(F.col("top"), F.col("to_digest")).alias("to_record"))
    linked = with_response(shared, targets)
    is_top = (F.col("page_id").eqNullSafe(F.col("to_id")) & F.col("url").eqNullSafe(F.col("to_url"))
              & (F.col("task") == F.col("to_task")))
    # copy 0 of the response's own row is the response
    copies = F.sequence(F.when(is_top, 1).otherwise(0).cast("long"), F.col("n") - 1)
    revisits = (linked.where(~is_top | (F.col("n") > 1))
                .select("page_id", "url", "digest", "size", "task", "to_record", F.explode(copies).alias("copy"))
                .select(record_id(F.col("page_id"), F.col("url"), F.col("digest"), F.col("task"), F.col("copy")).alias("record_id"),
                        "page_id", "url", "digest", "size", F.lit(None).cast("string").alias("payload"),
                        F.col("to_record").alias("refers_to")))
    out = responses.unionByName(revisits)
    if min_bytes > 0:
        small = (pages.select(F.col("page_id").cast("long"), "url", F.unhex(F.sha1(payload)).alias("digest"),
                              payload.alias("payload"), F.monotonically_increasing_id().alias("copy"))
                 .where(F.octet_length("payload") < min_bytes)
                 .select(record_id(F.col("page_id"), F.col("url"), F.col("digest"), F.lit(-1), F.col("copy")).alias("record_id"),
                         "page_id", "url", "digest", F.octet_length("payload").cast("long").alias("size"), "payload",
                         F.lit(None).cast("string").alias("refers_to")))
        out = out.unionByName(small)
    return out


def write_archives(pages: DataFrame, folder: str, min_bytes: int = MIN_BYTES, frame_bytes: int = FRAME_BYTES,
                   bundle_bytes: int = BUNDLE_BYTES, date: str = DATE) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to bundles in ``folder`` and their
    index to ``folder``/index; the index table (``INDEX``) is returned."""
    spark = pages.sparkSession
    index = posixpath.join(folder, "index")

    def write(batches):
        bundle = None
        for whole in batches:
            for b in pieces(whole, "payload", frame_bytes):
                done = []
                for r in b.to_pylist():
                    if bundle is None:
                        bundle = Bundle(folder, f"part-{uuid4().hex}.warc.zst", frame_bytes)
                    body = None if r["payload"] is None else r["payload"].encode()
                    done += bundle.add(r["record_id"], r["page_id"], record_bytes(
                        r["record_id"], r["url"], r["digest"], r["size"], body, r["refers_to"], date))
                    if bundle.size >= bundle_bytes:
                        done += bundle.close()
                        bundle = None
                if done:
                    yield batch_of(INDEX, done)
        if bundle is not None:
            yield batch_of(INDEX, bundle.close())

    fs, base = file_system(folder)
    fs.create_dir(base, recursive=True)
    records(pages, min_bytes).mapInArrow(write, INDEX).write.parquet(index)
    return spark.read.parquet(index)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """Every record (``RECORD``) of the committed bundles: frames are found by
    the bundles' own seek tables, dealt over the tasks, checked and parsed.
    Without ``payloads`` these are checked but not handed on."""
    def frames(batches):
        for b in batches:
            for name in b.column("file").to_pylist():
                found = seek_table(folder, name)
                yield pa.RecordBatch.from_pydict({
                    "file": [name] * len(found), "start": pa.array([f[1] for f in found], pa.int64()),
                    "packed": pa.array([f[2] for f in found], pa.int64()), "check": pa.array([f[4] for f in found], pa.int64())})

    def parse(batches):
        source = Frames(folder)
        for b in batches:
            for r in b.to_pylist():
                data = source.read(r["file"], r["start"], r["packed"], r["check"])
                rows = [record_row(fields, block) for _, _, fields, block in parse_records(data)]
                yield batch_of(RECORD, rows if payloads else [(*row[:-1], None) for row in rows])
        source.close()

    files = spark.read.parquet(posixpath.join(folder, "index")).select("file").distinct()
    return (files.mapInArrow(frames, "file string, start long, packed long, check long")
            .repartition("file", "start").mapInArrow(parse, RECORD))


def lookup(spark: SparkSession, folder: str, wanted: DataFrame) -> DataFrame:
    """The records (``RECORD``) whose ``record_id`` is in ``wanted``: only their
    frames are read, each once a task, and the record cut out at its offset."""
    def fetch(batches):
        source, at, data = Frames(folder), None, b""
        for b in batches:
            out = []
            for r in b.to_pylist():
                if (r["file"], r["frame_start"]) != at:
                    at = r["file"], r["frame_start"]
                    data = source.read(r["file"], r["frame_start"], r["frame_bytes"])
                _, _, fields, block = next(parse_records(data[r["record_offset"]:r["record_offset"] + r["record_bytes"]]))
                out.append(record_row(fields, block))
            yield batch_of(RECORD, out)
        source.close()

    index = spark.read.parquet(posixpath.join(folder, "index"))
    return (index.join(wanted.select("record_id").distinct(), "record_id", "left_semi")
            .repartition("file", "frame").sortWithinPartitions("file", "frame_start", "record_offset")
            .mapInArrow(fetch, RECORD))


def remove_archives(folder: str) -> None:
    """Delete a folder of bundles with its index."""
    fs, base = file_system(folder)
    fs.delete_dir(base)
