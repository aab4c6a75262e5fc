"""Helpers shared by the operators of this package.

Python stages run through ``mapInArrow``: Spark cuts a partition into Arrow
batches, and the operators cut those into pieces of a few MB of text before
they allocate working arrays, so memory follows the longest single text and
not the partition.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Text bytes that one Python step works on at a time.
STEP_BYTES = 2 << 20


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def utf8(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of an Arrow string column and the n + 1 offsets of its rows
    (null counts as empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(batch: pa.RecordBatch, column: str = "text", limit: int = STEP_BYTES):
    """Slices of a batch with at most ``limit`` text bytes each, or one row."""
    _, off = utf8(batch.column(column))
    at, n = 0, batch.num_rows
    while at < n:
        to = max(at + 1, int(np.searchsorted(off, off[at] + limit, "right")) - 1)
        yield batch.slice(at, to - at)
        at = to


def binary_array(data: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Arrow binary array whose i-th value is the next ``lengths[i]`` bytes."""
    off = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=off[1:])
    return pa.Array.from_buffers(pa.large_binary(), len(lengths),
                                 [None, pa.py_buffer(off.tobytes()), pa.py_buffer(np.ascontiguousarray(data))])


#: The bytes \x20 and \x09 to \x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_bounds(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends (bytes) of the words ``[^\\x20\\x09-\\x0D]+``, and the
    n + 1 offsets of each row's words."""
    word = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    starts = np.flatnonzero(word & (first[:-1] | np.concatenate([[True], ~word[:-1]])))
    ends = np.flatnonzero(word & (first[1:] | np.concatenate([~word[1:], [True]]))) + 1
    return starts, ends, np.searchsorted(starts, off)


def prefix(flags: np.ndarray) -> np.ndarray:
    """Running sums with a leading zero."""
    out = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=out[1:])
    return out


def covered(n: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Boolean mask of the union of [start, end) spans over n places."""
    step = np.bincount(starts, minlength=n + 1)[:n + 1] - np.bincount(ends, minlength=n + 1)[:n + 1]
    return np.cumsum(step[:n]) > 0


def ascii_lower(text: Column) -> Column:
    """Lower case for A-Z alone."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(doc_id: Column, text: Column) -> Column:
    """Sixteen bytes that name a row by its id and text; only identical rows
    share one."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(":"),
                                  F.coalesce(text, F.lit("")))))
