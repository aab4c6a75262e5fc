"""Byte-level BPE encoding and decoding in overlapping chunks (operator 10).

A text of up to ``chunk`` bytes is pre-tokenised and encoded where it lies.
A longer one is cut into chunks that overlap; the chunks go to different tasks
and are pre-tokenised there. A match of the pattern depends only on what
follows its start, so where two neighbouring chunks both have a pre-token
boundary, the right one is in step with the whole text: the chunks are
stitched at the first such place of each overlap. If an overlap has none (one
pre-token longer than the overlap), the two chunks are pre-tokenised again as
one. The pieces are then encoded one by one, and decoding concatenates the raw
bytes of the ids.

Edge rules: a null text is empty and has no token; rows with equal id and text
give equal results, once each.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, row_key
from .vocabulary import REMEMBER, tiktoken_ranks

CHUNK = 65536
OVERLAP = 1024
#: No match looks further ahead than this past its end.
AHEAD = 4

RESULT = "n_tokens long, ids_sha256 string, decoded_sha256 string"


class Encoder:
    """Encodes pre-tokens and remembers the common ones: their number of ids,
    the ids in decimal, and the bytes that the ids stand for."""

    def __init__(self, path: str):
        import public_tokenizers
        import regex
        import tiktoken
        ranks = tiktoken_ranks(path)
        self.encoding = tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks,
                                          special_tokens={})
        self.token_bytes = {i: b for b, i in ranks.items()}
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known: dict[str, tuple[int, str, bytes]] = {}

    def piece(self, text: str) -> tuple[int, str, bytes]:
        got = self.known.get(text)
        if got is None:
            ids = self.encoding._encode_single_piece(text)
            got = len(ids), ",".join(map(str, ids)), b"".join(self.token_bytes[i] for i in ids)
            if len(self.known) >= REMEMBER:
                self.known.clear()
            self.known[text] = got
        return got

    def result(self, pre_tokens: list[str]) -> tuple[int, str, str]:
        if not pre_tokens:
            return 0, hashlib.sha256(b"").hexdigest(), hashlib.sha256(b"").hexdigest()
        counts, ids, raw = zip(*map(self.piece, pre_tokens))
        return (sum(counts), hashlib.sha256(",".join(ids).encode()).hexdigest(),
                hashlib.sha256(b"".join(raw)).hexdigest())


def boundaries(pattern, text: str, last: bool) -> list[int]:
    """Starts of the matches, and the text's end for the last chunk. Of other
    chunks, those that what follows the chunk could move are left out."""
    starts = [m.start() for m in pattern.finditer(text)]
    if last:
        return starts + [len(text)]
    return [s for s in starts if s <= len(text) - AHEAD]


def stitch(chunks: list[tuple[int, str, list[int]]], pattern) -> list[str]:
    """Pre-tokens of the whole text from (start, text, boundaries) of its
    chunks in order."""
    out: list[str] = []
    start, text, cuts = chunks[0]
    at = 0  # the first boundary of this chunk that is in step
    for k in range(1, len(chunks) + 1):
        if k == len(chunks):
            own = [c for c in cuts if c >= at]
            out += [text[a:b] for a, b in zip(own, own[1:], strict=False)]
            break
        next_start, next_text, next_cuts = chunks[k]
        shared = set(next_cuts)
        meet = next((c for c in cuts if c >= at and c + start - next_start in shared), None)
        if meet is None:  # no common boundary: one chunk from here to the next one's end
            text = text[at:next_start - start] + next_text if next_start - start >= at else next_text[at + start - next_start:]
            last = k == len(chunks) - 1
            # a chunk within one pre-token is only appended; its neighbours are looked at later
            cuts = [c - at for c in cuts if c >= at] if len(next_cuts) < 2 and not last else boundaries(pattern, text, last)
            start, at = start + at, 0
            continue
        own = [c for c in cuts if at <= c <= meet]
        out += [text[a:b] for a, b in zip(own, own[1:], strict=False)]
        at = meet + start - next_start
        start, text, cuts = next_start, next_text, next_cuts
    return out


def encode(docs: DataFrame, vocabulary: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    key_kind = pa.binary()

    def encode_short(batches):
        encoder = Encoder(vocabulary)
        for whole in batches:
            for b in pieces(whole):
                texts = b.column("text").cast(pa.string()).to_pylist()
                got = [encoder.result(encoder.pattern.findall(t or "")) for t in texts]
                n, ids, raw = zip(*got) if got else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(ids, pa.string()), pa.array(raw, pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def cut(batches):
        for whole in batches:
            for i in range(whole.num_rows):
                text = whole.column("text")[i].as_py()
                n = max(1, -(-(len(text) - overlap) // (chunk - overlap)))
                for k in range(n):
                    a = k * (chunk - overlap)
                    yield pa.RecordBatch.from_arrays(
                        [whole.column("key").slice(i, 1).cast(key_kind), whole.column("doc_id").slice(i, 1), pa.array([k], pa.int32()),
                         pa.array([k == n - 1]), pa.array([a], pa.int64()), pa.array([text[a:a + chunk] if k < n - 1 else text[a:]], pa.string())],
                        ["key", "doc_id", "k", "last", "start", "chunk"])

    def pre_tokenise(batches):
        import public_tokenizers
        import regex
        pattern = regex.compile(public_tokenizers.PATTERN)
        for b in batches:
            cuts = [boundaries(pattern, t, last) for t, last in
                    zip(b.column("chunk").to_pylist(), b.column("last").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cuts, pa.list_(pa.int32()))], [*b.schema.names, "cuts"])

    def join_up(pdf):
        import pandas as pd
        encoder = Encoder(vocabulary)
        copies = int((pdf["k"] == 0).sum())  # repeated rows share a key
        pdf = pdf.drop_duplicates("k").sort_values("k")
        parts = [(int(s), t, [int(c) for c in cs]) for s, t, cs in zip(pdf["start"], pdf["chunk"], pdf["cuts"], strict=True)]
        n, ids, raw = encoder.result(stitch(parts, encoder.pattern))
        return pd.DataFrame({"doc_id": [pdf["doc_id"].iloc[0]] * copies, "n_tokens": [n] * copies,
                             "ids_sha256": [ids] * copies, "decoded_sha256": [raw] * copies}).astype({"doc_id": pdf["doc_id"].dtype})

    schema = f"doc_id {kind}, {RESULT}"
    short = rows.where(size <= chunk).mapInArrow(encode_short, schema)
    chunks = (rows.where(size > chunk).select(row_key(F.col("doc_id"), F.col("text")).alias("key"), "doc_id", "text")
              .mapInArrow(cut, f"key binary, doc_id {kind}, k int, last boolean, start long, chunk string"))
    cut_up = (chunks.repartition("key", "k")
              .mapInArrow(pre_tokenise, f"key binary, doc_id {kind}, k int, last boolean, start long, chunk string, cuts array<int>"))
    return short.unionByName(cut_up.groupBy("key").applyInPandas(join_up, schema))
