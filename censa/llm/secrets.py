"""Secret scan with a token-efficiency test (operator 6).

Base kinds, leftmost and not overlapping within a kind:

* ``assign``: a key name, ``=`` or ``:``, and a value of 6 or more characters;
  the span is the whole match;
* ``access``: an access key id of 20 or more characters;
* ``hex``: a run of 24 or more lower-case hexadecimal digits.

The method adds ``random``: a run of ``[A-Za-z0-9+/_=-]`` of MIN_RANDOM or
more characters with a letter, for which a tiktoken vocabulary needs so many
tokens that characters per token fall below MAX_RATIO; it need not hold a
digit. Ordinary words and joined words compress well under such a vocabulary;
random strings do not. Known digests (hexadecimal of 32, 40, 56, 64, 96 or 128
digits, and UUIDs) and identifiers (words, numbers and camel-case parts joined
by ``_``, ``-`` or ``/``) are excluded first, and so are runs that touch a base
span. A part of MIN_RANDOM or more capitals and digits is no identifier's, as
base32 keys look like that; lower-case letters alone are a word at any length.

Offsets are code points, ends exclusive. Edge rules: a null text is empty;
spans are ordered by start, then kind in the order above, then end.
"""

from __future__ import annotations

import base64
import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import pieces, utf8

# The base patterns and their kinds, in order.
KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(rb"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I)
ASSIGN_HINTS = (b"passw", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
MIN_ASSIGN, MIN_ACCESS, MIN_HEX = 6, 20, 24

MIN_RANDOM = 16
MAX_RATIO = 2.0
DIGESTS = (32, 40, 56, 64, 96, 128)
_HEX_RUN = np.zeros(256, bool)
_HEX_RUN[list(b"0123456789abcdef")] = True
_RUN = np.zeros(256, bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
_UUID = re.compile(rb"[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}")
_HEX = re.compile(rb"[0-9a-f]+|[0-9A-F]+")
# possessive {2,}+: parts of camel case have one split, or a long run that fails late takes exponential time
_IDENTIFIER = re.compile(rb"[-_/=+]*(?:(?:[A-Z]?[a-z]{2,}|[A-Z]{2,}|[A-Za-z]|[0-9]+)[-_/=+]+)*"
                         rb"(?:(?:[A-Z]?[a-z]{2,}+)+[0-9]{0,4}|[A-Z]{2,}[0-9]{0,4}|[0-9]+|[A-Za-z])[-_/=+]*")
_CAPITALS = re.compile(rb"[A-Z][A-Z0-9]{%d,}" % (MIN_RANDOM - 1))


def runs(data: np.ndarray, off: np.ndarray, member: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of ``member`` bytes of ``least`` or more that
    stay within one row."""
    m = member[data]
    first = np.zeros(len(data) + 1, bool)
    first[off] = True
    starts = np.flatnonzero(m & (first[:-1] | np.concatenate([[True], ~m[:-1]])))
    ends = np.flatnonzero(m & (first[1:] | np.concatenate([~m[1:], [True]]))) + 1
    long = ends - starts >= least
    return starts[long], ends[long]


def is_known(token: bytes) -> bool:
    """Digest or identifier, which the efficiency test leaves alone."""
    return bool(len(token) in DIGESTS and _HEX.fullmatch(token) or _UUID.fullmatch(token)
                or _IDENTIFIER.fullmatch(token) and not _CAPITALS.search(token))


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def find_spans(data: np.ndarray, off: np.ndarray, n_tokens, max_ratio: float) -> list[tuple[int, int, int, int]]:
    """(row, start, kind, end) in bytes, sorted; ``n_tokens(bytes)`` counts a
    run's tokens."""
    raw = data.tobytes()
    low = raw.lower()
    found = []
    if any(h in low for h in ASSIGN_HINTS):
        for r in np.unique(np.searchsorted(off, [m.start() for m in re.finditer(rb"passw|secret|token|api_?key", low)], "right") - 1).tolist():
            a, b = int(off[r]), int(off[r + 1])
            found += [(r, a + m.start(), 0, a + m.end()) for m in ASSIGN.finditer(raw[a:b]) if len(m[2]) >= MIN_ASSIGN]
    if b"AKIA" in raw:
        hits = [i.start() for i in re.finditer(b"AKIA", raw)]
        for r in np.unique(np.searchsorted(off, hits, "right") - 1).tolist():
            a, b = int(off[r]), int(off[r + 1])
            found += [(r, a + m.start(), 1, a + m.end()) for m in ACCESS.finditer(raw[a:b]) if len(m[0]) >= MIN_ACCESS]
    for s, e in zip(*(x.tolist() for x in runs(data, off, _HEX_RUN, MIN_HEX)), strict=True):
        found.append((int(np.searchsorted(off, s, "right")) - 1, s, 2, e))
    found.sort()
    # runs that hold a letter and touch no base span
    starts, ends = runs(data, off, _RUN, MIN_RANDOM)
    if len(starts):
        taken = np.array(sorted((s, e) for _, s, _, e in found), np.int64).reshape(-1, 2)
        last = np.maximum.accumulate(taken[:, 1]) if len(taken) else taken[:, 1]
        more = []
        for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
            k = int(np.searchsorted(taken[:, 0], e)) - 1  # base spans that begin before this run's end
            if k >= 0 and last[k] > s:
                continue
            token = raw[s:e]
            if not re.search(rb"[A-Za-z]", token) or is_known(token):
                continue
            if len(token) < max_ratio * n_tokens(token):
                more.append((int(np.searchsorted(off, s, "right")) - 1, s, 3, e))
        found = sorted(found + more)
    return found


def scan(docs: DataFrame, vocabulary: str, max_ratio: float = MAX_RATIO, keep: list[str] | None = None) -> DataFrame:
    """doc_id, spans (array of kind, start, end in code points) of every row;
    ``vocabulary`` is a .tiktoken file that every executor can read. With
    ``keep``: the columns named there and ``_redacted``, the text with
    ``[SECRET]`` in place of each run of overlapping spans."""
    frame = docs.select("doc_id", "text") if keep is None else docs.select(*dict.fromkeys([*keep, "text"]))
    kinds = {f.name: f.dataType.simpleString() for f in frame.schema}
    span = "array<struct<kind:string,start:long,end:long>>"
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        import public_tokenizers
        import tiktoken
        encoding = tiktoken.Encoding("secrets", pat_str=public_tokenizers.PATTERN,
                                     mergeable_ranks=load_ranks(vocabulary), special_tokens={})

        def n_tokens(token: bytes) -> int:
            return len(encoding.encode_ordinary(token.decode("ascii")))

        for whole in batches:
            for b in pieces(whole):
                data, off = utf8(b.column("text"))
                found = find_spans(data, off, n_tokens, max_ratio)
                spans = [[] for _ in range(b.num_rows)]
                cut: dict[int, list] = {}
                if found:
                    points = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                    for r, s, k, e in found:
                        base = points[off[r]]
                        spans[r].append({"kind": KINDS[k], "start": int(points[s] - base), "end": int(points[e] - base)})
                        cut.setdefault(r, []).append((s, e))
                if keep is None:
                    out, names = [b.column("doc_id"), pa.array(spans, span_type)], ["doc_id", "spans"]
                else:
                    texts = b.column("text").cast(pa.string()).to_pylist()
                    raw = data.tobytes()
                    for r, parts in cut.items():
                        texts[r] = redact(raw, int(off[r]), int(off[r + 1]), parts)
                    names = [*keep, "_redacted"]
                    out = [*(b.column(c) for c in keep), pa.array(texts, pa.string())]
                yield pa.RecordBatch.from_arrays(out, names)

    if keep is not None:
        return frame.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", _redacted string")
    return frame.mapInArrow(run, f"doc_id {kinds['doc_id']}, spans {span}")


def redact(raw: bytes, start: int, end: int, spans: list[tuple[int, int]]) -> str:
    """The row's text with each run of overlapping spans replaced by one mark."""
    out, at, upto = [], start, -1
    for s, e in sorted(spans):
        if s >= upto:
            out.append(raw[at:s] + b"[SECRET]")
        upto = at = max(upto, e)
    return (b"".join(out) + raw[at:end]).decode("utf-8", "replace")


def digest(spans) -> str:
    """SHA-256 of the spans as kind:start:end, comma-joined."""
    return hashlib.sha256(",".join(f"{s['kind']}:{s['start']}:{s['end']}" for s in spans).encode()).hexdigest()
