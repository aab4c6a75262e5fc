"""Byte-level BPE vocabularies and cutting text where tokens cannot join."""

from __future__ import annotations

import base64
import json

import numpy as np

#: Distinct pieces a worker remembers; past it the memory starts anew.
REMEMBER = 200_000


def tiktoken_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def json_ranks(path: str) -> dict[bytes, int]:
    """Ranks of a byte-level BPE file of the tokenizers library. Its ids must
    follow its merge order, which makes ids and ranks the same thing."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]  # bytes that stand for themselves
    byte = {chr(b): b for b in plain}
    byte |= {chr(0x100 + i): b for i, b in enumerate(b for b in range(256) if b not in byte.values())}
    ranks = {bytes(byte[c] for c in token): i for token, i in model["vocab"].items()}
    for k, pair in enumerate(model["merges"]):
        a, b = pair if isinstance(pair, list) else pair.split(" ")
        if model["vocab"][a + b] != 256 + k:
            raise ValueError(f"{path}: ids do not follow the merge order")
    return ranks


_BLANK = np.zeros(256, bool)
_BLANK[[*range(0x09, 0x0E), *range(0x1C, 0x21)]] = True
# first bytes of the characters outside ASCII that count as white space
_WIDE = np.zeros(256, bool)
_WIDE[[0xC2, 0xE1, 0xE2, 0xE3]] = True


def unit_starts(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Places where each row, and each single white space between two other
    characters, begins: a match of the pre-token pattern always starts there,
    so the stretches between are encoded alone. Next to characters that may
    be white space outside ASCII no cut is made, which is always right."""
    blank = _BLANK[data]
    wide = _WIDE[data]
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 2:
        ok = blank[1:-1] & ~blank[:-2] & ~blank[2:] & ~wide[2:]
        ok[1:] &= data[:n - 3] != 0xC2  # a two-byte character before
        ok[2:] &= ~wide[:max(0, n - 4)]  # a three-byte one
        cut[1:n - 1] = ok
    cut[off] = True
    return np.flatnonzero(cut[:n])
