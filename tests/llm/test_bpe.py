"""Chunked encoding against the tiktoken library on whole texts."""

from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import regex
import tiktoken

from censa.llm import bpe
from censa.llm.vocabulary import tiktoken_ranks

from .fixtures import frame, rows

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ENCODING = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=tiktoken_ranks(PATH), special_tokens={})
PATTERN = regex.compile(public_tokenizers.PATTERN)


def brute(doc_id, text):
    ids = ENCODING.encode_ordinary(text or "")
    assert ENCODING.decode_bytes(ids) == (text or "").encode()
    return (doc_id, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256((text or "").encode()).hexdigest())


HARD = ["it's we'll they've I'd 'tis ''s", "   spaced   out  \n\n text \t\n", "x" * 3000, " " * 900 + "a", "1234567 89,0 ½ ²",
        "中文字符 mixed ée nb em", "a\u0085b \x1c c", "<|endoftext|> stays text", "\n" * 50 + "'" * 700 + "ll"]


@pytest.mark.parametrize(("chunk", "overlap"), [(65536, 1024), (200, 40), (37, 9)])
def test_equals_tiktoken(spark, chunk, overlap):
    data = rows() + [(2000 + i, t, *[None] * 5) for i, t in enumerate(HARD)]
    if chunk < 100:
        data = [r for r in data if r[1] is None or len(r[1]) < 4000]
    got = sorted((tuple(r) for r in bpe.encode(frame(spark, data), PATH, chunk, overlap).collect()), key=repr)
    assert got == sorted((brute(r[0], r[1]) for r in data), key=repr)


def test_stitching_random_texts():
    rng = random.Random(5)
    for _ in range(400):
        text = "".join(rng.choice(["a", "bc", " ", "  ", "\n", "'", "'ll", "s", "1", "é", "!"]) for _ in range(rng.randint(1, 120)))
        size = rng.randint(8, 40)
        step = size - rng.randint(5, 7)
        starts = list(range(0, max(1, len(text) - (size - step)), step))
        chunks = []
        for k, a in enumerate(starts):
            last = k == len(starts) - 1
            part = text[a:] if last else text[a:a + size]
            chunks.append((a, part, bpe.boundaries(PATTERN, part, last)))
        assert bpe.stitch(chunks, PATTERN) == PATTERN.findall(text)


def test_empty(spark):
    assert bpe.encode(frame(spark, []), PATH).count() == 0
