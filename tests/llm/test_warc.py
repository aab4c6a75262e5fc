"""WARC bundles: round trips, revisits, seek tables, damage."""

from __future__ import annotations

import base64
import hashlib
import os
import random

import pytest
import zstandard

from censa.llm import warc

from .fixtures import by_row

SCHEMA = "page_id long, url string, html string, record_type string, digest string"


def pages(n=120, seed=5):
    rng = random.Random(seed)
    shared = ["<p>one</p>", "<p>é中</p>" * 40, ""]
    out = []
    for i in range(n):
        html = rng.choice(shared) if rng.random() < 0.5 else f"<b>{i}</b>" + "x" * rng.choice([0, 10, 3000])
        out.append((i * 3 % 97 if i % 5 else i, f"http://h/{i}?q=a b&é", html, "clash", "clash"))
    out += [(None, None, None, None, None), (None, "u", "<p>one</p>", None, None), (7, "http://h", "<p>one</p>", "c", "c"),
            out[3], out[3], out[3], (-4, "http://h\r\nX: y", "\r\n\r\nWARC/1.1\r\n\r\n", "c", "c"),
            (500, "http://long", "long " * 400_000, "c", "c"), (501, "http://long", "long " * 400_000, "c", "c")]
    return out


def brute(data, min_bytes=0):
    payload = [(html or "").encode() for _, _, html, *_ in data]
    rank = [(p is not None, p or 0) for p, *_ in data]
    out, done = [], set()
    for (page_id, *_), body in sorted(zip(data, payload, strict=True), key=lambda x: (x[0][0] is not None, x[0][0] or 0), reverse=True):
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        top = max(r for r, b in zip(rank, payload, strict=True) if b == body)
        if len(body) < min_bytes or body not in done:
            out.append((page_id, len(body), digest, "response", None))
        else:
            out.append((page_id, len(body), digest, "revisit", top[1] if top[0] else None))
        done.add(body)
    return sorted(out, key=repr)


COLUMNS = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA).repartition(5)


@pytest.mark.parametrize("min_bytes", [0, 60])
def test_round_trip(spark, tmp_path, min_bytes):
    data, folder = pages(), f"file:{tmp_path}/w"
    index = warc.write_archives(frame(spark, data), folder, min_bytes, frame_bytes=5000, bundle_bytes=1000)
    assert index.count() == len(data) == index.select("record_id").distinct().count()
    assert index.select("file").distinct().count() > 3
    back = warc.read_archives(spark, folder)
    assert by_row(back, *COLUMNS) == brute(data, min_bytes)
    assert all(r.payload_bytes >= min_bytes for r in back.where("record_type = 'revisit'").collect())
    got = back.where("record_type = 'response'").collect()
    want = {base64.b32encode(hashlib.sha1((d[2] or "").encode()).digest()).decode(): (d[2] or "").encode() for d in data}
    assert {r.payload_digest: bytes(r.payload) for r in got} == want
    assert warc.read_archives(spark, folder, payloads=False).where("payload is not null").count() == 0
    assert {r.url for r in got if r.page_id == -4} == {"http://h%0D%0AX:%20y"}


def test_lookup_reads_single_records(spark, tmp_path):
    folder = str(tmp_path / "w")
    index = warc.write_archives(frame(spark, pages()), folder, frame_bytes=5000)
    every = {r.record_id: r for r in warc.read_archives(spark, folder).collect()}
    some = index.where("pmod(xxhash64(record_id), 3) = 0").select("record_id")
    got = warc.lookup(spark, folder, some.union(some)).collect()
    assert len(got) == some.count() > 10
    assert all(r == every[r.record_id] for r in got)


def test_bundles_are_plain_zstandard_with_a_seek_table(spark, tmp_path):
    folder = str(tmp_path / "w")
    index = warc.write_archives(frame(spark, pages()), folder, frame_bytes=5000)
    for name, frames in index.groupBy("file").agg({"frame": "max"}).collect():
        raw = open(os.path.join(folder, name), "rb").read()
        whole = zstandard.ZstdDecompressor().stream_reader(raw, read_across_frames=True).read()
        table = warc.seek_table(folder, name)
        assert len(table) == frames + 1 and sum(t[3] for t in table) == len(whole)
        at = 0
        for _, start, packed, plain, _ in table:  # each frame stands alone
            assert zstandard.ZstdDecompressor().decompress(raw[start:start + packed]) == whole[at:at + plain]
            at += plain


def test_files_of_lost_tasks_are_not_read_and_damage_is_found(spark, tmp_path):
    folder = str(tmp_path / "w")
    index = warc.write_archives(frame(spark, pages()), folder)
    bundle = warc.Bundle(folder, "part-lost.warc.zst", 1000)
    bundle.add("urn:page:1:x", 1, b"half a record")
    bundle.close()
    assert warc.read_archives(spark, folder).count() == index.count()
    name = index.first().file
    path = os.path.join(folder, name)
    raw = bytearray(open(path, "rb").read())
    raw[40] ^= 0xFF
    open(path, "wb").write(raw)
    with pytest.raises(Exception, match="checksum|zstd|decompress|Data corruption"):
        warc.read_archives(spark, folder).count()
    open(path, "wb").write(raw[:-3])
    with pytest.raises(ValueError, match="seek table"):
        warc.seek_table(folder, name)


def test_common_payloads_by_broadcast_or_by_join(spark, tmp_path, monkeypatch):
    data = pages()
    for hot in (3, 10_000):
        monkeypatch.setattr(warc, "HOT", hot)
        folder = str(tmp_path / f"w{hot}")
        warc.write_archives(frame(spark, data), folder)
        assert by_row(warc.read_archives(spark, folder), *COLUMNS) == brute(data)


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "w")
    assert warc.write_archives(spark.createDataFrame([], SCHEMA), folder).count() == 0
    assert warc.read_archives(spark, folder).count() == 0
    warc.remove_archives(folder)
    assert not os.path.exists(folder)
