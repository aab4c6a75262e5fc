"""SimHash groups against brute force over all pairs."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from censa.llm import components, queries, simhash

from .fixtures import frame, rows


def brute_fingerprint(text, shingle=4):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(len(words) - shingle + 1)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, ids, max_bits):
    label = list(range(len(fps)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i
    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= max_bits:
                label[find(i)] = find(j)
    out = []
    for i in range(len(fps)):
        known = [ids[j] for j in range(len(fps)) if find(j) == find(i) and ids[j] is not None]
        out.append(min(known, default=None))
    return out


def test_query_equals_brute_force(spark, tmp_path):
    data = rows()
    frame(spark, data).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r) for r in queries.op3_simhash_near_dedup(spark, str(tmp_path)).collect()), key=repr)
    fps = [brute_fingerprint(r[1]) for r in data]
    comps = brute_components(fps, [r[0] for r in data], 4)
    assert got == sorted(((r[0], f"{f:016x}", c) for r, f, c in zip(data, fps, comps, strict=True)), key=repr)


@pytest.mark.parametrize(("max_bits", "hold"), [(4, 1 << 22), (4, 3000), (3, 2000), (1, 500), (0, 100)])
def test_balls_find_every_link(max_bits, hold):
    rng = random.Random(max_bits * 7 + hold)
    fps = {rng.getrandbits(64) for _ in range(20)}
    for f in list(fps):
        for _ in range(6):
            fps.add(f ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 6))))
    fps = np.array(sorted(fps), np.uint64)
    forest = simhash.Forest(len(fps))
    lead = 4
    for bucket in range(1 << lead):
        near = np.bitwise_count((fps >> np.uint64(64 - lead)) ^ np.uint64(bucket)).astype(np.int64)
        inside = near <= (max_bits + 1) // 2
        simhash.collide(fps[inside], near[inside], 64 - lead, max_bits, forest, np.flatnonzero(inside), hold)
    forest.join(np.zeros(0, int), np.zeros(0, int))
    want = brute_components([int(f) for f in fps], list(range(len(fps))), max_bits)
    assert forest.root.tolist() == want


def test_components_of_chain_star_and_pairs(spark):
    links = [(i, i + 1) for i in range(100)] + [(500, i) for i in range(501, 560)] + [(900, 901), (901, 900), (7, 7)]
    got = components.connected_components(spark.createDataFrame(links, "a long, b long")).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.label, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(101)), list(range(500, 560)), [900, 901]]


def test_empty(spark):
    assert simhash.near_duplicates(frame(spark, [])).count() == 0
