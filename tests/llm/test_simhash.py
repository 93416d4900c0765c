"""Held against brute force over all pairs of distinct fingerprints."""
import itertools
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from airshed.llm import simhash


def plain(text, shingle):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return 0
    parts = [b" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    h = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(fps, radius):
    """fp -> smallest fp reachable."""
    fps = sorted(set(fps))
    root = {x: x for x in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in itertools.combinations(fps, 2):
        if (a ^ b).bit_count() <= radius:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {x: find(x) for x in fps}


def expected(rows, shingle, radius):
    fps = [(i, plain(t, shingle)) for i, t in rows]
    of = classes([f for _, f in fps], radius)
    least = {}
    for i, f in fps:
        if i is not None:
            least[of[f]] = min(least.get(of[f], i), i)
    return sorted(((-1 if i is None else i, f"{f:016x}", least.get(of[f])) for i, f in fps), key=str)


def test_masks_cover_every_small_set():
    masks = simhash.covering_masks((1 << 64) - 1, 3)
    assert len(masks) == 15
    for s in itertools.combinations(range(64), 3):
        bits = sum(1 << b for b in s)
        assert any(not m & bits for m in masks)
    for m in masks:  # what a bucket of the second covering leaves open
        rest = ~m & ((1 << 64) - 1)
        assert all((rest & ~s).bit_count() <= 16 for s in simhash.covering_masks(rest, 3))


def test_documents_equal_brute_force(docs, none, texts):
    got = [((-1 if r.doc_id is None else r.doc_id), r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=str) == expected(texts, 3, 3)
    assert simhash.near_duplicates(none).collect() == []


@pytest.mark.parametrize("bucket", [2, 4096])
def test_dense_fingerprints_and_divided_buckets(spark, bucket):
    rng = random.Random(5)
    seeds = [rng.getrandbits(64) for _ in range(6)]
    fps = set()
    for s in seeds:
        for _ in range(60):
            x = s
            for _ in range(rng.randint(0, 9)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    signed = [simhash._signed(x) for x in fps]
    frame = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(3)
    got = simhash.components(simhash.links(frame, 3, bucket)).collect()
    root = {r.node: r.root for r in got}
    want = classes(fps, 3)
    groups, mine = {}, {}
    for x in fps:
        groups.setdefault(want[x], set()).add(x)
        mine.setdefault(root.get(simhash._signed(x), simhash._signed(x)), set()).add(x)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(300)] + [(1000, 1001)], "a long, b long").withColumn("a", F.col("a"))
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {k: 0 for k in range(1, 301)} | {1001: 1000}


def test_one_of_each_component_stays(docs, none, texts):
    kept = simhash.keep_one_each(docs).collect()
    want = {c for i, _, c in expected(texts, 3, 3) if c is not None}
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(want)
    alone = {f for _, f, c in expected(texts, 3, 3) if c is None}
    assert len([r for r in kept if r.doc_id is None]) == len(alone)
    assert kept[0].asDict().keys() == docs.first().asDict().keys()
    assert simhash.keep_one_each(none).count() == 0


def test_an_id_with_unlike_texts_keeps_one_of_each(as_docs):
    a, b, c = ("".join(f"{w}{k} " for k in range(80)) for w in ("a", "b", "c"))
    kept = simhash.keep_one_each(as_docs([(5, a), (5, b), (5, b), (5, c), (3, c), (9, a), (None, b), (None, "alone")]))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == sorted([("5", a), ("5", b), ("3", c), ("None", "alone")])


def test_long_text_in_pieces(monkeypatch):
    text = ("word%d " * 5 % (1, 2, 3, 4, 5) * 300).encode()
    whole = simhash.fingerprint_of(text, 3)
    monkeypatch.setattr(simhash, "_CHUNK", 7)
    assert simhash.fingerprint_of(text, 3) == whole == plain(text.decode(), 3)
    assert isinstance(np.uint64(whole), np.uint64)
