"""Held against a sort of all scores."""
import random

import numpy as np
import pytest

from airshed.llm import topk


def usable(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def brute(rows, asked, k):
    ok = [(i, [int(np.floor(1024 * float(np.float32(x)))) for x in v]) for i, v in rows if i is not None and usable(v)]
    out = []
    for q in sorted({i for i, _ in ok if asked(i)}):
        mine = min(v for i, v in ok if i == q)
        best = sorted((-sum(a * b for a, b in zip(mine, v, strict=False)), i) for i, v in ok if i != q)[:k]
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(best)]
    return out


def run(spark, rows, asked, k=10, **more):
    frame = spark.createDataFrame([(i, v, 1, 2, 3.0) for i, v in rows], "vec_id long, embedding array<float>, v int, q int, score double").repartition(3)
    got = topk.top_k(frame.where(f"vec_id % {asked} = 0"), frame, k, **more)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


@pytest.mark.parametrize("block", [3, 2048])
def test_random_vectors(spark, block):
    rng = random.Random(block)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(300)]
    assert run(spark, rows, 20, block=block) == brute(rows, lambda i: i % 20 == 0, 10)


def test_ties_and_unusable_vectors(spark):
    same = [0.5, -0.25, 1.0]
    rows = [(i, same) for i in range(120)] + [(200, None), (201, [None, 1.0, 2.0]), (202, [float("nan"), 0.0, 0.0]), (203, [float("inf"), 0.0, 0.0]),
            (None, same), (60, [0.1, 0.1, 0.1]), (80, same), (204, [0.5]), (205, []), (300, [-3.0, 9.0, 1e4, 5.0])]
    assert run(spark, rows, 20) == brute(rows, lambda i: i % 20 == 0, 10)


def test_few_candidates_and_none(spark):
    rows = [(0, [1.0, 2.0]), (1, [0.5, 0.5]), (2, [-1.0, 0.0])]
    assert run(spark, rows, 2, k=10) == brute(rows, lambda i: i % 2 == 0, 10)
    assert run(spark, rows[:1], 1) == [] and run(spark, [(3, [1.0])], 2) == []


def test_large_numbers_stay_exact(spark):
    rows = [(i, [float(2 ** 20 + i), float(2 ** 20 - 3 * i), 1.0]) for i in range(60)]
    assert run(spark, rows, 10) == brute(rows, lambda i: i % 10 == 0, 10)


def test_one_bin_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(topk, "BINS", 4)
    monkeypatch.setattr(topk, "_CELLS", 16)
    rng = random.Random(9)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(4)]) for i in range(80)]
    assert run(spark, rows, 20, k=3) == brute(rows, lambda i: i % 20 == 0, 3)


def test_large_components_are_not_dropped(spark):
    rows = [(0, [0.001, 0.0]), (1, [float(2 ** 51), 0.0]), (2, [0.5, 1.0]), (10, [0.0, 0.001]), (3, [float(2 ** 51), float(2 ** 51)])]
    assert run(spark, rows, 10) == brute(rows, lambda i: i % 10 == 0, 10)
    for too_much in ([(0, [1.0]), (1, [float(2 ** 53)])], [(0, [float(2 ** 40)]), (1, [float(2 ** 40)])]):
        with pytest.raises(Exception, match="2\\*\\*52|64 bits"):
            run(spark, too_much, 10)
