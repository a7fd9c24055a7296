import math
import random

import numpy as np
import pytest

from backsight.llm import topk


@pytest.mark.parametrize("block", [2048, 2])
def test_equals_brute_force(spark, block):
    rng = random.Random(4)
    rows = [(i, [rng.choice([0.5, -1.25, rng.gauss(0, 1)]) for _ in range(rng.choice([3, 7, 7, 40]))]) for i in range(700)]
    rows += [(700, [1.0, None, 2.0]), (800, [float("nan")] * 7), (900, [float("inf")] * 7), (1000, None), (1100, []), (1101, []), (None, [1.0] * 7), rows[3], rows[100]]
    frame = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, score string").repartition(4)
    sound = [(k, [math.floor(1024 * x) for x in v]) for k, v in rows if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = set()
    for key, q in {(k, tuple(v)) for k, v in sound if k % 100 == 0}:
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), k) for k, v in sound if k != key and len(v) == len(q))
        expected |= {(key, n, k, -s) for n, (s, k) in enumerate(scored[:10], 1)}
    assert {tuple(r) for r in topk.search(frame, block=block).collect()} == expected


def test_bounds_hold():
    rng = np.random.default_rng(1)
    q, x = rng.normal(2, 50, (40, 64)), rng.normal(-1, 50, (300, 64))
    exact, last = q @ x.T, None
    for level in topk.LEVELS:
        bound = topk._statistics(q, level) @ topk._statistics(x, level).T
        assert (bound >= exact - 1e-6).all() and (last is None or (bound <= last + 1e-6).all())
        last = bound


def test_empty_table(spark):
    assert topk.search(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_large_components(spark):
    rng = random.Random(5)
    big = [1e6, -1e6, 1e20, 3e15 + 1, 2.0**40, 1e150, -1e300, 0.5]
    rows = [(i, [rng.choice(big) if rng.random() < (0.4 if i % 3 else 0.0) else rng.gauss(0, 1) for _ in range(5)]) for i in range(600)]
    rows += [(600, [1e6] * 5), (700, [1e6] * 5), (701, [1e6] * 5), (702, [1e6] * 4 + [1e6 + 2**-10]), (800, [1e308] * 5), (801, [-1e308] * 5)]
    largest = int(np.finfo(float).max)
    whole = lambda x: max(-largest, min(largest, math.floor(1024 * x) if math.isfinite(1024 * x) else int(math.copysign(1, x)) * largest))
    sound = [(k, [whole(x) for x in v]) for k, v in rows]
    expected = {}
    for key, q in (r for r in sound if r[0] % 100 == 0):
        scored = sorted((-sum(a * b for a, b in zip(q, v, strict=True)), k) for k, v in sound if k != key)
        expected |= {(key, n): (k, max(-(2**63), min(2**63 - 1, -s))) for n, (s, k) in enumerate(scored[:10], 1)}
    found = topk.search(spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)).collect()
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in found} == expected


def test_sortable():
    numbers = [0, 1, -1, 9, 10, -9, -10, 99, -99, 10**40, -(10**40), 10**700, -(10**700)]
    assert sorted(numbers, key=topk.sortable) == sorted(numbers)
