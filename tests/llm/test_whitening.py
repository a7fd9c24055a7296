import math
import random

import numpy as np
import pytest

from backsight.llm import queries, whitening

SF = "/root/testdata/sf0.001"


def plain(rows, components=8, scale=1024, shift=100_000):
    """(vec_id, component) -> (n, deviation, whitened up to sign, explained) for vectors of one length."""
    x = [(k, [math.floor(scale * c) + shift for c in v]) for k, v in rows]
    n, length = len(x), len(x[0][1])
    sums = [sum(v[j] for _, v in x) for j in range(length)]
    exact = [[n * v[j] - sums[j] for j in range(length)] for _, v in x]
    z = np.array(exact, float) / n
    values, vectors = np.linalg.eigh(z.T @ z / n)
    out = {}
    for (key, _), e, row in zip(x, exact, z, strict=True):
        for c in range(min(components, length)):
            value = values[-1 - c]
            out.setdefault((key, c + 1), []).append((n, sum(a * a for a in e), abs(row @ vectors[:, -1 - c]) / math.sqrt(value), value / values.sum()))
    return out


def same(found, expected):
    assert {k: len(v) for k, v in found.items()} == {k: len(v) for k, v in expected.items()}
    for key, rows in expected.items():
        for a, b in zip(sorted(found[key]), sorted(rows), strict=True):
            assert a[:2] == b[:2] and a[2:] == pytest.approx(b[2:], rel=1e-7, abs=1e-9)


def by_key(frame):
    out = {}
    for r in frame.collect():
        assert r.identity_error <= 1e-4
        out.setdefault((r.vec_id, r.component), []).append((r.n, r.deviation, abs(r.whitened), r.explained))
    return out


def test_registered_query_equals_brute_force(spark):
    frame = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in frame.collect()]
    found = queries.QUERIES["op13_whitening"](spark, SF)
    assert found.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    same(by_key(found), plain(rows))


def test_cases(spark):
    rng = random.Random(2)
    sound = [(k, [rng.gauss(0, 1 + j) for j in range(5)]) for k in range(300)]
    sound += [sound[3], sound[3], (None, [1.0, 2.0, 3.0, 4.0, 5.0])] + [(900, [0.25] * 5)] * 100
    bad = [(400, None), (401, [1.0, None, 2.0, 3.0, 4.0]), (402, [float("nan")] * 5), (403, [float("inf")] * 5), (404, [])]
    short = [(500 + k, [rng.random(), rng.random()]) for k in range(40)]
    frame = spark.createDataFrame([(*r, 1.0) for r in sound + bad + short], "vec_id long, embedding array<double>, whitened double").repartition(7)
    found = by_key(whitening.whiten(frame, components=3))
    expected = plain(sound, 3) | plain(short, 3)
    same(found, expected)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert whitening.whiten(empty).collect() == []


def test_ranks_ties_and_large_entries(spark):
    line = spark.createDataFrame([(k, [float(k % 5), 2.0 * (k % 5), 0.0]) for k in range(50)], "vec_id long, embedding array<double>")
    rows = whitening.whiten(line).collect()
    assert len(rows) == 150 and all((r.whitened is None) == (r.component > 1) for r in rows)
    assert all(r.explained == pytest.approx(1.0 if r.component == 1 else 0.0, abs=1e-12) for r in rows)
    one = whitening.whiten(spark.createDataFrame([(1, [0.5, 0.5])], "vec_id long, embedding array<double>")).collect()
    assert [(r.n, r.deviation, r.whitened, r.explained) for r in one] == [(1, 0, None, None)] * 2
    square = spark.createDataFrame([(k, [float(k & 1), float(k >> 1)]) for k in range(4)], "vec_id long, embedding array<double>")
    y = np.array([[r.whitened for r in sorted(whitening.whiten(square).collect()) if r.vec_id == k] for k in range(4)])
    assert y.T @ y / 4 == pytest.approx(np.eye(2), abs=1e-9)  # equal eigenvalues: any orthonormal basis
    large = [(k, [1e6 * math.sin(k), math.cos(k)]) for k in range(60)] + [(99, [1e20, 0.0])]
    found = whitening.whiten(spark.createDataFrame(large, "vec_id long, embedding array<double>")).collect()
    assert len(found) == 122 and all(r.deviation is None or r.deviation >= 0 for r in found)


def test_spectra_do_not_depend_on_the_cut():
    rng = np.random.default_rng(5)
    x = np.floor(1024 * rng.normal(0, 0.1, (400, 12))).astype(np.int64) + 100_000
    x[50:90] = x[7]
    parts = [whitening.Spectrum(12) for _ in range(5)]
    for part, rows in zip(parts, np.array_split(x, 5), strict=True):
        part.add_rows(rows[:30])
        part.add_rows(rows[30:])
    for part in parts[1:]:
        parts[0].add(part)
    z = x - x.mean(axis=0)
    whole = parts[0]
    assert whole.n == 400 and whole.sums == x.sum(axis=0).tolist()
    assert whole.vectors.T @ whole.vectors == pytest.approx(np.eye(12), abs=1e-12)
    assert whole.vectors * whole.values @ whole.vectors.T == pytest.approx(z.T @ z, rel=1e-9, abs=1e-5)
