import random
from itertools import combinations

import numpy as np
import pytest
import xxhash

from backsight.llm import simhash


def plain_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\v\f\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints):
    root = {k: k for k in prints}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in combinations(sorted(prints), 2):
        if bin(prints[a] ^ prints[b]).count("1") <= 2:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {k: find(k) for k in prints}


def texts():
    rng = random.Random(5)
    words = [f"w{i}é" for i in range(60)]
    out = []
    for _ in range(40):
        base = [rng.choice(words) for _ in range(rng.randrange(4, 400))]
        for _ in range(rng.randrange(1, 5)):
            changed = list(base)
            for _ in range(rng.randrange(0, 2)):
                changed[rng.randrange(len(changed))] = "X"
            out.append(rng.choice([" ", "\n", "\t "]).join(changed))
    return [*out, None, "", " \n", "one", "One", "one two", "Ünï Ünï Ünï ünï"]


@pytest.mark.parametrize("together", [1_000_000, 1])
def test_equals_brute_force(spark, together):
    rows = [(i, t, "clash") for i, t in enumerate(texts())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string").repartition(3)
    found = {r.doc_id: r for r in simhash.near_duplicates(docs, most_together=together).collect()}
    prints = {i: plain_fingerprint(t) for i, t, _ in rows}
    assert {k: r.fingerprint for k, r in found.items()} == {k: f"{v:016x}" for k, v in prints.items()}
    assert {k: r.component_id for k, r in found.items()} == plain_components(prints)


def test_random_fingerprints_lose_no_link(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 30, dtype=np.uint64) * np.uint64(2)
    values = set()
    for c in centres:
        for _ in range(60):
            v = int(c)
            for b in rng.choice(64, rng.integers(0, 4), replace=False):
                v ^= 1 << int(b)
            values.add(v)
    values = sorted(values)
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in simhash.links(frame).collect()]
    assert all(bin(a ^ b).count("1") <= 2 for a, b in pairs)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in pairs:
        root[max(find(a), find(b))] = min(find(a), find(b))
    expected = plain_components(dict(zip(range(len(values)), values, strict=True)))
    assert [find(v) for v in values] == [values[expected[i]] for i in range(len(values))]


@pytest.mark.parametrize("parts", range(1, 4))
def test_every_allocation_meets_the_pigeonhole(parts):
    rng = np.random.default_rng(parts)
    bits = rng.random((500, 64)) < rng.random(64)
    both = bits.T.astype(float) @ bits
    groups = simhash.grouped_bits(500, both, parts)
    assert sorted(b for g in groups for b in g) == list(range(64))
    chosen = simhash.allocation(500, both)
    assert chosen and all(t >= 0 for _, t in chosen)


def test_one_of_each(spark):
    a, b = "alpha beta gamma delta " * 30, "one two three four five " * 30
    rows = [(5, a, 1), (3, a, 2), (9, b, 3), (9, b, 3), (None, a, 4), (None, "unique text here", 5), (None, "Unique text here", 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, root int")
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    kept = [tuple(r) for r in kept.collect()]
    assert sorted((r[0], r[2]) for r in kept if r[0] is not None) == [(3, 2), (9, 3)]
    assert len([r for r in kept if r[0] is None]) == 1


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == []
    assert simhash.one_of_each(empty).collect() == []
