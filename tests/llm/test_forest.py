import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from backsight.llm import forest
from backsight.llm.components import components


def words(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")


def plain_set(text, size):
    w = [x for x in words(text) if x]
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))) if w else frozenset()


def plain(rows, size, percent=80):
    """(doc_id, n_shingles, component_id, kept) of each row, as a sorted list."""
    sets = [plain_set(t, size) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = label[i], label[j]
                label = [y if z == x else z for z in label]
    out = []
    for i, (key, _) in enumerate(rows):
        ids = [k for (k, _), z in zip(rows, label, strict=True) if z == label[i] and k is not None]
        least = min(ids, default=None) if sets[i] else key
        out.append((key, len(sets[i]), least, key is not None and key == least))
    return sorted(out, key=repr)


def found(spark, rows, size, **options):
    frame = spark.createDataFrame([(*r, 5, "clash") for r in rows], "doc_id long, text string, n_shingles int, node string").repartition(5)
    return sorted((tuple(r) for r in forest.near_duplicates(frame, shingle=size, **options).collect()), key=repr)


def test_equals_brute_force(spark):
    rng = random.Random(7)
    vocabulary = [f"w{k}" for k in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 5, 40, 80]))) for _ in range(150)]
    for _ in range(120):  # near copies at all similarities, of copies too
        w = rng.choice(texts).split()
        for _ in range(rng.choice([0, 1, 2, 4, 7])):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(" ".join(w))
    rows = [(k, t) for k, t in enumerate(texts)]
    rows += [(1000, None), (1001, ""), (1002, " \t\n "), (1003, "One"), (1004, "one"), (1005, "ONE\ttwo"), (None, texts[0]), (None, "alone here"), rows[3], (3, "another text of this id"), (1006, "É é É"), (1007, "é É é")]
    assert found(spark, rows, 2) == plain(rows, 2)
    assert found(spark, rows, 5) == plain(rows, 5)


@pytest.mark.parametrize("near", [2, 8])
def test_crowds_of_near_copies(spark, near):
    """Many more near copies than neighbours, in two crowds that share regions, one of them with a far member."""
    rng = random.Random(3)
    base = [f"a{k}" for k in range(300)]
    other = base[:270] + [f"b{k}" for k in range(45)]
    rows = []
    for k in range(60):
        for start, crowd in ((base, 0), (other, 1000)):
            w = list(start)
            w[rng.randrange(270)] = f"x{rng.randrange(10**6)}"
            rows.append((crowd + k, " ".join(w)))
    bridge = base[:270] + [f"b{k}" for k in range(12)] + base[282:290]
    rows.append((5000, " ".join(bridge)))
    assert found(spark, rows, 1, near=near) == plain(rows, 1)


def test_links_across_components_of_a_region(spark):
    sets = {1: range(100), 2: range(1, 101), 3: range(2, 110), 4: range(500, 600), 5: range(501, 601), 6: range(900, 990)}
    nodes = spark.createDataFrame([(k, bytearray(np.zeros(forest.HASHES, np.uint8).tobytes())) for k in sets], "node long, signature binary")
    members = spark.createDataFrame([(k, bytearray(np.array(v, np.uint64).tobytes())) for k, v in sets.items()], "node long, members binary")
    rows = spark.createDataFrame([(b"r", k, k) for k in sets], "region binary, node long, root long")
    rooted = components(forest.across(rows, members, nodes, 80))
    assert {(r.node, r.root) for r in rooted.collect()} == {(1, 1), (2, 1), (3, 1), (4, 4), (5, 4)}


def test_long_texts_and_empty_tables(spark):
    long = " ".join(f"word{k}" for k in range(400_000))
    rows = [(1, long), (2, long + " and more"), (3, "x" * 5_000_000), (4, "short")]
    assert [tuple(r) for r in found(spark, rows, 2)] == [(1, 399_999, 1, True), (2, 400_001, 1, False), (3, 1, 3, True), (4, 1, 4, True)]
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert forest.near_duplicates(empty).collect() == []


def test_recall_of_the_orders(spark):
    """Pairs of similarity just above the limit among many others, with few neighbours."""
    rng = random.Random(11)
    rows = []
    for k in range(0, 1200, 2):
        w = [f"{rng.randrange(10**7)}" for _ in range(90)]
        rows += [(k, " ".join(w)), (k + 1, " ".join(w[10:] + [f"{rng.randrange(10**7)}" for _ in range(10)]))]  # 80 of 100 words
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    kept = forest.near_duplicates(frame, shingle=1, near=4).agg(F.sum(F.col("kept").cast("int"))).first()[0]
    assert 1200 - kept >= 0.99 * 600


def test_candidates_of_a_crowd_are_no_rows_of_pairs(spark):
    """A crowd of different roots, alike but not enough: a row for each node and order, not one for each pair."""
    rng = np.random.default_rng(5)
    base = rng.integers(0, 256, forest.HASHES, np.uint8)
    prints = [np.where(rng.random(forest.HASHES) < 0.85, base, rng.integers(0, 256, forest.HASHES, np.uint8)) for _ in range(300)]
    nodes = spark.createDataFrame([(k, 100, bytearray(p.astype(np.uint8).tobytes()), k) for k, p in enumerate(prints)], "node long, n_shingles long, signature binary, root long")
    assert 300 < forest.between(nodes, 8, 80).count() <= forest.ORDERS * 300


def test_neighbours_in_different_batches(spark):
    rng = random.Random(9)
    vocabulary = [f"w{k}" for k in range(60)]
    base = [rng.choice(vocabulary) for _ in range(60)]
    rows = []
    for k in range(200):
        w = list(base)
        for _ in range(rng.choice([3, 6, 9, 12])):
            w[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        rows.append((k, " ".join(w)))
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "11")
    try:
        assert found(spark, rows, 1) == plain(rows, 1)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)


def test_components_equal_a_plain_search(spark):
    rng = random.Random(2)
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(130)]
    links += [(500, 501), (501, 500), (500, 501), (502, 502), (None, 3), (600, 601)]
    label = {x: x for pair in links for x in pair if x is not None and None not in pair and pair[0] != pair[1]}
    for _ in label:
        for a, b in links:
            if a in label and b in label:
                label[a] = label[b] = min(label[a], label[b])
    frame = spark.createDataFrame(links, "a long, b long")
    assert sorted(map(tuple, components(frame).collect())) == sorted(label.items())
    assert components(frame.where("a = 502")).collect() == []
