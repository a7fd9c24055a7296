import hashlib
import random
import re

import pytest

from backsight.llm import substrings


def plain(rows, window):
    """Straight from the definition."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    least = {}
    for (key, _), w in zip(rows, words):
        if key is not None:
            for i in range(len(w) - window + 1):
                s = tuple(w[i : i + window])
                least[s] = min(least.get(s, key), key)
    out = []
    for (key, _), w in zip(rows, words):
        gone = set()
        if key is not None:
            for i in range(len(w) - window + 1):
                if least[tuple(w[i : i + window])] < key:
                    gone.update(range(i, i + window))
        kept = [x for i, x in enumerate(w) if i not in gone]
        out.append((key, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


def texts(window):
    rng = random.Random(window)
    words = [f"é{i}" for i in range(500)] + ["a", ".", "Ü" * 30]
    passages = [[rng.choice(words) for _ in range(rng.randrange(window - 1, 4 * window))] for _ in range(4)]
    rows = []
    for k in range(60):
        w = [rng.choice(words) for _ in range(rng.randrange(0, 3 * window))]
        for p in rng.sample(passages, rng.randrange(0, 3)):
            cut = rng.randrange(len(w) + 1)
            w[cut:cut] = p[rng.randrange(0, 3) :]
        rows.append((rng.randrange(80) if k % 7 else k, rng.choice([" ", "\n", " \t"]).join(w)))
    same = ["x"] * (3 * window)
    return [*rows, (200, " ".join(same)), (201, "\n".join(same[: window + 1])), (202, " ".join(same[: window - 1])), (None, rows[0][1]), (203, None), (204, ""), (205, " \n "), rows[3], rows[3]]


@pytest.mark.parametrize(("window", "run"), [(8, 3), (50, 25), (4, 4)])
def test_equals_definition(spark, window, run):
    rows = texts(window)
    docs = spark.createDataFrame([(*r, 1, "clash") for r in rows], "doc_id long, text string, ats int, row string").repartition(5)
    found = substrings.deduplicate(docs, window, run).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in found), key=key) == sorted(plain(rows, window), key=key)
    kept = substrings.without_repeats(docs, window, run)
    assert kept.columns == docs.columns and kept.count() == len(rows)


def test_a_sketch_that_is_full_changes_nothing(spark, monkeypatch):
    rows = texts(8)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(substrings, "_cells", lambda values, bits: [values & 0, values & 0])
    found = substrings.deduplicate(docs, 8, 3).select("row.doc_id", "n_words", "n_removed", "kept_sha256").collect()
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    assert sorted((tuple(r) for r in found), key=key) == sorted(plain(rows, 8), key=key)


def test_empty_table(spark):
    assert substrings.without_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []
