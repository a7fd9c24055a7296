import hashlib
import re

import pytest

from backsight.llm import decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(text, items, window):
    w, hit, found = words(text), set(), set()
    for key, item in items:
        v = words(item)
        for p in {tuple(v[i : i + window]) for i in range(max(1, len(v) - window + 1))} if v and key is not None else ():
            for i in range(len(w) - len(p) + 1):
                if tuple(w[i : i + len(p)]) == p:
                    hit.update(range(i, i + len(p)))
                    found.add(str(key))
    ids = sorted(found)
    return (len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))


ITEMS = [(1, "The quick brown fox jumps over the lazy dog again"), (2, "Too short"), (10, "Überraschung! été 42"), (2, "Too short"), (3, None), (4, "  ?! "), (None, "nobody"), (11, "too SHORT")]
TEXTS = [
    "xx the QUICK, brown-fox jumps over\nthe lazy dog", "too short; too short too", "tooshort", "Überraschung été 42 überraschung ÉTÉ 42", None, "", " ?! ",
    "filler " * 100 + "too short", "filler " * 30 + "too short", "nobody", "too short" * 3, "Überraschung... été—42",
]


@pytest.mark.parametrize(("window", "most_bytes"), [(4, 1 << 20), (13, 1 << 20), (4, 40)])
def test_equals_definition(spark, window, most_bytes):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(TEXTS)], "doc_id long, text string, hits string").repartition(3)
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = {r.doc_id: r for r in decontaminate.scan(docs, bench, window, most_bytes=most_bytes).collect()}
    for i, text in enumerate(TEXTS):
        assert tuple(found[i])[1:6] == plain(text, ITEMS, window), text
        covered = [w for s in found[i].spans for w in words(text[s.start : s.end])]
        assert len(covered) == found[i].n_hit
    kept = decontaminate.without_contaminated(docs, bench, window, most_bytes=most_bytes)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, t in enumerate(TEXTS) if not plain(t, ITEMS, window)[4]}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    row = decontaminate.scan(docs, none).first()
    assert (row.n_words, row.n_hit, row.contaminated, row.spans) == (2, 0, False, [])
    assert decontaminate.without_contaminated(docs.limit(0), none).collect() == []


def test_a_task_takes_one_worker(spark):
    """One share of windows: the scan and what follows it are one Python step, and each further share is one more."""
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    steps = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow")
    for made in (decontaminate.scan, decontaminate.without_contaminated):
        assert [steps(made(docs, bench.limit(0))), steps(made(docs, bench))] == [1, 1]
    shares = len(list(decontaminate._shares(decontaminate.windows_of(bench, 4), 40)))
    assert shares > 1 and steps(decontaminate.scan(docs, bench, 4, most_bytes=40)) == shares
