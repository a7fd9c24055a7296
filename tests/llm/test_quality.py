import random

import numpy as np
import pytest

from backsight.llm import quality

GIVEN = "/root/testdata/sf0.01"


def test_accuracies_are_found():
    rng = random.Random(2)
    counts = {}
    for _ in range(20000):
        bad = rng.random() < 0.2
        vote = lambda p: rng.choice("-" * 3 + "x" * 7)[0].replace("x", ("r" if bad else "k") if rng.random() < p else ("k" if bad else "r"))
        pattern = vote(0.9) + vote(0.8) + vote(0.7) + vote(0.998)
        counts[pattern] = counts.get(pattern, 0) + 1
    posterior, right = quality.estimate(counts)
    assert np.allclose(right.mean(axis=0)[:3], [0.9, 0.8, 0.7], atol=0.04)
    assert posterior["rrrr"] > 0.99 > 0.01 > posterior["kkkk"] and "----" not in posterior
    assert quality.estimate({"---": 5})[0] == {}


def test_regression_reaches_the_optimum():
    rng = np.random.default_rng(0)
    dense = rng.random((200, 12)) < 0.3
    target = 1 / (1 + np.exp(-(dense @ rng.normal(0, 2, 12) - 0.5)))
    rows, at = np.nonzero(dense)
    weights, bias = quality._regression(rows, at, 200, 12, target, shrink=0.1)
    error = target - 1 / (1 + np.exp(-(dense @ weights + bias)))
    assert np.abs(dense.T @ error - 0.1 * weights).max() < 1e-3 and abs(error.sum()) < 1e-3


def test_measures(spark):
    texts = ["", "Plain words stand here.", "a%%% b&&& |  !!", "SHOUT LOUD Énorme", "same same same other", "You IDIOT, idiot's"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    found = quality.Texts(data, np.cumsum([0, *(len(t.encode()) for t in texts)]))
    assert found.n.tolist() == [0, 4, 4, 3, 4, 3]
    assert found.measures[:, 0].tolist() == [0, 0, 1, 0, 0, 0]
    assert found.measures[3, 1] == pytest.approx(2 / 3) and found.measures[4, 2] == 0.5 and found.measures[2, 3] == 0.25
    assert found.measures[:, 5].tolist() == [0, 0, 0, 0, 0, 2]


def test_held_out_labels(spark):
    """Trained without the labels of even ids, judged on them."""
    docs, labels = spark.read.parquet(f"{GIVEN}/documents.parquet"), spark.read.parquet(f"{GIVEN}/labels.parquet")
    scorer = quality.train(docs, labels.where("doc_id % 2 = 1"))
    found = quality.score(docs.select("doc_id", "text"), scorer).select("row.doc_id", "rejected")
    rows = found.join(labels.where("doc_id % 2 = 0"), "doc_id").collect()
    clean = [r.rejected for r in rows if r.quality == 1 and r.toxic == 0]
    low = [r.rejected for r in rows if r.quality == 0]
    toxic = [r.rejected for r in rows if r.toxic == 1]
    assert sum(clean) <= 0.01 * len(clean)
    assert sum(low) >= 0.85 * len(low) and sum(toxic) >= 0.5 * len(toxic)


def test_odd_rows(spark):
    rows = [(1, None, 0), (2, "", 1), (None, "fine words here", 1), (3, "fine words here", 1), (3, "fine words here", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, quality int")
    labels = spark.createDataFrame([(3, 1, None), (3, None, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")
    assert quality.accepted(docs, labels).count() == 5 and quality.accepted(docs, None).columns == docs.columns
    assert quality.accepted(docs.limit(0), labels).collect() == []
