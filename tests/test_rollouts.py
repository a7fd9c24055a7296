import pytest
from pyspark.sql import functions as F

from backsight.functions.draws import uniform as draw
from backsight.operators import rollouts as G
from backsight.sources.schemas import MODEL, POLICY
from golden import SLIP_GRID_OPTIMAL_V, as_dict, slip_grid, uniform

GAMMA = 0.95


def walk(spark):
    """Random walk 1..5: left or right by the action, reward 1 at the right exit."""
    rows = []
    for s in range(1, 6):
        for a, n in ((0, s - 1), (1, s + 1)):
            out = n in (0, 6)
            rows.append((s, a, 1.0, None if out else n, 1.0 if n == 6 else 0.0, out))
    return spark.createDataFrame(rows, MODEL)


def test_discounted_walk(spark):
    model = walk(spark)
    starts = model.select(F.col("state").alias("start"), F.col("action").alias("first"))
    right = spark.createDataFrame([(s, 1, 1.0) for s in range(1, 6)], POLICY)
    totals = G.simulate(G.rollout_rows(starts, 2), model, right, 0.5, 6, 3)
    found = as_dict(totals.filter("rollout = 0").select("start", "first", "total"), "start", "first")
    for s in range(1, 6):
        assert found[s, 1] == pytest.approx(0.5 ** (5 - s))
        assert found[s, 0] == pytest.approx(0.0 if s == 1 else 0.5 ** (7 - s) if 8 - s <= 6 else 0.0)


def test_leaf_value_and_unknown_pairs(spark):
    model = spark.createDataFrame([(0, 0, 1.0, 1, 1.0, False)], MODEL)
    policy = spark.createDataFrame([(0, 0, 1.0), (1, 0, 1.0)], POLICY)
    q = spark.createDataFrame([(1, 0, 10.0)], "state LONG, action LONG, q DOUBLE")
    start = spark.createDataFrame([(0, 0), (5, 0)], "start LONG, first LONG")
    for depth in (1, 3):  # state 1 is not in the model: the rollout stops there and takes its q
        found = as_dict(G.simulate(G.rollout_rows(start, 1), model, policy, 0.5, depth, 1, q).select("start", "total"), "start")
        assert found == {0: 1.0 + 0.5 * 10.0, 5: 0.0}


def test_outcome_frequencies(spark):
    model = spark.createDataFrame([(0, 0, 0.5, 1, 0.0, False), (0, 0, 0.3, 1, 1.0, False), (0, 0, 0.2, None, 0.0, True)], MODEL)
    rows = spark.range(10_000).select("id", F.lit(0).alias("state"), F.lit(0).alias("action"))
    sampled = G.sample_outcome(rows, G.outcome_intervals(model), draw(3, "id"))
    counts = {(r["_next"], r["_reward"]): r["count"] for r in sampled.groupBy("_next", "_reward").count().collect()}
    assert sum(counts.values()) == 10_000
    for key, p in {(1, 0.0): 0.5, (1, 1.0): 0.3, (None, 0.0): 0.2}.items():
        assert abs(counts[key] - 10_000 * p) < 4 * (10_000 * p * (1 - p)) ** 0.5


def test_best_action_and_tree_search(spark):
    model = slip_grid(spark)
    optimal = spark.createDataFrame(
        [(s, a, float(SLIP_GRID_OPTIMAL_V[s])) for s in range(16) for a in range(4)], "state LONG, action LONG, q DOUBLE"
    )
    starts = model.filter("state = 14").select(F.col("state").alias("start"), F.col("action").alias("first")).distinct()
    means, best = G.best_by_rollout(starts, model, uniform(spark, model), GAMMA, 1, 300, 9, optimal)
    assert best.first()["first"] == 2 and means.count() == 4
    q = model.select("state", "action").distinct().withColumn("q", F.lit(0.0))
    roots = spark.createDataFrame([(14,)], "state LONG")
    table, choice = G.tree_search(model, q, roots, GAMMA, rounds=3, count=60, depth=2, lr=0.05, seed=2, c=1.0)
    found = {(r.state, r.action): r for r in table.collect()}
    assert choice.first().state == 14 and choice.count() == 1
    assert sum(r.n for r in found.values()) >= 180 and found[14, 0].n + found[14, 1].n + found[14, 2].n + found[14, 3].n >= 180
    assert max(found[14, a].q for a in range(4)) > 0


def test_policy_score(spark):
    model = walk(spark)
    right = spark.createDataFrame([(s, 1, 1.0) for s in range(1, 6)], POLICY)
    found = {r.start: r for r in G.score_policy(model.select("state").distinct(), model, right, 3, 5, 1).collect()}
    assert [found[s].mean_reward for s in range(1, 6)] == [0.0, 0.0, 1.0, 1.0, 1.0]
    assert found[5].spread == 0.0 and found[5].rollouts == 5
    some = G.score_policy(model.select("state").distinct(), model, right.where("state < 5"), 3, 5, 1).collect()
    assert {(r.mean_reward, r.rollouts) for r in some if r.start == 5} == {(None, 0)} and len(some) == len(found)
