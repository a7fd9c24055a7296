"""Odd input gets a defined answer or a clear error."""

import pytest
from pyspark.sql import functions as F

from backsight.functions.draws import uniform
from backsight.operators import backups, linear, online
from backsight.operators import policies as P
from backsight.plans import planning
from backsight.plans.loop import BROADCAST, SHUFFLE, NotSettled, placement_of

STEPS = "segment LONG, episode LONG, step_count LONG, state LONG, action LONG, reward DOUBLE, next_state LONG, done BOOLEAN, ts LONG, event_id LONG"
LINEAR = "episode LONG, step_count LONG, features ARRAY<DOUBLE>, action LONG, reward DOUBLE, propensity DOUBLE"


@pytest.mark.parametrize("gamma", [0.0, 1e-200, 1e-4])
def test_n_step_targets_at_tiny_discounts(spark, gamma):
    rows = [(1, 1, t, t % 3, 0, float(t + 1), None, t == 6, t, t) for t in range(7)]
    found = {r.step_count: r for r in backups.n_step_targets(spark.createDataFrame(rows, STEPS), gamma, 3).collect()}
    for t in range(7):
        expected = sum(gamma**i * (t + i + 1) for i in range(3) if t + i < 7)
        assert found[t].partial_return == pytest.approx(expected, rel=1e-12)
        assert found[t].src_state == ((t + 3) % 3 if t + 3 < 7 else None)


def test_draws_reach_all_rows_of_a_large_table(spark):
    values = [r[0] for r in spark.range(2000).select(uniform(1, "id")).collect()]
    assert all(0 <= v < 1 for v in values) and any(v * 2**40 % 1 for v in values)


def test_a_state_without_policy_stays(spark):
    rows = spark.createDataFrame([(1,), (2,)], "state LONG")
    policy = spark.createDataFrame([(1, 0, 1.0)], "state LONG, action LONG, policy DOUBLE")
    found = {r.state: r.action for r in P.sample_action(rows, policy, uniform(3, "state")).collect()}
    assert found == {1: 0, 2: None}


def test_online_learning_keeps_steps_that_the_policy_lacks(spark):
    steps = spark.createDataFrame([(1, 1, 0, 5, 0, 1.0, 6, False, 0, 0), (1, 1, 1, 6, 0, 2.0, None, True, 1, 1)], STEPS)
    policy = spark.createDataFrame([(5, 0, 1.0)], "state LONG, action LONG, policy DOUBLE")
    rows = online.with_chances(online.positioned(steps), policy, 2).orderBy("position").collect()
    assert [list(r.chances) for r in rows] == [[1.0, 0.0], [0.0, 0.0]] and list(rows[0].next_chances) == [0.0, 0.0]


@pytest.mark.parametrize(
    ("row", "message"),
    [
        ((1, 2, [1.0], 0, 1.0, None), "one length"),
        ((1, 2, [1.0, None], 0, 1.0, None), "no nulls"),
        ((1, 2, [1.0, 2.0], 0, None, None), "null numbers"),
        ((1, 2, [1.0, 2.0], 1, 1.0, None), "an action that is not one of"),
    ],
)
def test_linear_rows_are_checked(spark, row, message):
    data = spark.createDataFrame([(1, 1, [1.0, 2.0], 0, 1.0, None), row], LINEAR).coalesce(1)
    with pytest.raises(Exception, match=message):
        linear.reinforce_sweep(data, [0, 2], [0.0] * 18, 0.9, 0.1)


def test_loops_that_do_not_settle_raise(spark):
    model = spark.createDataFrame(
        [(0, 0, 1.0, 1, 1.0, False), (1, 0, 1.0, 0, 1.0, False)],
        "state LONG, action LONG, probability DOUBLE, next_state LONG, reward DOUBLE, done BOOLEAN",
    )
    with pytest.raises(NotSettled):
        planning.value_iteration(model, 0.99, 1e-300, max_rounds=4)
    with pytest.raises(NotSettled):
        twice = model.unionByName(model.withColumn("action", F.lit(1).cast("long")))
        planning.prioritised_value_iteration(twice, 0.99, 1e-12, rows_per_block=1, max_rounds=2)
    assert (placement_of(10), placement_of(10**9)) == (BROADCAST, SHUFFLE)


@pytest.mark.parametrize("placement", [BROADCAST, SHUFFLE])
def test_both_placements_agree(spark, monkeypatch, placement):
    rows = [(s, a, 0.5, (s + a + k) % 6, float(s == k), False) for s in range(6) for a in range(2) for k in range(2)]
    model = spark.createDataFrame(rows, "state LONG, action LONG, probability DOUBLE, next_state LONG, reward DOUBLE, done BOOLEAN")
    monkeypatch.setattr("backsight.plans.loop.placement_of", lambda rows: placement)
    found = {r.state: r.v for r in planning.value_iteration_sweeps(model, 0.9, 3).collect()}
    v = dict.fromkeys(range(6), 0.0)
    for _ in range(3):
        v = {s: max(sum(0.5 * (float(s == k) + 0.9 * v[(s + a + k) % 6]) for k in range(2)) for a in range(2)) for s in range(6)}
    assert found == pytest.approx(v)
