import math

import pytest
from pyspark.sql import functions as F

from backsight.functions import schedules
from backsight.functions.draws import uniform as draw
from backsight.operators import models as M
from backsight.operators import policies as P
from golden import as_dict, policy_rows


def q_table(spark):
    return spark.createDataFrame(
        [(0, 0, 1.0), (0, 1, 1.0 + 1e-12), (0, 2, 0.5), (1, 0, -1.0), (1, 1, -2.0), (1, 2, -3.0)], "state LONG, action LONG, q DOUBLE"
    )


def test_ties_share_the_greedy_choice(spark):
    assert as_dict(P.greedy_policy(q_table(spark)), "state", "action") == {
        (0, 0): 0.5, (0, 1): 0.5, (0, 2): 0.0, (1, 0): 1.0, (1, 1): 0.0, (1, 2): 0.0,
    }
    mixed = as_dict(P.eps_greedy_policy(q_table(spark), 0.3), "state", "action")
    assert mixed[0, 0] == pytest.approx(0.45) and mixed[1, 2] == pytest.approx(0.1)
    partial = q_table(spark).filter("not (state = 1 and action = 2)")
    local = as_dict(P.eps_greedy_policy(partial, 0.3), "state", "action")
    everywhere = as_dict(P.eps_greedy_over_all_actions(partial, 0.3), "state", "action")
    assert local[1, 1] == pytest.approx(0.15) and everywhere[1, 1] == pytest.approx(0.1)


def test_softmax_is_stable(spark):
    q = spark.createDataFrame([(0, 0, 1000.0), (0, 1, 1001.0)], "state LONG, action LONG, q DOUBLE")
    assert as_dict(P.softmax_policy(q, "q", ["state"], "action"), "state", "action")[0, 1] == pytest.approx(1 / (1 + math.exp(-1)))


def test_first_best_and_greedy_draw(spark):
    q = q_table(spark).withColumn("q", F.round("q", 6))
    assert as_dict(P.first_best(q, "q", ["state"], "action"), "state") == {0: 0, 1: 0}
    picks = {as_dict(P.greedy_draw(q, "q", ["state"], "action", seed), "state")[0] for seed in range(12)}
    assert picks == {0, 1}


def test_draw_frequencies(spark):
    rows = policy_rows(1, states=2)
    policy = spark.createDataFrame(rows + [(2, 0, 0.0), (2, 1, 1.0)], "state LONG, action LONG, policy DOUBLE")
    count = 20_000
    asked = spark.range(count).select("id", (F.col("id") % 3).alias("state"))
    drawn = P.sample_action(asked, policy, draw(7, "id"))
    found = as_dict(drawn.groupBy("state", "action").count(), "state", "action")
    assert sum(found.values()) == count and (2, 0) not in found
    for s, a, p in rows:
        n = count / 3
        assert abs(found[s, a] - n * p) < 4 * math.sqrt(n * p * (1 - p)) + 1
    again = P.sample_action(asked.repartition(7), policy, draw(7, "id"))
    assert again.exceptAll(drawn).isEmpty()


def test_schedules(spark):
    table = schedules.schedule_table(
        spark, 5, eps=schedules.spaced(F.col("number"), 1.0, 0.0, 5), lr=schedules.learning_rate(F.col("number"), 0.1, 2, 0.5)
    ).orderBy("number").collect()
    assert [r.eps for r in table] == schedules.spaced_values(1.0, 0.0, 5)
    assert [r.lr for r in table] == pytest.approx([schedules.learning_rate_value(i, 0.1, 2, 0.5) for i in range(5)])
    assert schedules.learning_rate_value(1, 0.1, 2, 0.5) == 0.1


def test_tables(spark):
    states = spark.createDataFrame([(0,), (1,)], "state LONG")
    observed = spark.createDataFrame([(0, 0), (1, 2), (0, 2)], "state LONG, action LONG")
    assert M.init_q(states, M.action_space(observed)).count() == 4
    assert as_dict(M.preferring_policy(states, [0, 1, 2, 3]), "state", "action")[1, 1] == pytest.approx(0.7)
    assert M.space_sizes(observed).first().asDict() == {"n_states": 2, "n_actions": 2, "n_pairs": 3}
    view = M.matrix_view(observed.withColumn("q", F.lit(2.0)), "q", [0, 1, 2]).orderBy("state").collect()
    assert [tuple(r) for r in view] == [(0, 2.0, 0.0, 2.0), (1, 0.0, 0.0, 2.0)]


def test_model_upsert_equals_one_pass(spark):
    from golden import random_episodes, transitions

    steps = transitions(spark, random_episodes(4, 30))
    whole = M.empirical_model(steps)
    first = M.empirical_model(steps.filter("episode <= 10"))
    folded = M.upsert_model(M.upsert_model(first, steps.filter("episode between 11 and 20")), steps.filter("episode > 20"))
    a = {(r.state, r.action, r.next_state): (r.experience_count, round(r.reward, 9), round(r.probability, 9)) for r in whole.collect()}
    b = {(r.state, r.action, r.next_state): (r.experience_count, round(r.reward, 9), round(r.probability, 9)) for r in folded.collect()}
    assert a == b
    changed = P.policy_changes(M.behaviour_policy(steps), M.behaviour_policy(steps.filter("episode > 1")))
    assert changed.count() > 0 and P.policy_changes(M.behaviour_policy(steps), M.behaviour_policy(steps)).isEmpty()
