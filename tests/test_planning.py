import pytest
from pyspark.sql import functions as F

from backsight.operators import bellman as B
from backsight.operators import models as M
from backsight.operators import policies as P
from backsight.operators import priorities as PQ
from backsight.plans import planning
from backsight.sources import models as source_models
from backsight.storage import new_path
from golden import (
    PLAIN_GRID_UNIFORM_V, SLIP_GRID_GREEDY, SLIP_GRID_OPTIMAL_V, SLIP_GRID_UNIFORM_V, as_dict, plain_grid, slip_grid, uniform,
)

GAMMA = 0.95


def close(found, expected, tolerance):
    for state, value in (expected.items() if isinstance(expected, dict) else enumerate(expected)):
        assert found[state] == pytest.approx(value, abs=tolerance), state


def test_plain_grid_evaluation(spark):
    model = plain_grid(spark)
    v, history = planning.evaluate_policy(model, M.init_v(M.state_space(model)), uniform(spark, model), 1.0, 1e-4)
    close(as_dict(v, "state"), PLAIN_GRID_UNIFORM_V, 1e-2)
    assert history.orderBy("iteration").collect()[-1]["max_delta"] < 1e-4


def test_slip_grid_multiset_and_check(spark):
    model = slip_grid(spark)
    assert model.count() == 168 and model.select("state", "action", "next_state").distinct().count() == 164
    assert source_models.model_violations(model).isEmpty()
    assert source_models.model_violations(model.filter("not (state = 3 and next_state = 2)")).count() > 0
    path = new_path(spark, "model")
    model.write.parquet(path)
    assert source_models.read_model(spark, path).count() == 168


def test_evaluation_methods_agree(spark):
    model = slip_grid(spark)
    policy = uniform(spark, model)
    start = M.init_v(M.state_space(model))
    sync, _ = planning.evaluate_policy(model, start, policy, GAMMA, 1e-6)
    solved, _ = planning.solve_policy_value(model, policy, GAMMA, 1e-6)
    for v in (sync, solved):
        close(as_dict(v, "state"), SLIP_GRID_UNIFORM_V, 1e-4)
    blocks = planning.evaluate_policy_in_blocks(model, sync, policy, GAMMA, 4, 1)
    close(as_dict(blocks, "state"), SLIP_GRID_UNIFORM_V, 1e-4)


def test_blocks_see_the_blocks_before_them(spark):
    model = spark.createDataFrame(
        [(0, 0, 1.0, None, 1.0, True), (1, 0, 1.0, 0, 0.0, False), (2, 0, 1.0, 1, 0.0, False)],
        "state LONG, action LONG, probability DOUBLE, next_state LONG, reward DOUBLE, done BOOLEAN",
    )
    v = planning.evaluate_policy_in_blocks(model, M.init_v(M.state_space(model)), uniform(spark, model), 0.5, 3, 1)
    assert as_dict(v, "state") == {0: 1.0, 1: 0.5, 2: 0.25}
    together = planning.evaluate_policy_sweeps(model, M.init_v(M.state_space(model)), uniform(spark, model), 0.5, 1)
    assert as_dict(together, "state") == {0: 1.0, 1: 0.0, 2: 0.0}


@pytest.mark.parametrize("rows_per_block", [200_000, 40, 1])
def test_in_place_evaluation_reaches_the_fixed_point(spark, rows_per_block):
    """One block; several; every state with more rows than a block, on a chain, where an unused action is no outcome."""
    model = chain(spark) if rows_per_block == 1 else slip_grid(spark)
    policy = uniform(spark, model)
    if rows_per_block == 1:
        policy = policy.withColumn("policy", (F.col("action") == 1).cast("double"))
        v, rounds = planning.evaluate_policy_in_place(model, policy, 0.5, 1e-7, rows_per_block)
        # leaves with 0.1 at a half, else stays: v = 0.05 + 0.25 v
        assert as_dict(v, "state") == pytest.approx({0: 0.0, 1: 0.2 / 3, 2: 0.2 / 3, 3: 0.2 / 3}, abs=1e-6) and rounds > 1
    else:
        v, rounds = planning.evaluate_policy_in_place(model, policy, GAMMA, 1e-5, rows_per_block)
        close(as_dict(v, "state"), SLIP_GRID_UNIFORM_V, 1e-3)
        assert (rounds == 1) == (rows_per_block == 200_000)
    if rows_per_block == 40:
        with pytest.raises(planning.NotSettled):
            planning.evaluate_policy_in_place(model, policy, GAMMA, 1e-5, rows_per_block, max_rounds=1)


def test_optimal_methods_agree(spark):
    model = slip_grid(spark)
    v, _ = planning.value_iteration(model, GAMMA, 1e-6)
    close(as_dict(v, "state"), SLIP_GRID_OPTIMAL_V, 1e-4)
    q, _ = planning.q_value_iteration(model, GAMMA, 1e-4)
    close(as_dict(B.best_value(q), "state"), SLIP_GRID_OPTIMAL_V, 2e-3)
    policy = P.greedy_policy(B.q_from_v(model, v, GAMMA))
    chosen = policy.filter("policy > 0").groupBy("state").agg(F.collect_set("action").alias("a")).collect()
    assert {r.state: set(r.a) for r in chosen if r.state in SLIP_GRID_GREEDY} == SLIP_GRID_GREEDY
    assert {round(r.s, 9) for r in policy.groupBy("state").agg(F.sum("policy").alias("s")).collect()} == {1.0}


def test_policy_iteration(spark):
    model = slip_grid(spark)
    v, policy, rounds = planning.policy_iteration(model, uniform(spark, model), GAMMA, 1e-3)
    close(as_dict(v, "state"), SLIP_GRID_OPTIMAL_V, 2e-2)
    assert rounds < 20


def chain(spark):
    """0 <- 1 <- 2 <- 3 with a worse way out everywhere; v = 1, 0.5, 0.25, 0.125 at gamma 0.5."""
    rows = [(0, 0, 1.0, None, 1.0, True), (0, 1, 1.0, None, 0.0, True)]
    for s in (1, 2, 3):
        rows += [(s, 0, 1.0, s - 1, 0.0, False), (s, 1, 0.5, None, 0.1, True), (s, 1, 0.5, s, 0.0, False)]
    return spark.createDataFrame(rows, "state LONG, action LONG, probability DOUBLE, next_state LONG, reward DOUBLE, done BOOLEAN")


@pytest.mark.parametrize("rows_per_block", [200_000, 4, 1])
def test_prioritised_methods_reach_the_fixed_point(spark, rows_per_block):
    """One block; several; every state with more rows than a block is backed up by aggregation."""
    model = chain(spark)
    v, rounds = planning.prioritised_value_iteration(model, 0.5, 1e-6, rows_per_block)
    assert as_dict(v, "state") == pytest.approx({0: 1.0, 1: 0.5, 2: 0.25, 3: 0.125}, abs=1e-5) and (rounds == 1) == (rows_per_block == 200_000)
    q, _ = planning.prioritised_q_iteration(model, 0.5, 1e-6)
    assert as_dict(q, "state", "action")[(3, 1)] == pytest.approx(0.5 * 0.1 + 0.5 * 0.5 * 0.125)
    assert as_dict(B.best_value(q), "state") == pytest.approx({0: 1.0, 1: 0.5, 2: 0.25, 3: 0.125})


def test_prioritised_blocks_agree_with_value_iteration(spark):
    model = slip_grid(spark)
    v, rounds = planning.prioritised_value_iteration(model, GAMMA, 2e-3, rows_per_block=120)
    close(as_dict(v, "state"), SLIP_GRID_OPTIMAL_V, 4e-2)
    assert rounds > 1


def test_visited_states_only(spark):
    model = slip_grid(spark)
    first = spark.createDataFrame([(14,), (11,)], "state LONG")
    every = M.state_space(model)
    v, policy, batches = planning.visited_value_iteration(model, [first], GAMMA, 0.1, plateau=5)
    values = as_dict(v, "state")
    assert batches == 1 and {s for s, x in values.items() if x > 0} == {11, 14}
    v, _, batches = planning.visited_value_iteration(model, [every] * 6, GAMMA, 0.1, plateau=2)
    assert 3 <= batches <= 6
    assert {round(r.s, 9) for r in policy.groupBy("state").agg(F.sum("policy").alias("s")).collect()} == {1.0}


def test_backup_is_a_contraction(spark):
    model = slip_grid(spark)
    a = M.init_v(M.state_space(model), 0.0)
    b = M.state_space(model).withColumn("v", F.col("state") / 7.0)
    before = P.largest_change(a, b, ["state"], "v").first()[0]
    after = P.largest_change(B.optimal_backup(model, a, GAMMA), B.optimal_backup(model, b, GAMMA), ["state"], "v").first()[0]
    assert after <= GAMMA * before + 1e-12
    one = B.optimal_backup(model, b, GAMMA, state=14).collect()
    assert len(one) == 1 and one[0].state == 14


def test_priority_table(spark):
    queue = spark.createDataFrame([(1, 0.5), (2, 0.9)], "state LONG, priority DOUBLE")
    new = spark.createDataFrame([(1, 0.7), (2, 0.1), (3, 0.9)], "state LONG, priority DOUBLE")
    merged = PQ.put(queue, new, ["state"])
    assert as_dict(merged, "state") == {1: 0.7, 2: 0.9, 3: 0.9}
    top, rest = PQ.pop(merged, ["state"], 2)
    assert as_dict(top, "state") == {2: 0.9, 3: 0.9} and as_dict(rest, "state") == {1: 0.7}


def test_result_sink(spark):
    v = spark.createDataFrame([(2, 0.5), (1, 0.25)], "state LONG, v DOUBLE")
    path = source_models.write_result(v, new_path(spark, "results"), "r1", ["state"])
    assert path.endswith("run_id=r1") and as_dict(spark.read.parquet(path), "state") == {1: 0.25, 2: 0.5}
