"""Planning over a model table: evaluation, policy iteration, value iteration, prioritised and visited-state sweeps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bellman as B
from ..operators.models import init_q, init_v, state_space
from ..operators.policies import eps_greedy_over_all_actions, greedy_policy, policy_changes
from ..storage import settle
from .loop import NotSettled, checked, kept, placed, repeat, until_stable
from .prioritised import ROWS_PER_BLOCK, prioritised_values


def evaluate_policy(
    model: DataFrame, v: DataFrame, policy: DataFrame, gamma: float, tolerance: float, max_rounds: int = 1_000
) -> tuple[DataFrame, DataFrame]:
    """Synchronous sweeps until the largest change is below the tolerance."""
    # the policy never changes between sweeps, so it is joined to the model once
    weighted, placement = kept(_policy_weighted(model, policy), ["state"])
    try:
        return until_stable(
            v, lambda t: _weighted_sweep(weighted, t, gamma), ["state"], "v", tolerance, placement, max_rounds
        )
    finally:
        weighted.unpersist()


def evaluate_policy_sweeps(model: DataFrame, v: DataFrame, policy: DataFrame, gamma: float, sweeps: int) -> DataFrame:
    weighted, placement = kept(_policy_weighted(model, policy), ["state"])
    try:
        return settle(repeat(v, lambda t: _weighted_sweep(weighted, t, gamma), sweeps, placement), "swept")
    finally:
        weighted.unpersist()


def _policy_weighted(model: DataFrame, policy: DataFrame) -> DataFrame:
    """Model folded over actions: one row per (state, next_state) with its weight and weighted reward."""
    rows = model.join(policy, ["state", "action"]).withColumn("_share", F.col("policy") * F.col("probability"))
    return rows.groupBy("state", "next_state", "done").agg(
        F.sum("_share").alias("weight"), F.sum(F.col("_share") * F.col("reward")).alias("gain")
    )


def _weighted_sweep(weighted: DataFrame, v: DataFrame, gamma: float) -> DataFrame:
    rows = B.with_next_value(weighted, v)
    return rows.groupBy("state").agg(F.sum(F.col("gain") + gamma * F.col("weight") * F.col("next_v")).alias("v"))


def evaluate_policy_in_blocks(
    model: DataFrame, v: DataFrame, policy: DataFrame, gamma: float, blocks: int, sweeps: int
) -> DataFrame:
    """In-place sweeps: blocks of states in order, each block seeing the values of the blocks before it."""
    weighted, placement = kept(_policy_weighted(model, policy), ["state"])
    turn = 0
    try:
        for _ in range(sweeps):
            for block in range(blocks):
                part = weighted.filter(F.pmod(F.col("state"), F.lit(blocks)) == block)
                v = settle(v, "block") if turn % 3 == 0 else v
                here = placed(v, placement)
                v = B.merge_values(here, placed(_weighted_sweep(part, here, gamma), placement), ["state"], "v")
                turn += 1
        return settle(v, "swept")
    finally:
        weighted.unpersist()


def evaluate_policy_in_place(
    model: DataFrame, policy: DataFrame, gamma: float, tolerance: float, rows_per_block: int = ROWS_PER_BLOCK, max_rounds: int = 10_000
) -> tuple[DataFrame, int]:
    """In-place evaluation to a tolerance: (state, v) and the number of rounds.

    Under a fixed policy the model is a chain, one folded row per (state, next_state). Blocks of its states are solved in
    their tasks and overwrite their values; a block that reads a changed value is solved again, the most stale ones first
    (``plans/prioritised.py``). Values end within tolerance / (1 - gamma) of the fixed point, or ``NotSettled`` is raised.
    States without a row in ``policy`` have no value, as in ``evaluate_policy``.
    """
    weighted = _policy_weighted(model, policy).where("weight > 0")
    chain = weighted.select(
        "state", F.lit(0).cast("long").alias("action"), "next_state", "done", F.col("weight").alias("probability"),
        (F.col("gain") / F.col("weight")).alias("reward"),
    )
    return prioritised_values(chain, gamma, tolerance, rows_per_block, max_rounds)


def solve_policy_value(
    model: DataFrame, policy: DataFrame, gamma: float, tolerance: float, max_rounds: int = 1_000
) -> tuple[DataFrame, DataFrame]:
    """Solve (I - gamma P) v = b by Jacobi rounds on the (row, column, coefficient) table."""
    left, right = B.linear_system(model, policy, gamma)
    left, placement = kept(left, ["state"])
    diagonal = settle(
        right.join(
            left.filter(F.col("state") == F.col("next_state")).select("state", F.col("coefficient").alias("a_ii")), "state"
        ),
        "diagonal",
    )
    off_diagonal = left.filter(F.col("state") != F.col("next_state"))

    def step(v: DataFrame) -> DataFrame:
        return B.jacobi_step(off_diagonal, placed(diagonal, placement), v)

    try:
        return until_stable(init_v(diagonal), step, ["state"], "v", tolerance, placement, max_rounds)
    finally:
        left.unpersist()


def value_iteration(
    model: DataFrame, gamma: float, tolerance: float, max_rounds: int = 1_000
) -> tuple[DataFrame, DataFrame]:
    model, placement = kept(model, ["state"])
    try:
        return until_stable(
            init_v(state_space(model)), lambda v: B.optimal_backup(model, v, gamma), ["state"], "v", tolerance, placement,
            max_rounds,
        )
    finally:
        model.unpersist()


def value_iteration_sweeps(model: DataFrame, gamma: float, sweeps: int) -> DataFrame:
    model, placement = kept(model, ["state"])
    try:
        return settle(repeat(init_v(state_space(model)), lambda v: B.optimal_backup(model, v, gamma), sweeps, placement), "swept")
    finally:
        model.unpersist()


def q_value_iteration(
    model: DataFrame, gamma: float, tolerance: float, max_rounds: int = 1_000
) -> tuple[DataFrame, DataFrame]:
    model, placement = kept(model, ["state", "action"])
    start = model.select("state", "action").distinct().withColumn("q", F.lit(0.0))
    try:
        return until_stable(
            start, lambda q: B.optimal_q_backup(model, q, gamma), ["state", "action"], "q", tolerance, placement, max_rounds
        )
    finally:
        model.unpersist()


def q_value_iteration_sweeps(model: DataFrame, gamma: float, sweeps: int) -> DataFrame:
    model, placement = kept(model, ["state", "action"])
    start = model.select("state", "action").distinct().withColumn("q", F.lit(0.0))
    try:
        return settle(repeat(start, lambda q: B.optimal_q_backup(model, q, gamma), sweeps, placement), "swept")
    finally:
        model.unpersist()


def policy_iteration(
    model: DataFrame, policy: DataFrame, gamma: float, tolerance: float, max_rounds: int = 100
) -> tuple[DataFrame, DataFrame, int]:
    """Evaluate, improve, stop when no probability changes; returns v, policy and the number of rounds."""
    model, placement = kept(model, ["state"])
    policy = settle(policy, "policy")
    rounds = 0
    try:
        for rounds in range(1, max_rounds + 1):
            v, _ = evaluate_policy_in_place(model, checked(policy), gamma, tolerance)
            improved = settle(greedy_policy(B.q_from_v(model, placed(v, placement), gamma)), "policy")
            unchanged = policy_changes(policy, checked(improved)).isEmpty()
            policy = improved
            if unchanged:
                return v, policy, rounds
    finally:
        model.unpersist()
    raise NotSettled(f"the policy still changes after {rounds} rounds")


def visited_value_iteration(
    model: DataFrame, visits: Iterable[DataFrame], gamma: float, eps: float, plateau: int
) -> tuple[DataFrame, DataFrame, int]:
    """Back up only the states each logged batch visits; stop after ``plateau`` batches without a policy change."""
    model, placement = kept(model, ["state"])
    v = settle(init_v(state_space(model)), "v")
    n_actions = model.select("action").distinct().count()
    policy, last_change, batch = None, 0, 0
    try:
        for batch, visited in enumerate(visits, start=1):
            # the visited states are few beside the batch they come from
            seen = checked(settle(visited.select("state").distinct(), "visited"))
            fresh = B.optimal_backup(model.join(seen, "state", "left_semi"), placed(v, placement), gamma)
            v = settle(B.merge_values(placed(v, placement), placed(fresh, placement), ["state"], "v"), "v")
            q = B.q_from_v(model, placed(v, placement), gamma)
            updated = settle(eps_greedy_over_all_actions(q, eps, n_actions), "policy")
            if policy is None or not policy_changes(policy, checked(updated)).isEmpty():
                last_change = batch
            policy = updated
            if batch - last_change >= plateau:
                break
    finally:
        model.unpersist()
    return v, policy, batch


def prioritised_value_iteration(model: DataFrame, gamma: float, tolerance: float, rows_per_block: int = ROWS_PER_BLOCK, max_rounds: int = 10_000) -> tuple[DataFrame, int]:
    """Values at the fixed point by prioritised sweeps over blocks of states, and the number of rounds."""
    return prioritised_values(model, gamma, tolerance, rows_per_block, max_rounds)


def prioritised_q_iteration(model: DataFrame, gamma: float, tolerance: float, rows_per_block: int = ROWS_PER_BLOCK, max_rounds: int = 10_000) -> tuple[DataFrame, int]:
    """The same on (state, action) pairs: the expected targets of all pairs under the values that the sweeps reach."""
    v, rounds = prioritised_values(model, gamma, tolerance, rows_per_block, max_rounds)
    return B.q_from_v(model, settle(v, "values"), gamma), rounds
