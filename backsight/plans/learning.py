"""Learning from logged steps in batch sweeps, and policy iteration around it."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import uniform
from ..operators import backups as S
from ..operators.ordering import ROWS_PER_CHUNK, numbered
from ..operators.policies import eps_greedy_policy, policy_changes
from ..storage import settle
from .loop import NotSettled, kept, placed, placement_of, repeat, until_stable

Lookup = Callable[[DataFrame], DataFrame]


def sweep(
    statistics: DataFrame, table: DataFrame, keys: list[str], value: str, lookup: Lookup, rates: Sequence[float]
) -> DataFrame:
    """One sweep per rate over the folded statistics."""
    statistics, placement = kept(statistics, keys)
    upcoming = iter(rates)

    def step(current: DataFrame) -> DataFrame:
        # a lookup has its own number of rows; it is not marked, its size decides
        targets = S.mean_targets(statistics, lookup(current), keys)
        return S.move_towards(current, placed(targets, placement), keys, value, next(upcoming))

    try:
        # a sweep reads the table twice (lookup and own value), so plans of several sweeps grow fast
        return settle(repeat(settle(table, "start"), step, len(rates), placement, every=2), "swept")
    finally:
        statistics.unpersist()


def td0(steps: DataFrame, v: DataFrame, gamma: float, rates: Sequence[float]) -> DataFrame:
    return sweep(S.td0_statistics(steps, gamma), v, ["state"], "v", S.state_lookup, rates)


def n_step_td(steps: DataFrame, v: DataFrame, gamma: float, n: int, rates: Sequence[float]) -> DataFrame:
    return sweep(S.n_step_statistics(steps, gamma, n), v, ["state"], "v", S.state_lookup, rates)


def td_lambda(steps: DataFrame, v: DataFrame, gamma: float, trace: float, rates: Sequence[float]) -> DataFrame:
    upcoming = iter(rates)

    v = settle(v, "v")
    placement = placement_of(v.count())

    def step(current: DataFrame) -> DataFrame:
        targets = S.lambda_targets(steps, current, gamma, trace)
        return S.move_towards(current, targets, ["state"], "v", next(upcoming))

    return repeat(v, step, len(rates), placement, every=1)


PAIR = ["state", "action"]


def sarsa(
    steps: DataFrame, q: DataFrame, gamma: float, rates: Sequence[float], policy: DataFrame | None = None, seed: int = 0
) -> DataFrame:
    """Next action as logged, or drawn from ``policy`` with a draw keyed by the step."""
    draw = None if policy is None else uniform(seed, "segment", "episode", "step_count")
    statistics = S.sarsa_statistics(S.with_next_action(steps, policy, draw), gamma)
    return sweep(statistics, q, PAIR, "q", S.pair_lookup, rates)


def expected_sarsa(steps: DataFrame, q: DataFrame, policy: DataFrame, gamma: float, rates: Sequence[float]) -> DataFrame:
    policy = settle(policy, "policy")
    return sweep(S.next_state_statistics(steps, gamma), q, PAIR, "q", S.expectation_lookup(policy), rates)


def settled_values(statistics: DataFrame, q: DataFrame, tolerance: float) -> DataFrame:
    """Sweeps at rate one until no value moves by ``tolerance`` or more; raises ``NotSettled``.

    A pair without steps gets itself as its target, so that a sweep reads the table once.
    """
    idle = q.join(statistics.select(*PAIR).distinct(), PAIR, "left_anti").select(
        *PAIR, F.col("state").alias("src_state"), F.col("action").alias("src_action"),
        F.lit(0.0).alias("gain"), F.lit(1.0).alias("weight"), F.lit(1).cast("long").alias("visits"),
    )
    statistics, placement = kept(statistics.select(*idle.columns).unionByName(idle), PAIR)

    def step(current: DataFrame) -> DataFrame:
        return S.mean_targets(statistics, S.pair_lookup(current), PAIR).withColumnRenamed("target", "q")

    try:
        return until_stable(q, step, PAIR, "q", tolerance, placement)[0]
    finally:
        statistics.unpersist()


def settled_sarsa(steps: DataFrame, q: DataFrame, policy: DataFrame, gamma: float, seed: int, tolerance: float) -> DataFrame:
    """The fixed point of Sarsa with one next action per step; its draw depends on the step alone, not on the round."""
    draw = uniform(seed, "segment", "episode", "step_count")
    return settled_values(S.sarsa_statistics(S.with_next_action(steps, policy, draw), gamma), q, tolerance)


def settled_expected_sarsa(steps: DataFrame, q: DataFrame, policy: DataFrame, gamma: float, tolerance: float) -> DataFrame:
    """The fixed point of expected Sarsa: each following state counts with the policy's share of each of its pairs."""
    statistics = settle(S.next_state_statistics(steps, gamma), "statistics")
    nothing = F.lit(None).cast("long")
    own = statistics.select(*PAIR, nothing.alias("src_state"), nothing.alias("src_action"), "gain", F.lit(0.0).alias("weight"), "visits")
    shares = policy.select(F.col("state").alias("src_state"), F.col("action").alias("src_action"), "policy")
    ahead = statistics.join(shares, "src_state").select(
        *PAIR, "src_state", "src_action", F.lit(0.0).alias("gain"), (F.col("weight") * F.col("policy")).alias("weight"), F.lit(0).cast("long").alias("visits")
    )
    return settled_values(own.unionByName(ahead), q, tolerance)


def tree_backup(
    steps: DataFrame, q: DataFrame, policy: DataFrame, gamma: float, n: int, rates: Sequence[float]
) -> DataFrame:
    policy = settle(policy, "policy")
    return sweep(S.tree_backup_statistics(steps, policy, gamma, n), q, PAIR, "q", S.tree_lookup(policy), rates)


def q_learning(steps: DataFrame, q: DataFrame, gamma: float, rates: Sequence[float]) -> DataFrame:
    return sweep(S.next_state_statistics(steps, gamma), q, PAIR, "q", S.best_lookup, rates)


SWEEPS_PER_PASS = 4  # coin patterns folded in one pass: at most 2^4 rows per (state, action, next state)


def double_q_learning(
    steps: DataFrame, q: DataFrame, gamma: float, rates: Sequence[float], key: list[str], seed: int
) -> DataFrame:
    """Two tables; a coin per (step, sweep) says which one learns. Returns (state, action, q) with q their mean."""
    tables = settle(q.select(*PAIR, F.col("q").alias("q1"), F.col("q").alias("q2")), "double")
    placement = placement_of(tables.count())
    for first in range(0, len(rates), SWEEPS_PER_PASS):
        block = range(first, min(first + SWEEPS_PER_PASS, len(rates)))
        coins = [uniform(seed, F.lit(i), *key) > 0.5 for i in block]
        statistics = settle(S.double_q_statistics(steps, coins), "statistics")
        for bit, i in enumerate(block):
            tables = S.double_q_sweep(statistics, placed(tables, placement), bit, gamma, rates[i])
        tables = settle(tables, "double")
    return tables.select(*PAIR, ((F.col("q1") + F.col("q2")) / 2).alias("q"))


# --- replay of stored experience --------------------------------------------------------------------------------

def numbered_experience(steps: DataFrame, by_pair: bool, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Steps with a dense number, over all steps or within each (state, action)."""
    rows = steps.select("state", "action", "reward", "next_state", "done", "ts", "event_id")
    return settle(numbered(rows, PAIR if by_pair else [], ["ts", "event_id"], "row_no", rows_per_chunk), "experience")


def draw_experience(experience: DataFrame, count: int, seed: int, by_pair: bool) -> DataFrame:
    """``count`` draws with replacement: uniform over steps, or over the pairs seen and then over a pair's steps."""
    spark = experience.sparkSession
    draws = spark.range(count).withColumnRenamed("id", "draw")
    if not by_pair:
        total = experience.count()
        picks = draws.withColumn("row_no", (F.floor(uniform(seed, "draw") * total) + 1).cast("long"))
        return picks.join(experience, "row_no").drop("row_no")
    sizes = experience.groupBy(*PAIR).agg(F.max("row_no").alias("size"))
    pairs = settle(numbered(sizes, [], PAIR, "pair_no"), "pairs")
    total = pairs.count()
    picks = (
        draws.withColumn("pair_no", (F.floor(uniform(seed, F.lit("pair"), "draw") * total) + 1).cast("long"))
        .join(pairs, "pair_no")
        .withColumn("row_no", (F.floor(uniform(seed, F.lit("step"), "draw") * F.col("size")) + 1).cast("long"))
        .drop("size", "pair_no")
    )
    return picks.join(experience, PAIR + ["row_no"]).drop("row_no")


def dyna_q(
    steps: DataFrame,
    q: DataFrame,
    gamma: float,
    rates: Sequence[float],
    replays: int,
    seed: int,
    by_pair: bool = False,
) -> DataFrame:
    """Each round: one sweep over the real steps, one over ``replays`` redrawn ones at the same rate."""
    experience = numbered_experience(steps, by_pair)
    real = settle(S.next_state_statistics(steps, gamma), "statistics")
    current = settle(q, "q")
    for i, rate in enumerate(rates):
        redrawn = S.next_state_statistics(draw_experience(experience, replays, seed + i, by_pair), gamma)
        for statistics in (real, redrawn):
            current = sweep(statistics, current, PAIR, "q", S.best_lookup, [rate])
    return current


# --- policy iteration around an evaluator -----------------------------------------------------------------------

def generalised_policy_iteration(
    evaluate: Callable[[DataFrame, DataFrame], DataFrame],
    q: DataFrame,
    policy: DataFrame,
    eps_schedule: Sequence[float],
    max_rounds: int = 20,
) -> tuple[DataFrame, DataFrame, list[tuple[float, int, bool]]]:
    """For each eps: evaluate(q, policy), make the eps-greedy policy, until no probability changes.

    A noisy evaluator may never settle, hence the round limit. Returns q, policy and, per eps, the rounds used and whether
    the policy settled within them.
    """
    used = []
    for eps in eps_schedule:
        rounds, unchanged = 0, False
        while rounds < max_rounds and not unchanged:
            rounds += 1
            q = settle(evaluate(q, policy), "q")
            following = settle(eps_greedy_policy(q, eps), "policy")
            unchanged = policy_changes(policy, following).isEmpty()
            policy = following
        used.append((eps, rounds, unchanged))
    return q, policy, used


def settled_policy_iteration(
    evaluate: Callable[[DataFrame, DataFrame], DataFrame], q: DataFrame, policy: DataFrame, eps_schedule: Sequence[float], max_rounds: int = 50
) -> tuple[DataFrame, DataFrame]:
    """Policy iteration to an unchanged policy at every eps; raises ``NotSettled`` after ``max_rounds``."""
    q, policy, used = generalised_policy_iteration(evaluate, q, policy, eps_schedule, max_rounds)
    for eps, rounds, unchanged in used:
        if not unchanged:
            raise NotSettled(f"the policy at eps {eps:g} still changes after {rounds} rounds")
    return q, policy
