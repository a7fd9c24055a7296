"""Sufficient statistics of temporal-difference targets.

The mean target of a key is linear in a few numbers looked up in the current table, so one pass over the steps folds
them into one row per (key, source):

    mean target(key) = sum over sources of (gain + weight * lookup(source)) / sum of visits

Every sweep then runs on this small table and never on the raw steps. The fold combines map-side, so hot states and
actions are not a problem, and looking further ahead uses windows over bounded pieces of an episode.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .bellman import best_value
from .models import policy_value
from .policies import sample_action
from .returns import EPISODE
from .scans import MAX_SPAN, discounted_suffix, span_for, with_halo

SMALL = 1e-3  # below this discount at most 110 powers differ from zero


def fold(rows: DataFrame, keys: list[str], sources: list[str], gain: Column, weight: Column, visits: Column) -> DataFrame:
    return rows.groupBy(*keys, *sources).agg(
        F.sum(gain).alias("gain"), F.sum(weight).alias("weight"), F.sum(visits).alias("visits")
    )


def _following(gamma: float, has_next: Column) -> Column:
    return F.when(has_next, F.lit(float(gamma))).otherwise(F.lit(0.0))


def one_visit() -> Column:
    return F.lit(1).cast("long")


def td0_statistics(steps: DataFrame, gamma: float) -> DataFrame:
    """r + gamma * v(next state), per state."""
    rows = steps.select("state", "reward", F.when(~F.col("done"), F.col("next_state")).alias("src_state"))
    return fold(rows, ["state"], ["src_state"], F.col("reward"), _following(gamma, F.col("src_state").isNotNull()), one_visit())


def n_step_statistics(steps: DataFrame, gamma: float, n: int) -> DataFrame:
    """n discounted rewards, then gamma^n * v of the state n steps on; shorter without it at the episode's end."""
    return fold(
        n_step_targets(steps, gamma, n), ["state"], ["src_state"], F.col("partial_return"),
        _following(gamma**n, F.col("src_state").isNotNull()), one_visit(),
    )


def n_step_targets(steps: DataFrame, gamma: float, n: int) -> DataFrame:
    """Per step: ``partial_return`` over at most n rewards and ``src_state``, the state n steps on."""
    slim = steps.select(*EPISODE, "step_count", "state", "reward")
    piece = W.partitionBy(*EPISODE, "_piece").orderBy("step_count")
    if gamma < SMALL:  # powers of the discount vanish within few steps, so a window sum over them would divide by zero
        terms = min(n, 1 if gamma == 0 else math.ceil(330 / -math.log10(gamma)))
        ahead = [F.lit(gamma**i) * F.coalesce(F.lead("reward", i).over(piece), F.lit(0.0)) for i in range(terms)]
        return (
            with_halo(slim, "step_count", n, max(MAX_SPAN, n + 1))
            .withColumn("partial_return", reduce(lambda a, b: a + b, ahead))
            .withColumn("src_state", F.lead("state", n).over(piece))
            .filter(~F.col("_ghost"))
            .drop("_piece", "_ghost")
        )
    span = max(span_for(gamma) // 2, n + 1)
    rows = with_halo(slim, "step_count", n, span)
    factor = F.pow(F.lit(float(gamma)), (F.col("step_count") - F.col("_piece") * span).cast("double"))
    return (
        rows.withColumn("_factor", factor)
        .withColumn(
            "partial_return", F.sum(F.col("reward") * F.col("_factor")).over(piece.rowsBetween(0, n - 1)) / F.col("_factor")
        )
        .withColumn("src_state", F.lead("state", n).over(piece))
        .filter(~F.col("_ghost"))
        .drop("_factor", "_piece", "_ghost")
    )


def with_next_action(steps: DataFrame, policy: DataFrame | None = None, draw: Column | None = None) -> DataFrame:
    """Add ``next_action``: the logged one, or one drawn from ``policy`` at the next state."""
    if policy is None:
        rows = with_halo(steps, "step_count", 1)
        piece = W.partitionBy(*EPISODE, "_piece").orderBy("step_count")
        return rows.withColumn("next_action", F.lead("action").over(piece)).filter(~F.col("_ghost")).drop("_piece", "_ghost")
    drawn = sample_action(steps.filter(~F.col("done")), policy, draw, "next_action", "next_state")
    return drawn.unionByName(steps.filter("done").withColumn("next_action", F.lit(None).cast("long")))


def sarsa_statistics(steps_with_next_action: DataFrame, gamma: float) -> DataFrame:
    """r + gamma * q(next state, next action)."""
    rows = steps_with_next_action.select(
        "state", "action", "reward",
        F.when(~F.col("done"), F.col("next_state")).alias("src_state"),
        F.when(~F.col("done"), F.col("next_action")).alias("src_action"),
    )
    going_on = F.col("src_state").isNotNull() & F.col("src_action").isNotNull()
    return fold(rows, ["state", "action"], ["src_state", "src_action"], F.col("reward"), _following(gamma, going_on), one_visit())


def next_state_statistics(steps: DataFrame, gamma: float) -> DataFrame:
    """r + gamma * (some value of the next state), per pair: expected Sarsa and Q-learning."""
    rows = steps.select("state", "action", "reward", F.when(~F.col("done"), F.col("next_state")).alias("src_state"))
    return fold(
        rows, ["state", "action"], ["src_state"], F.col("reward"), _following(gamma, F.col("src_state").isNotNull()), one_visit()
    )


def tree_backup_statistics(steps: DataFrame, policy: DataFrame, gamma: float, n: int) -> DataFrame:
    """n-step tree backup: at each later step the untaken actions enter by expectation, the taken one by its reward.

    A step k ahead contributes f_k * (expectation over the state - p_k * q of the taken pair + p_k * r_k), where p_k is
    the policy's probability of the taken action and f_k the product of gamma and the earlier p; step n contributes
    f_n * expectation. ``src_kind`` says which of the two is looked up.
    """
    listed = policy.select("state", "action", F.col("policy").alias("_p"))
    rows = with_halo(
        steps.select(*EPISODE, "step_count", "state", "action", "reward").join(listed, ["state", "action"], "left"),
        "step_count", n,
    ).withColumn("_p", F.coalesce("_p", F.lit(0.0)))
    piece = W.partitionBy(*EPISODE, "_piece").orderBy("step_count")
    ahead = F.struct("state", "action", "reward", "_p")
    for k in range(1, n + 1):
        rows = rows.withColumn(f"_s{k}", F.lead(ahead, k).over(piece))
    rows = rows.filter(~F.col("_ghost"))
    factor, gain = F.lit(float(gamma)), F.col("reward")
    terms = []
    for k in range(1, n + 1):
        later = F.col(f"_s{k}")
        kind = "untaken" if k < n else "all"
        terms.append(
            F.struct(
                later["state"].alias("src_state"),
                (later["action"] if k < n else F.lit(0).cast("long")).alias("src_action"),
                F.lit(kind).alias("src_kind"),
                F.lit(0.0).alias("gain"), factor.alias("weight"), F.lit(0).cast("long").alias("visits"),
            )
        )
        if k < n:
            gain = gain + F.coalesce(factor * later["_p"] * later["reward"], F.lit(0.0))
            factor = factor * F.lit(float(gamma)) * F.coalesce(later["_p"], F.lit(0.0))
    own = F.struct(
        F.lit(None).cast("long").alias("src_state"), F.lit(None).cast("long").alias("src_action"),
        F.lit("own").alias("src_kind"), gain.alias("gain"), F.lit(0.0).alias("weight"), one_visit().alias("visits"),
    )
    parts = rows.select("state", "action", F.explode(F.array(own, *terms)).alias("_t")).select("state", "action", "_t.*")
    kept = parts.filter((F.col("visits") > 0) | F.col("src_state").isNotNull())
    return fold(
        kept, ["state", "action"], ["src_state", "src_action", "src_kind"], F.col("gain"), F.col("weight"), F.col("visits")
    )


# lookups: what a sweep reads from the current table --------------------------------------------------------------

def state_lookup(v: DataFrame) -> DataFrame:
    return v.select(F.col("state").alias("src_state"), F.col("v").alias("lookup"))


def pair_lookup(q: DataFrame) -> DataFrame:
    return q.select(F.col("state").alias("src_state"), F.col("action").alias("src_action"), F.col("q").alias("lookup"))


def best_lookup(q: DataFrame) -> DataFrame:
    return state_lookup(best_value(q))


def expectation_lookup(policy: DataFrame) -> Callable[[DataFrame], DataFrame]:
    return lambda q: state_lookup(policy_value(q, policy))


def tree_lookup(policy: DataFrame) -> Callable[[DataFrame], DataFrame]:
    """Expectation of each state, and for each pair the expectation over the actions other than its own."""

    def lookup(q: DataFrame) -> DataFrame:
        every = W.partitionBy("state")  # a state's few actions
        rows = (
            q.join(policy, ["state", "action"])
            .withColumn("_share", F.col("policy") * F.col("q"))
            .withColumn("_all", F.sum("_share").over(every))
            .withColumn("_first", F.col("action") == F.min("action").over(every))
        )
        untaken = F.struct(
            F.col("action").alias("src_action"), F.lit("untaken").alias("src_kind"), (F.col("_all") - F.col("_share")).alias("lookup")
        )
        total = F.struct(F.lit(0).cast("long").alias("src_action"), F.lit("all").alias("src_kind"), F.col("_all").alias("lookup"))
        found = F.when(F.col("_first"), F.array(untaken, total)).otherwise(F.array(untaken))
        return rows.select(F.col("state").alias("src_state"), F.inline(found))

    return lookup


def mean_targets(statistics: DataFrame, lookup: DataFrame, keys: list[str]) -> DataFrame:
    sources = [c for c in lookup.columns if c != "lookup"]
    return (
        statistics.join(lookup, sources, "left")
        .groupBy(*keys)
        .agg((F.sum(F.col("gain") + F.col("weight") * F.coalesce("lookup", F.lit(0.0))) / F.sum("visits")).alias("target"))
    )


def move_towards(table: DataFrame, targets: DataFrame, keys: list[str], value: str, lr: float) -> DataFrame:
    """value + lr * (target - value) for keys with a target, the others unchanged."""
    moved = F.col(value) + F.lit(float(lr)) * (F.col("target") - F.col(value))
    return table.join(targets, keys, "left").select(*keys, F.coalesce(moved, F.col(value)).alias(value))


# --- forms that need the steps in every sweep -------------------------------------------------------------------

def lambda_targets(steps: DataFrame, v: DataFrame, gamma: float, trace: float) -> DataFrame:
    """Mean lambda-return per state: v(s) plus the (gamma * trace)-discounted sum of one-step errors from the step on."""
    here = v.select("state", F.col("v").alias("_here"))
    there = v.select(F.col("state").alias("_to"), F.col("v").alias("_there"))
    # a last step has no next state; its lookup is ignored, so its key only has to spread over the partitions
    spread = F.when(F.col("done"), F.xxhash64(*EPISODE, "step_count")).otherwise(F.col("next_state"))
    errors = (
        steps.select(*EPISODE, "step_count", "state", "reward", "done", spread.alias("_to"))
        .join(here, "state", "left")
        .join(there, "_to", "left")
        .withColumn("_here", F.coalesce("_here", F.lit(0.0)))
        .withColumn("_there", F.when(F.col("done"), 0.0).otherwise(F.coalesce("_there", F.lit(0.0))))
        .withColumn("_error", F.col("reward") + F.lit(float(gamma)) * F.col("_there") - F.col("_here"))
    )
    scanned = discounted_suffix(errors, EPISODE, "step_count", "_error", gamma * trace, "_ahead")
    return scanned.groupBy("state").agg(F.avg(F.col("_here") + F.col("_ahead")).alias("target"))


def double_q_statistics(steps: DataFrame, coins: list[Column]) -> DataFrame:
    """Counts per (state, action, next state, coin pattern): one pass over the steps serves several sweeps."""
    pattern = sum((F.when(coin, F.lit(2**i)).otherwise(F.lit(0)) for i, coin in enumerate(coins)), F.lit(0))
    rows = steps.select("state", "action", "reward", F.when(~F.col("done"), F.col("next_state")).alias("src_state"), pattern.alias("coins"))
    return rows.groupBy("state", "action", "src_state", "coins").agg(F.sum("reward").alias("gain"), F.count("*").alias("visits"))


def double_q_sweep(statistics: DataFrame, tables: DataFrame, bit: int, gamma: float, lr: float) -> DataFrame:
    """One sweep over (state, action, q1, q2): heads move q1 with q2's value of q1's best action, tails the reverse."""
    critics = tables.groupBy(F.col("state").alias("src_state")).agg(
        F.max_by("q2", F.struct(F.col("q1"), -F.col("action"))).alias("_for1"),
        F.max_by("q1", F.struct(F.col("q2"), -F.col("action"))).alias("_for2"),
    )
    heads = F.col("coins").bitwiseAND(F.lit(2**bit)) != 0
    rows = statistics.join(critics, "src_state", "left").withColumn("_heads", heads)

    def mean(side: Column, critic: str) -> Column:
        total = F.col("gain") + F.lit(float(gamma)) * F.col("visits") * F.coalesce(critic, F.lit(0.0))
        return F.sum(F.when(side, total)) / F.sum(F.when(side, F.col("visits")))

    targets = rows.groupBy("state", "action").agg(
        mean(F.col("_heads"), "_for1").alias("_t1"), mean(~F.col("_heads"), "_for2").alias("_t2")
    )

    def moved(name: str, target: str) -> Column:
        return F.coalesce(F.col(name) + F.lit(float(lr)) * (F.col(target) - F.col(name)), F.col(name)).alias(name)

    return tables.join(targets, ["state", "action"], "left").select("state", "action", moved("q1", "_t1"), moved("q2", "_t2"))
