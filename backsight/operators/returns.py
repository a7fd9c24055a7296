"""Monte Carlo returns and evaluation on trajectories, without a loop over episodes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.schedules import learning_rate
from ..storage import settle
from .ordering import ROWS_PER_CHUNK, join_on, numbered
from .scans import compose_maps, discounted_suffix, product_suffix, span_for

EPISODE = ["segment", "episode"]


def discounted_returns(steps: DataFrame, gamma: float, span: int | None = None) -> DataFrame:
    """Add ``remaining_return``, the discounted sum of rewards from each step on."""
    return discounted_suffix(steps, EPISODE, "step_count", "reward", gamma, "remaining_return", span)


def visit_targets(returns: DataFrame) -> DataFrame:
    """Every-visit target: mean return per (episode, state)."""
    return returns.groupBy(*EPISODE, "state").agg(F.avg("remaining_return").alias("target"))


def weighted_returns(
    steps: DataFrame,
    target_policy: DataFrame,
    behaviour: DataFrame,
    gamma: float,
    span: int | None = None,
    clip: float | None = None,
) -> DataFrame:
    """Add ``ratio``, the product of target/behaviour probabilities from each step on, and ``remaining_return``.

    A step whose action one of the policies does not list is left out, as an inner join would: it takes part in the
    running calculations as a neutral step and is dropped after them.
    """
    span = span or span_for(gamma)
    odds = target_policy.join(behaviour.withColumnRenamed("policy", "_behaviour"), ["state", "action"]).select(
        "state", "action", (F.col("policy") / F.col("_behaviour")).alias("_odds")
    )
    odds = settle(odds, "odds")  # its written size decides the join, before the steps would be shuffled
    listed = F.col("_odds").isNotNull()
    step_ratio = F.coalesce(F.least("_odds", F.lit(float(clip))) if clip else F.col("_odds"), F.lit(1.0))
    rows = (
        steps.join(odds, ["state", "action"], "left")
        .withColumn("_listed", listed)
        .withColumn("_step_ratio", step_ratio)
    )
    counted = F.when(F.col("_listed"), F.col("reward")).otherwise(F.lit(0.0))
    scanned = product_suffix(rows, EPISODE, "step_count", "_step_ratio", "ratio", span)
    scanned = discounted_suffix(scanned, EPISODE, "step_count", counted, gamma, "remaining_return", span)
    return scanned.filter("_listed").drop("_odds", "_listed", "_step_ratio")


def weighted_visit_targets(weighted: DataFrame) -> DataFrame:
    """Weighted importance-sampling target per (episode, state); 0 when all weights are 0."""
    return (
        weighted.groupBy(*EPISODE, "state")
        .agg(F.sum("ratio").alias("_weight"), F.sum(F.col("ratio") * F.col("remaining_return")).alias("_total"))
        .select(*EPISODE, "state", F.when(F.col("_weight") == 0, 0.0).otherwise(F.col("_total") / F.col("_weight")).alias("target"))
    )


def blend(v: DataFrame, targets: DataFrame, lr: float) -> DataFrame:
    """One episode's update: move visited states towards their target."""
    return v.join(targets.select("state", "target"), "state", "left").select(
        "state",
        F.when(F.col("target").isNull(), F.col("v")).otherwise((1 - lr) * F.col("v") + lr * F.col("target")).alias("v"),
    )


def episode_numbers(steps: DataFrame, by_segment: bool = False, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Number episodes by their start: one sequence over everything, or one per segment."""
    starts = steps.filter(F.col("step_count") == 0).select(*EPISODE, "ts", "event_id")
    keys = ["segment"] if by_segment else []
    return numbered(starts, keys, ["ts", "event_id"], "number", rows_per_chunk).select(*EPISODE, "number")


def blend_all(
    v0: DataFrame,
    targets: DataFrame,
    numbers: DataFrame,
    base: float,
    period: float,
    power: float,
    by_segment: bool = False,
    span: int = 65_536,
) -> DataFrame:
    """All episodes' updates in episode order, in closed form.

    An episode maps v of a visited state to (1 - lr) * v + lr * target. Maps compose, so the whole sequence is one
    (scale, shift) per state.
    """
    lr = learning_rate(F.col("number") - 1, base, period, power)
    maps = (
        join_on(targets, numbers, EPISODE)
        .withColumn("_lr", lr)
        .withColumn("shift", F.col("_lr") * F.col("target"))
        .withColumn("scale", 1 - F.col("_lr"))
    )
    keys = ["segment", "state"] if by_segment else ["state"]
    folded = compose_maps(maps, keys, "number", "scale", "shift", span)
    if by_segment:
        return folded.join(v0, "state").select("segment", "state", (F.col("scale") * F.col("v") + F.col("shift")).alias("v"))
    return v0.join(folded, "state", "left").select(
        "state", F.coalesce(F.col("scale") * F.col("v") + F.col("shift"), F.col("v")).alias("v")
    )


def monte_carlo_evaluation(
    steps: DataFrame, v0: DataFrame, gamma: float, base: float, period: float, power: float, by_segment: bool = False
) -> DataFrame:
    targets = visit_targets(discounted_returns(steps, gamma))
    return blend_all(v0, targets, episode_numbers(steps, by_segment), base, period, power, by_segment)


def off_policy_monte_carlo_evaluation(
    steps: DataFrame,
    v0: DataFrame,
    target_policy: DataFrame,
    behaviour: DataFrame,
    gamma: float,
    base: float,
    period: float,
    power: float,
    by_segment: bool = False,
    clip: float | None = None,
) -> DataFrame:
    targets = weighted_visit_targets(weighted_returns(steps, target_policy, behaviour, gamma, clip=clip))
    return blend_all(v0, targets, episode_numbers(steps, by_segment), base, period, power, by_segment)
