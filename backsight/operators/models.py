"""Empirical models, value/policy tables and state spaces."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def empirical_model(transitions: DataFrame) -> DataFrame:
    """Counts, mean rewards and outcome probabilities per (state, action, next_state); null next_state = terminal."""
    counts = transitions.groupBy("state", "action", "next_state").agg(
        F.count("*").alias("experience_count"), F.avg("reward").alias("reward")
    )
    return with_probability(counts)


def with_probability(counts: DataFrame) -> DataFrame:
    """Add ``probability`` = share of the (state, action) total and ``done``; totals by aggregate and join."""
    totals = counts.groupBy("state", "action").agg(F.sum("experience_count").alias("_total"))
    return counts.join(totals, ["state", "action"]).select(
        "state",
        "action",
        "next_state",
        "reward",
        "experience_count",
        (F.col("experience_count") / F.col("_total")).alias("probability"),
        F.col("next_state").isNull().alias("done"),
    )


def upsert_model(model: DataFrame, batch: DataFrame) -> DataFrame:
    """Fold a batch of transitions into the running counts and mean rewards; the model side is never re-read raw."""
    seen = batch.groupBy("state", "action", "next_state").agg(
        F.count("*").alias("experience_count"), F.avg("reward").alias("reward")
    )
    merged = (
        model.select("state", "action", "next_state", "experience_count", "reward")
        .unionByName(seen)
        .groupBy("state", "action", "next_state")
        .agg(
            (F.sum(F.col("reward") * F.col("experience_count")) / F.sum("experience_count")).alias("reward"),
            F.sum("experience_count").alias("experience_count"),
        )
    )
    return with_probability(merged)


def state_space(table: DataFrame) -> DataFrame:
    return table.select("state").distinct()


def action_space(table: DataFrame) -> DataFrame:
    return table.select("action").distinct()


def space_sizes(table: DataFrame) -> DataFrame:
    """Distinct states, actions and pairs in one row."""
    pairs = table.select("state", "action").distinct()
    return pairs.agg(
        F.countDistinct("state").alias("n_states"),
        F.countDistinct("action").alias("n_actions"),
        F.count("*").alias("n_pairs"),
    )


def state_actions(states: DataFrame, actions: DataFrame | list[int]) -> DataFrame:
    """Every state with every action of the (small, declared or observed) action vocabulary.

    The vocabulary reaches the states as one array value, so the states stay in place.
    """
    if isinstance(actions, DataFrame):
        vocabulary = actions.agg(F.array_sort(F.collect_set("action"))).scalar()
    else:
        vocabulary = F.array(*[F.lit(a).cast("long") for a in actions])
    return states.select("state", vocabulary.alias("_actions")).select("state", F.explode("_actions").alias("action"))


def init_v(states: DataFrame, value: float = 0.0) -> DataFrame:
    return states.select("state", F.lit(value).alias("v"))


def init_q(states: DataFrame, actions: DataFrame | list[int], value: float = 0.0) -> DataFrame:
    return state_actions(states, actions).withColumn("q", F.lit(value))


def uniform_policy(states: DataFrame, actions: DataFrame | list[int]) -> DataFrame:
    pairs = state_actions(states, actions)
    return pairs.withColumn("policy", F.lit(1.0) / F.count("*").over(W.partitionBy("state")))


# The example target policy prefers action 1.
TARGET_BASE = 0.1
TARGET_EXTRA = 0.6


def preferring_policy(
    states: DataFrame, actions: DataFrame | list[int], preferred: int = 1, base: float = TARGET_BASE, extra: float = TARGET_EXTRA
) -> DataFrame:
    """base for every action plus ``extra`` for the preferred one."""
    return state_actions(states, actions).withColumn(
        "policy", F.lit(base) + F.lit(extra) * (F.col("action") == preferred).cast("double")
    )


def behaviour_policy(transitions: DataFrame) -> DataFrame:
    """Action shares per state, counted from the log."""
    pairs = transitions.groupBy("state", "action").agg(F.count("*").alias("n"))
    return pairs.select(
        "state", "action", (F.col("n") / F.sum("n").over(W.partitionBy("state"))).alias("policy")
    )


def matrix_view(table: DataFrame, value: str, actions: list[int]) -> DataFrame:
    """One row per state, one column per action; holes become 0."""
    return (
        table.groupBy("state")
        .pivot("action", actions)
        .agg(F.first(value))
        .na.fill(0.0)
        .select("state", *[F.col(str(a)).alias(f"a{a}") for a in actions])
    )


def policy_value(q: DataFrame, policy: DataFrame) -> DataFrame:
    """Policy-weighted action values per state."""
    return q.join(policy, ["state", "action"]).groupBy("state").agg(F.sum(F.col("policy") * F.col("q")).alias("v"))
