"""Arm statistics on logged pulls (context, pull_no, arm, reward), pull_no dense from 1 in each context.

A context or arm may hold most pulls. Estimates are folded as composed maps over bounded pieces of the pull order, so
no window holds a whole hot arm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordering import join_on
from .policies import eps_greedy_policy
from .scans import MAX_SPAN, compose_maps

# Fixed value: the 0.99 quantile of the standard normal distribution, the optimistic starting estimate.
OPTIMISTIC_START = 2.3263478740408408


def arm_maps(pulls: DataFrame, lr: float, span: int = MAX_SPAN) -> DataFrame:
    """Per (context, arm): the number of pulls and the map e -> scale * e + shift of all its updates in order."""
    maps = pulls.select(
        "context", "arm", "pull_no", F.lit(1.0 - lr).alias("scale"), (F.lit(float(lr)) * F.col("reward")).alias("shift")
    )
    counts = pulls.groupBy("context", "arm").agg(F.count("*").alias("n"))
    return join_on(compose_maps(maps, ["context", "arm"], "pull_no", "scale", "shift", span), counts, ["context", "arm"])


def constant_step_estimates(pulls: DataFrame, lr: float, start: float = 0.0, span: int = MAX_SPAN) -> DataFrame:
    """Estimate of each pulled arm after e += lr * (reward - e) over its pulls in order."""
    return arm_maps(pulls, lr, span).select(
        "context", "arm", "n", (F.lit(float(start)) * F.col("scale") + F.col("shift")).alias("estimate")
    )


def all_arms(arms: DataFrame, vocabulary: list[int], start: float = 0.0) -> DataFrame:
    """Add the arms of the vocabulary that a context never pulled, with n = 0 and the starting estimate."""
    known = arms.groupBy("context").agg(
        F.map_from_entries(F.collect_list(F.struct("arm", F.struct("n", "estimate")))).alias("_known")
    )
    every = known.withColumn("arm", F.explode(F.array(*[F.lit(a).cast("long") for a in vocabulary])))
    found = F.try_element_at("_known", F.col("arm"))
    return every.select(
        "context", "arm",
        F.coalesce(found["n"], F.lit(0).cast("long")).alias("n"),
        F.coalesce(found["estimate"], F.lit(float(start))).alias("estimate"),
    )


def eps_greedy_arms(arms: DataFrame, eps: float) -> DataFrame:
    return eps_greedy_policy(arms, eps, ["context"], "arm", "estimate")


def ucb_scores(arms: DataFrame, c: float) -> DataFrame:
    """estimate + c * sqrt(ln N / n) per arm; an arm never pulled scores infinity."""
    total = F.sum("n").over(W.partitionBy("context"))  # a context's few arms
    bonus = F.lit(float(c)) * F.sqrt(F.log(total) / F.col("n"))
    return arms.withColumn("score", F.when(F.col("n") == 0, F.lit(float("inf"))).otherwise(F.col("estimate") + bonus))


def ucb_choice(arms: DataFrame, c: float) -> DataFrame:
    """One arm per context: the lowest never-pulled arm, else the best score, lowest arm among equals."""
    return ucb_scores(arms, c).groupBy("context").agg(F.max_by("arm", F.struct(F.col("score"), -F.col("arm"))).alias("arm"))


def reward_curves(pulls: DataFrame, span: int = MAX_SPAN) -> DataFrame:
    """Per pull: the reward so far in its context and the mean reward of the pulled arm."""
    piece = F.floor((F.col("pull_no") - 1) / span)
    rows = pulls.withColumn("_piece", piece)
    inside = W.partitionBy("context", "_piece").orderBy("pull_no").rowsBetween(W.unboundedPreceding, W.currentRow)
    before = W.partitionBy("context").orderBy("_piece").rowsBetween(W.unboundedPreceding, -1)
    offsets = rows.groupBy("context", "_piece").agg(F.sum("reward").alias("_part")).select(
        "context", "_piece", F.coalesce(F.sum("_part").over(before), F.lit(0.0)).alias("_offset")
    )
    means = pulls.groupBy("context", "arm").agg(F.avg("reward").alias("expected_reward"))
    local = rows.withColumn("_local", F.sum("reward").over(inside))
    found = join_on(join_on(local, offsets, ["context", "_piece"]), means, ["context", "arm"])
    return found.select("context", "pull_no", "arm", (F.col("_local") + F.col("_offset")).alias("cumulative_reward"), "expected_reward")
