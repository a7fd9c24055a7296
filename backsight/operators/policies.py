"""Policies over action values: improvement, exploration, sampling, comparison.

Windows here run over the actions of one state (or the arms of one context), a group bounded by the vocabulary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.draws import uniform
from ..storage import settle

TIE = 1e-9  # values closer than this to the maximum share the greedy choice


def greedy_share(value: str, group: list[str], tie: float = TIE) -> Column:
    """1/number of maximal entries for the maximal entries of the group, else 0."""
    over = W.partitionBy(*group)
    best = (F.col(value) >= F.max(value).over(over) - tie).cast("double")
    return F.when(F.col(value) >= F.max(value).over(over) - tie, 1.0).otherwise(0.0) / F.sum(best).over(over)


def eps_greedy_policy(q: DataFrame, eps: float, group: list[str] | None = None, item: str = "action", value: str = "q") -> DataFrame:
    """(1 - eps) * greedy share + eps spread over the group's own entries."""
    group = group or ["state"]
    spread = F.lit(float(eps)) / F.count("*").over(W.partitionBy(*group))
    return q.select(*group, item, (F.lit(1.0 - eps) * greedy_share(value, group) + spread).alias("policy"))


def greedy_policy(q: DataFrame) -> DataFrame:
    return q.select("state", "action", greedy_share("q", ["state"]).alias("policy"))


def eps_greedy_over_all_actions(q: DataFrame, eps: float, n_actions: int | None = None) -> DataFrame:
    """Greedy policy mixed with eps / (number of actions anywhere in the table)."""
    count = q.agg(F.countDistinct("action").cast("double")).scalar() if n_actions is None else F.lit(float(n_actions))
    return greedy_policy(q).select(
        "state", "action", (F.col("policy") * F.lit(1.0 - eps) + F.lit(float(eps)) / count).alias("policy")
    )


def softmax_policy(table: DataFrame, value: str, group: list[str], item: str) -> DataFrame:
    over = W.partitionBy(*group)
    raised = F.exp(F.col(value) - F.max(value).over(over))
    return (
        table.select(*group, item, raised.alias("_raised"))
        .select(*group, item, (F.col("_raised") / F.sum("_raised").over(over)).alias("policy"))
    )


def cumulative(table: DataFrame, group: list[str], order: list[str], share: str) -> DataFrame:
    """Half-open interval [lo, hi) per entry; the last one is open-ended, so rounding never loses a draw."""
    over = W.partitionBy(*group).orderBy(*order)
    running = F.sum(share).over(over.rowsBetween(W.unboundedPreceding, W.currentRow))
    return (
        table.withColumn("_hi", running)
        .withColumn("lo", F.coalesce(F.lag("_hi").over(over), F.lit(0.0)))
        .withColumn("hi", F.when(F.lead(F.lit(1)).over(over).isNull(), F.lit(2.0)).otherwise(F.col("_hi")))
        .drop("_hi")
    )


def sample_action(rows: DataFrame, policy: DataFrame, draw: Column, out: str = "action", state: str = "state") -> DataFrame:
    """One action per input row by inverting the cumulative policy of its ``state`` column at ``draw``.

    A row whose state the policy lacks stays, with a null action.
    """
    intervals = cumulative(policy.filter(F.col("policy") > 0), ["state"], ["action"], "policy").select(
        F.col("state").alias("_of"), F.col("action").alias("_picked"), "lo", "hi"
    )
    intervals = settle(intervals, "choices")  # its written size decides the join, before the rows would be shuffled
    drawn = rows.withColumn("_draw", draw)
    hit = (F.col(state) == F.col("_of")) & (F.col("_draw") >= F.col("lo")) & (F.col("_draw") < F.col("hi"))
    return drawn.join(intervals, hit, "left").withColumn(out, F.col("_picked")).drop("_of", "_picked", "lo", "hi", "_draw")


def greedy_draw(table: DataFrame, value: str, group: list[str], item: str, seed: int, tie: float = TIE) -> DataFrame:
    """One maximal item per group, chosen by a draw among ties."""
    ties = table.withColumn("_top", F.max(value).over(W.partitionBy(*group))).filter(F.col(value) >= F.col("_top") - tie)
    # aggregates instead of a rank: the smallest draw wins
    return ties.groupBy(*group).agg(F.min_by(item, F.struct(uniform(seed, *group, item), F.col(item))).alias(item))


def first_best(table: DataFrame, value: str, group: list[str], item: str) -> DataFrame:
    """Lowest item among those with the maximal value, by one aggregation."""
    return table.groupBy(*group).agg(F.max_by(item, F.struct(F.col(value), -F.col(item))).alias(item))


def policy_changes(old: DataFrame, new: DataFrame, tolerance: float = TIE) -> DataFrame:
    """Rows whose probability differs between two policies."""
    renamed = old.withColumnRenamed("policy", "policy_old")
    return new.join(renamed, ["state", "action"]).filter(F.abs(F.col("policy") - F.col("policy_old")) > tolerance)


def largest_change(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """One row: the largest absolute difference between two tables."""
    renamed = old.select(*keys, F.col(value).alias("_old"))
    return new.join(renamed, keys).agg(F.max(F.abs(F.col(value) - F.col("_old"))).alias("max_delta"))
