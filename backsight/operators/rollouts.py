"""Rollouts from a model table: one row per rollout, one pair of joins per step, no environment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.draws import uniform
from ..storage import settle
from .ordering import join_on
from .policies import cumulative, first_best

BUCKETS = 32  # a draw is looked up in 1/32 of a pair's outcomes
STEPS_PER_PLAN = 3


def outcome_intervals(model: DataFrame) -> DataFrame:
    """Cumulative outcomes per (state, action), listed under every draw bucket they reach into."""
    stacked = cumulative(
        model.filter(F.col("probability") > 0), ["state", "action"], ["next_state", "reward", "done"], "probability"
    )
    first = F.least(F.floor(F.col("lo") * BUCKETS), F.lit(BUCKETS - 1))
    last = F.least(F.floor(F.col("hi") * BUCKETS), F.lit(BUCKETS - 1))
    return stacked.select(
        F.col("state").alias("_s"), F.col("action").alias("_a"), "lo", "hi", F.col("next_state").alias("_next"),
        F.col("reward").alias("_reward"), F.col("done").alias("_done"), F.explode(F.sequence(first, last)).alias("_b"),
    )


def sample_outcome(rows: DataFrame, intervals: DataFrame, draw: Column, how: str = "left") -> DataFrame:
    """One outcome per row with its (state, action): adds ``_next``, ``_reward``, ``_done``; null for unknown pairs."""
    drawn = rows.withColumn("_u", draw).withColumn("_bucket", F.floor(F.col("_u") * BUCKETS))
    hit = (
        (F.col("state") == F.col("_s")) & (F.col("action") == F.col("_a")) & (F.col("_bucket") == F.col("_b"))
        & (F.col("_u") >= F.col("lo")) & (F.col("_u") < F.col("hi"))
    )
    return drawn.join(intervals, hit, how).drop("_s", "_a", "_b", "lo", "hi", "_u", "_bucket")


def _policy_intervals(policy: DataFrame) -> DataFrame:
    return cumulative(policy.filter(F.col("policy") > 0), ["state"], ["action"], "policy").select(
        F.col("state").alias("_ps"), F.col("action").alias("_pa"), "lo", "hi"
    )


def rollout_rows(starts: DataFrame, count: int) -> DataFrame:
    """``count`` rollouts of each (start, first) pair."""
    return starts.withColumn("rollout", F.explode(F.sequence(F.lit(0), F.lit(count - 1)))).select(
        "start", "first", F.col("rollout").cast("long").alias("rollout")
    )


def simulate(
    rollouts: DataFrame, model: DataFrame, policy: DataFrame, gamma: float, depth: int, seed: int, q: DataFrame | None = None
) -> DataFrame:
    """(start, first, rollout, total): discounted reward over at most ``depth`` steps, plus gamma^d * q at an open end.

    The first action is given, later ones come from the policy. A rollout ends at a terminal outcome; at a pair the
    model does not know it stops and is valued there.
    """
    key = ["start", "first", "rollout"]
    outcomes = settle(outcome_intervals(model), "outcomes")
    choices = settle(_policy_intervals(policy), "choices")
    rows = rollouts.select(
        *key, F.col("start").alias("state"), F.col("first").alias("action"), F.lit(0.0).alias("total"),
        F.lit(1.0).alias("factor"), F.lit(True).alias("open"), F.lit(True).alias("valued"),
    )
    ended = None
    for i in range(depth):
        rows = _one_step(rows, outcomes, choices, gamma, key, seed, i)
        if (i + 1) % STEPS_PER_PLAN == 0 and i + 1 < depth:
            rows = settle(rows, "rollouts")  # ended rollouts take no part in later joins
            over = rows.filter(~F.col("open"))
            ended = over if ended is None else ended.unionByName(over)
            rows = rows.filter("open")
    rows = rows if ended is None else rows.unionByName(ended)
    if q is None:
        return rows.select(*key, "total")
    leaves = q.select(F.col("state").alias("_qs"), F.col("action").alias("_qa"), "q")
    at_leaf = F.col("valued") & (F.col("state") == F.col("_qs")) & (F.col("action") == F.col("_qa"))
    return rows.join(leaves, at_leaf, "left").select(
        *key, (F.col("total") + F.when(F.col("valued"), F.col("factor") * F.coalesce("q", F.lit(0.0))).otherwise(0.0)).alias("total")
    )


def _one_step(rows, outcomes, choices, gamma, key, seed, i):
    known = outcomes.withColumn("_found", F.lit(True))
    moved = sample_outcome(
        rows, known, F.when(F.col("open"), uniform(seed, F.lit("outcome"), *key, F.lit(i)))
    )
    went = F.col("open") & F.col("_found").isNotNull()
    goes_on = went & ~F.col("_done")
    moved = (
        moved.withColumn("total", F.col("total") + F.when(went, F.col("factor") * F.col("_reward")).otherwise(0.0))
        .withColumn("valued", F.when(went, ~F.col("_done")).otherwise(F.col("valued")))
        .withColumn("state", F.when(goes_on, F.col("_next")).otherwise(F.col("state")))
        .withColumn("factor", F.when(goes_on, F.col("factor") * gamma).otherwise(F.col("factor")))
        .withColumn("open", goes_on)
        .withColumn("_v", F.when(goes_on, uniform(seed, F.lit("action"), *key, F.lit(i))))
        .drop("_next", "_reward", "_done", "_found")
    )
    hit = (F.col("state") == F.col("_ps")) & (F.col("_v") >= F.col("lo")) & (F.col("_v") < F.col("hi"))
    return (
        moved.join(choices, hit, "left")
        .withColumn("action", F.coalesce("_pa", "action"))
        .drop("_ps", "_pa", "lo", "hi", "_v")
    )


def best_by_rollout(
    starts: DataFrame, model: DataFrame, policy: DataFrame, gamma: float, depth: int, count: int, seed: int, q: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Mean simulated return per (start, first action), and the best action per start."""
    totals = simulate(rollout_rows(starts, count), model, policy, gamma, depth, seed, q)
    means = totals.groupBy("start", "first").agg(F.avg("total").alias("value"))
    return means, first_best(means, "value", ["start"], "first")


def score_policy(starts: DataFrame, model: DataFrame, policy: DataFrame, depth: int, count: int, seed: int) -> DataFrame:
    """Undiscounted reward of whole rollouts under the policy: mean and spread per start state.

    A start state that the policy lacks has no rollouts: 0 of them, mean and spread null.
    """
    rows = rollout_rows(starts.select(F.col("state").alias("start"), F.lit(-1).cast("long").alias("first")), count)
    choices = settle(_policy_intervals(policy), "choices")
    opening = rows.withColumn("_v", uniform(seed, F.lit("opening"), "start", "rollout"))
    hit = (F.col("start") == F.col("_ps")) & (F.col("_v") >= F.col("lo")) & (F.col("_v") < F.col("hi"))
    rows = opening.join(choices, hit).select("start", F.col("_pa").alias("first"), "rollout")
    totals = simulate(rows, model, policy, 1.0, depth, seed)
    scores = totals.groupBy("start").agg(
        F.avg("total").alias("mean_reward"), F.stddev("total").alias("spread"), F.count("*").alias("rollouts")
    )
    every = starts.select(F.col("state").alias("start")).distinct()
    found = join_on(every, scores, ["start"], "left")
    return found.select("start", "mean_reward", "spread", F.coalesce("rollouts", F.lit(0).cast("long")).alias("rollouts"))


# --- tree search ------------------------------------------------------------------------------------------------

def search_choice(table: DataFrame, c: float) -> DataFrame:
    """Per state: the action with the best q + c * sqrt(ln(visits + 1) / (n + 1)), and the largest q."""
    visits = F.sum("n").over(W.partitionBy("state"))  # a state's few actions
    scored = table.withColumn("_score", F.col("q") + c * F.sqrt(F.log(visits + 1.0) / (F.col("n") + 1.0)))
    return scored.groupBy(F.col("state").alias("_cs")).agg(
        F.max_by("action", F.struct(F.col("_score"), -F.col("action"))).alias("_ca"), F.max("q").alias("_best")
    )


def search_round(
    table: DataFrame, outcomes: DataFrame, roots: DataFrame, gamma: float, count: int, depth: int, lr: float, c: float, seed: int
) -> DataFrame:
    """``count`` rollouts from every root with this round's choices, then one update of (state, action, q, n).

    The m targets a pair receives in a round enter as m steps of rate lr towards their mean.
    """
    choices = settle(search_choice(table, c), "choices")
    key = ["root", "rollout"]
    rows = roots.select(F.col("state").alias("root"), F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("rollout"))
    rows = rows.withColumn("state", F.col("root")).withColumn("open", F.lit(True)).withColumn(
        "trail", F.array().cast("array<struct<state:bigint,action:bigint,reward:double>>")
    )
    for i in range(depth):
        rows = rows.join(choices, (F.col("state") == F.col("_cs")) & F.col("open"), "left").withColumnRenamed("_ca", "action")
        rows = sample_outcome(rows, outcomes, F.when(F.col("open"), uniform(seed, *key, F.lit(i))))
        went = F.col("_reward").isNotNull()
        rows = rows.withColumn(
            "trail", F.when(went, F.array_append("trail", F.struct("state", "action", F.col("_reward").alias("reward")))).otherwise(F.col("trail"))
        ).withColumn("open", went & ~F.col("_done"))
        rows = rows.withColumn("state", F.when(F.col("open"), F.col("_next")).when(went, F.lit(None)).otherwise(F.col("state")))
        rows = rows.drop("_cs", "action", "_best", "_next", "_reward", "_done")
        if (i + 1) % STEPS_PER_PLAN == 0 and i + 1 < depth:
            rows = settle(rows, "rollouts")
    leaves = rows.join(choices, (F.col("state") == F.col("_cs")) & F.col("open"), "left").select(
        "trail", F.coalesce("_best", F.lit(0.0)).alias("_leaf")
    )
    # from the back: target = reward + gamma * target of the step after
    targets = leaves.select(F.posexplode("trail").alias("_i", "_step"), "trail", "_leaf").select(
        "_step.state",
        "_step.action",
        F.aggregate(
            F.reverse(F.slice("trail", F.col("_i") + 1, F.size("trail"))),
            F.col("_leaf"),
            lambda after, step: step["reward"] + F.lit(gamma) * after,
        ).alias("target"),
    )
    seen = targets.groupBy("state", "action").agg(F.avg("target").alias("_target"), F.count("*").alias("_m"))
    share = 1 - F.pow(F.lit(1.0 - lr), F.col("_m").cast("double"))
    return table.join(seen, ["state", "action"], "left").select(
        "state", "action",
        F.coalesce(F.col("q") + share * (F.col("_target") - F.col("q")), F.col("q")).alias("q"),
        (F.col("n") + F.coalesce("_m", F.lit(0))).alias("n"),
    )


def tree_search(
    model: DataFrame, q: DataFrame, roots: DataFrame, gamma: float, rounds: int, count: int, depth: int, lr: float,
    seed: int, c: float | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Search from all roots at once; returns (state, action, q, n) and the best action per root.

    ``c`` defaults to the largest starting q.
    """
    outcomes = settle(outcome_intervals(model), "outcomes")
    table = settle(q.select("state", "action", "q", F.lit(0).cast("long").alias("n")), "search")
    c = c if c is not None else float(table.agg(F.max("q")).first()[0] or 0.0)
    for i in range(rounds):
        table = settle(search_round(table, outcomes, roots, gamma, count, depth, lr, c, seed + i), "search")
    best = first_best(table, "q", ["state"], "action").join(roots.select("state"), "state", "left_semi")
    return table, best
