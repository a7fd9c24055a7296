"""One backup over a model table.

Every backup joins the model with the small value table and folds it by aggregation; the aggregates combine
map-side, so a state with very many outcomes stays spread over the tasks that hold its rows. The value table is a
written table, so its real size decides whether Spark broadcasts it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one_state(model: DataFrame, state: int | None) -> DataFrame:
    return model if state is None else model.filter(F.col("state") == state)


def with_next_value(model: DataFrame, v: DataFrame) -> DataFrame:
    """Attach ``next_v``: 0 after a terminal outcome or for an unknown next state."""
    following = v.select(F.col("state").alias("next_state"), F.col("v").alias("_v"))
    return (
        model.join(following, "next_state", "left")
        .withColumn("next_v", F.when(F.col("done"), F.lit(0.0)).otherwise(F.coalesce("_v", F.lit(0.0))))
        .drop("_v")
    )


def backed_up(gamma: float) -> Column:
    return F.col("reward") + F.lit(float(gamma)) * F.col("next_v")


def expected_backup(model: DataFrame, v: DataFrame, policy: DataFrame, gamma: float, state: int | None = None) -> DataFrame:
    """Value of each state under a policy after one step."""
    rows = with_next_value(one_state(model, state), v).join(policy, ["state", "action"])
    return rows.groupBy("state").agg(F.sum(F.col("policy") * F.col("probability") * backed_up(gamma)).alias("v"))


def q_from_v(model: DataFrame, v: DataFrame, gamma: float) -> DataFrame:
    return (
        with_next_value(model, v)
        .groupBy("state", "action")
        .agg(F.sum(F.col("probability") * backed_up(gamma)).alias("q"))
    )


def best_value(q: DataFrame) -> DataFrame:
    return q.groupBy("state").agg(F.max("q").alias("v"))


def optimal_backup(model: DataFrame, v: DataFrame, gamma: float, state: int | None = None) -> DataFrame:
    return best_value(q_from_v(one_state(model, state), v, gamma))


def optimal_q_backup(model: DataFrame, q: DataFrame, gamma: float) -> DataFrame:
    return q_from_v(model, best_value(q), gamma)


def merge_values(old: DataFrame, new: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``old`` with the rows of ``new`` replacing theirs."""
    fresh = new.select(*keys, F.col(value).alias("_new"))
    return old.join(fresh, keys, "left").select(*keys, F.coalesce("_new", F.col(value)).alias(value))


def linear_system(model: DataFrame, policy: DataFrame, gamma: float) -> tuple[DataFrame, DataFrame]:
    """Coefficients (state, next_state, coefficient) of I - gamma * P and the right side (state, b)."""
    rows = model.join(policy, ["state", "action"]).withColumn("_share", F.col("policy") * F.col("probability"))
    # the identity enters as one more row per state, summed in the same aggregation
    identity = rows.select("state", F.col("state").alias("next_state"), F.lit(1.0).alias("coefficient")).distinct()
    moves = (
        rows.filter(~F.col("done"))
        .groupBy("state", "next_state")
        .agg((F.lit(-float(gamma)) * F.sum("_share")).alias("coefficient"))
    )
    left = identity.unionByName(moves).groupBy("state", "next_state").agg(F.sum("coefficient").alias("coefficient"))
    right = rows.groupBy("state").agg(F.sum(F.col("_share") * F.col("reward")).alias("b"))
    return left, right


def jacobi_step(off_diagonal: DataFrame, diagonal: DataFrame, v: DataFrame) -> DataFrame:
    """v_i = (b_i - sum over j != i of A_ij v_j) / A_ii."""
    other = v.select(F.col("state").alias("next_state"), "v")
    folded = off_diagonal.join(other, "next_state").groupBy("state").agg(F.sum(F.col("coefficient") * F.col("v")).alias("_rest"))
    return diagonal.join(folded, "state", "left").select(
        "state", ((F.col("b") - F.coalesce("_rest", F.lit(0.0))) / F.col("a_ii")).alias("v")
    )
