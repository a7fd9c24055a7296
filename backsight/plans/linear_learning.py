"""Loops of batch gradient steps; weights and their change norms are the only things on the driver."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators import linear as L

HISTORY = "iteration LONG, change DOUBLE"


def weight_table(spark: SparkSession, weights: Sequence[float]) -> DataFrame:
    return spark.createDataFrame(list(enumerate(weights)), "position LONG, weight DOUBLE")


def history_table(spark: SparkSession, changes: Sequence[float]) -> DataFrame:
    return spark.createDataFrame([(i + 1, c) for i, c in enumerate(changes)], HISTORY)


def train(step: Callable[[list[float], float], list[float]], weights: list[float], rates: Sequence[float]) -> tuple[list[float], list[float]]:
    """One step per rate; returns the weights and the norm of each change."""
    changes = []
    for rate in rates:
        updated = step(weights, rate)
        changes.append(L.change_norm(weights, updated))
        weights = updated
    return weights, changes


def train_both(
    step: Callable[[list[float], list[float], float], tuple[list[float], list[float]]],
    weights: list[float],
    values: list[float],
    rates: Sequence[float],
) -> tuple[list[float], list[float], list[tuple[float, float]]]:
    """The same for an actor and a critic."""
    changes = []
    for rate in rates:
        new_weights, new_values = step(weights, values, rate)
        changes.append((L.change_norm(weights, new_weights), L.change_norm(values, new_values)))
        weights, values = new_weights, new_values
    return weights, values, changes


def linear_policy_iteration(
    evaluate: Callable[[list[float], float], list[float]], weights: list[float], eps_schedule: Sequence[float]
) -> tuple[list[float], list[float]]:
    """Evaluate once per eps, each from the weights before; returns weights and change norms."""
    changes = []
    for eps in eps_schedule:
        updated = evaluate(weights, eps)
        changes.append(L.change_norm(weights, updated))
        weights = updated
    return weights, changes


def evaluate_linear_sarsa(
    rows: DataFrame, actions: Sequence[int], gamma: float, rates: Sequence[float], trace: float = 0.0
) -> Callable[[list[float], float], list[float]]:
    """Evaluator for the policy iteration: the epsilon-greedy policy of the incoming weights stays fixed."""

    def evaluate(weights: list[float], eps: float) -> list[float]:
        fixed = list(weights)
        for rate in rates:
            weights = L.sarsa_sweep(rows, actions, weights, gamma, rate, trace, eps, fixed)
        return weights

    return evaluate
