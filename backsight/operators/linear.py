"""Linear values and softmax policies over logged feature rows, learned by batch gradients.

Weights are a few dozen numbers. A sweep is one scan: each task turns its rows into numpy matrices batch by batch and
emits one vector of sums, and Spark adds the vectors up. Only sweeps that need an episode's total or its later errors
shuffle, and then scalars next to the raw features, never gradients. What the next step contributes is attached once,
before the sweeps.

With eligibility traces, the sum over steps of error * trace equals the sum over steps of (discounted errors from the
step on) * gradient, so the trace is one reversed running sum of a scalar.

Rows: (episode, step_count, features ARRAY<DOUBLE>, action, reward[, propensity]).
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions import features as X
from ..storage import settle
from .policies import TIE
from .scans import discounted_suffix, with_halo

cloudpickle.register_pickle_by_value(sys.modules[__name__])

KEY = ["episode"]
ROWS_AT_ONCE = 512
COLUMNS = ["episode", "step_count", "features", "action", "reward", "propensity"]


def with_next_step(rows: DataFrame) -> DataFrame:
    """Attach ``next_features`` and ``next_action`` (null at the episode's end) and write the table once."""
    haloed = with_halo(rows, "step_count", 1)
    piece = W.partitionBy(*KEY, "_piece").orderBy("step_count")
    ahead = (
        haloed.withColumn("next_features", F.lead("features").over(piece))
        .withColumn("next_action", F.lead("action").over(piece))
        .filter(~F.col("_ghost"))
        .drop("_piece", "_ghost")
    )
    return settle(ahead, "linear-steps")


# --- row operators ----------------------------------------------------------------------------------------------

def eps_greedy_array(scores: Column, eps: float, count: int) -> Column:
    best = F.array_max(scores)
    ties = F.size(F.filter(scores, lambda x: x >= best - TIE))
    return F.transform(scores, lambda x: F.lit(1.0 - eps) * (x >= best - TIE).cast("double") / ties + F.lit(eps / count))


def score_rows(rows: DataFrame, actions: Sequence[int], weights: Sequence[float], eps: float) -> DataFrame:
    """One row per step and action: its score and epsilon-greedy probability."""
    marks, w = X.action_marks(actions), np.asarray(weights, dtype=float)
    kernel = lambda batch: {"_scores": X.score_matrix(X.base_matrix(batch["features"]), w, marks)}
    scored = with_numbers(rows.select(*COLUMNS[:4]), STEP, "_scores ARRAY<DOUBLE>", kernel)
    scored = scored.withColumn("_policy", eps_greedy_array(F.col("_scores"), eps, len(actions)))
    candidates = F.array(*[F.lit(a).cast("long") for a in actions])
    each = F.arrays_zip(candidates.alias("candidate"), F.col("_scores").alias("score"), F.col("_policy").alias("policy"))
    return scored.select(*KEY, "step_count", F.inline(each).alias("candidate", "score", "policy"))


# --- sums over all rows ------------------------------------------------------------------------------------------

Batch = dict[str, np.ndarray]


def _arrays(batch: pa.RecordBatch) -> Batch:
    """Columns as numpy: vectors as matrices, numbers as arrays. Only a propensity may be null, it becomes NaN."""
    found = {}
    for name, column in zip(batch.schema.names, batch.columns):
        if pa.types.is_list(column.type) or pa.types.is_large_list(column.type):
            sizes = np.unique(column.value_lengths().to_numpy(zero_copy_only=False))
            numbers = column.flatten()
            if len(sizes) != 1 or column.null_count or numbers.null_count:
                raise ValueError(f"{name}: vectors must have one length and no nulls")
            found[name] = numbers.to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
        elif column.null_count and name != "propensity":
            raise ValueError(f"{name}: null numbers")
        else:
            found[name] = column.to_numpy(zero_copy_only=False)
    return found


def summed(rows: DataFrame, kernel: Callable[[Batch], np.ndarray]) -> tuple[np.ndarray, int]:
    """Sum of the kernel's vector over all batches, and the number of rows. One small row leaves each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = None, 0
        for batch in batches:
            if batch.num_rows:
                part = kernel(_arrays(batch))
                total, count = part if total is None else total + part, count + batch.num_rows
        if total is not None:
            yield pa.RecordBatch.from_pydict({"n": [count], "sums": [total.tolist()]})

    parts = rows.mapInArrow(run, "n LONG, sums ARRAY<DOUBLE>").select("n", F.posexplode("sums").alias("position", "part"))
    found = parts.groupBy("position").agg(F.sum("part").alias("total"), F.sum("n").alias("n")).collect()
    if not found:
        return np.zeros(0), 0
    vector = np.zeros(len(found))
    for row in found:
        vector[row["position"]] = row["total"]
    return vector, int(found[0]["n"])


def _column(values: np.ndarray) -> pa.Array:
    """Numbers as a column, a matrix as a column of vectors."""
    if values.ndim == 1:
        return pa.array(values)
    offsets = pa.array(np.arange(len(values) + 1) * values.shape[1], pa.int32())
    return pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))


def with_numbers(rows: DataFrame, keep: str, added: str, kernel: Callable[[Batch], Batch]) -> DataFrame:
    """Columns ``keep`` plus the numbers or vectors the kernel computes per row."""
    names = [part.split()[0] for part in keep.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, ROWS_AT_ONCE):
                batch = whole.slice(start, ROWS_AT_ONCE)
                extra = kernel(_arrays(batch))
                columns = [batch.column(batch.schema.get_field_index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, *map(_column, extra.values())], names=[*names, *extra])

    return rows.mapInArrow(run, f"{keep}, {added}")


def _filled(rows: DataFrame) -> DataFrame:
    """Zeros for the missing next step; ``has_next`` says which."""
    zeros = F.transform("features", lambda x: F.lit(0.0))
    return rows.withColumn("has_next", F.col("next_features").isNotNull().cast("double")).withColumn(
        "next_features", F.coalesce("next_features", zeros)
    )


STEP = "episode LONG, step_count LONG, features ARRAY<DOUBLE>, action LONG"


def _moved(weights: Sequence[float], gradient: np.ndarray, count: int, lr: float) -> list[float]:
    return [float(w + lr * g / max(count, 1)) for w, g in zip(weights, gradient if count else np.zeros(len(weights)))]


def change_norm(before: Sequence[float], after: Sequence[float]) -> float:
    return math.sqrt(sum((b - a) ** 2 for a, b in zip(before, after)))


# --- action values ----------------------------------------------------------------------------------------------

def _sarsa_error(
    actions: Sequence[int], weights: Sequence[float], gamma: float, eps: float | None, behaviour: Sequence[float] | None
) -> Callable[[Batch], np.ndarray]:
    marks = X.action_marks(actions)
    w = np.asarray(weights, dtype=float)
    fixed = w if behaviour is None else np.asarray(behaviour, dtype=float)

    def error(batch: Batch) -> np.ndarray:
        rows = np.arange(len(batch["action"]))
        own = X.score_matrix(X.base_matrix(batch["features"]), w, marks)[rows, X.action_index(batch["action"], actions)]
        base = X.base_matrix(batch["next_features"])
        ahead = X.score_matrix(base, w, marks)
        if eps is None:
            following = ahead[rows, X.action_index(batch["next_action"], actions)]
        else:
            scores = X.score_matrix(base, fixed, marks)
            best = scores >= scores.max(axis=1, keepdims=True) - TIE
            chances = (1 - eps) * best / best.sum(axis=1, keepdims=True) + eps / len(actions)
            following = (chances * ahead).sum(axis=1)
        return batch["reward"] + gamma * batch["has_next"] * following - own

    return error


def _pair_sums(actions: Sequence[int], factor: Callable[[Batch], np.ndarray]) -> Callable[[Batch], np.ndarray]:
    """Sum over rows of factor * pair features."""
    marks = X.action_marks(actions)

    def kernel(batch: Batch) -> np.ndarray:
        own = marks[X.action_index(batch["action"], actions)]
        return X.pair_sums(X.base_matrix(batch["features"]), factor(batch)[:, None] * own)

    return kernel


def sarsa_sweep(
    rows: DataFrame, actions: Sequence[int], weights: Sequence[float], gamma: float, lr: float,
    trace: float = 0.0, eps: float | None = None, behaviour: Sequence[float] | None = None,
) -> list[float]:
    """One batch step: weights + lr * mean(error * trace vector); ``trace`` = 0 is the one-step method.

    error = r + gamma * next value - value, r - value at the end. The next value is that of the logged next action, or
    with ``eps`` the expectation over the epsilon-greedy policy of the ``behaviour`` weights.
    """
    error = _sarsa_error(actions, weights, gamma, eps, behaviour)
    data = _filled(rows).select(
        *KEY, "step_count", "features", "action", "reward", "next_features", "has_next",
        F.coalesce("next_action", F.lit(actions[0])).alias("next_action"),
    )
    if trace == 0:
        gradient, count = summed(data, _pair_sums(actions, error))
    else:
        # Written once: the running sum reads its input more than once, and the kernel should run once.
        errors = settle(with_numbers(data, STEP, "error DOUBLE", lambda batch: {"error": error(batch)}), "errors")
        ahead = discounted_suffix(errors, KEY, "step_count", "error", gamma * trace, "ahead")
        gradient, count = summed(
            ahead.select("features", "action", "ahead"), _pair_sums(actions, lambda batch: batch["ahead"])
        )
    return _moved(weights, gradient, count, lr)


# --- policy gradients -------------------------------------------------------------------------------------------

def _policy(actions: Sequence[int], weights: Sequence[float], gamma: float, clip: float | None):
    """Per batch: [1, state], marks left after subtracting their expectation, and gamma^t times the correction.

    The correction is the logged action's chance over its propensity, 1 where no propensity is logged.
    """
    marks = X.action_marks(actions)
    w = np.asarray(weights, dtype=float)

    def parts(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        base = X.base_matrix(batch["features"])
        chances = X.softmax(X.score_matrix(base, w, marks))
        own = X.action_index(batch["action"], actions)
        with np.errstate(invalid="ignore"):
            ratio = chances[np.arange(len(own)), own] / batch["propensity"].astype(float)
        correction = np.where(np.isnan(ratio), 1.0, ratio if clip is None else np.minimum(ratio, clip))
        return base, marks[own] - chances @ marks, gamma ** batch["step_count"].astype(float) * correction

    return parts


def policy_gradient_rows(rows: DataFrame, actions: Sequence[int], weights: Sequence[float]) -> DataFrame:
    """Per step ``chances`` (softmax over the actions) and ``gradient`` of the log chance of the logged action."""
    marks = X.action_marks(actions)
    w = np.asarray(weights, dtype=float)

    def kernel(batch: Batch) -> Batch:
        psi = X.state_matrix(batch["features"])
        chances = X.softmax(X.score_matrix(X.base_matrix(batch["features"]), w, marks))
        residual = marks[X.action_index(batch["action"], actions)] - chances @ marks
        return {"chances": chances, "gradient": (psi[:, :, None] * residual[:, None, :]).reshape(len(psi), -1)}

    return with_numbers(rows.select(*COLUMNS[:4]), STEP, "chances ARRAY<DOUBLE>, gradient ARRAY<DOUBLE>", kernel)


def _with_totals(rows: DataFrame) -> DataFrame:
    """Attach the episode's whole reward; the totals combine map-side and join back on the episode."""
    return rows.join(rows.groupBy(*KEY).agg(F.sum("reward").alias("total")), KEY)


def reinforce_sweep(
    rows: DataFrame, actions: Sequence[int], weights: Sequence[float], gamma: float, lr: float,
    clip: float | None = None, from_step: bool = False,
) -> list[float]:
    """theta + lr * mean(gamma^t * episode return * gradient); ``from_step`` uses the return from the step on."""
    slim = rows.select(*COLUMNS)
    data = discounted_suffix(slim, KEY, "step_count", "reward", gamma, "total") if from_step else _with_totals(slim)
    parts = _policy(actions, weights, gamma, clip)

    def kernel(batch: Batch) -> np.ndarray:
        base, residual, weight = parts(batch)
        return X.pair_sums(base, (weight * batch["total"])[:, None] * residual)

    return _moved(weights, *summed(data, kernel), lr)


def _both(actor: np.ndarray, critic: np.ndarray, base: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Sums of actor factor * policy gradient, then of critic factor * state features."""
    return np.concatenate([X.pair_sums(base, actor[:, None] * residual), X.state_sums(base, critic)])


def _both_moved(weights, values, sums: np.ndarray, count: int, lr: float) -> tuple[list[float], list[float]]:
    size = len(weights)
    return _moved(weights, sums[:size], count, lr), _moved(values, sums[size:], count, lr)


def baseline_sweep(
    rows: DataFrame, actions: Sequence[int], weights: Sequence[float], values: Sequence[float], gamma: float, lr: float,
    clip: float | None = None,
) -> tuple[list[float], list[float]]:
    """REINFORCE with a linear baseline: error = episode return - value, for both weight vectors."""
    parts = _policy(actions, weights, gamma, clip)
    v = np.asarray(values, dtype=float)

    def kernel(batch: Batch) -> np.ndarray:
        base, residual, weight = parts(batch)
        error = batch["total"] - X.values(base, v)
        return _both(weight * error, error, base, residual)

    return _both_moved(weights, values, *summed(_with_totals(rows.select(*COLUMNS)), kernel), lr)


def actor_critic_sweep(
    rows: DataFrame, actions: Sequence[int], weights: Sequence[float], values: Sequence[float], gamma: float, lr: float,
    trace: float = 0.0, clip: float | None = None,
) -> tuple[list[float], list[float]]:
    """One-step errors move both weight vectors; with ``trace`` each step also learns from the errors after it."""
    parts = _policy(actions, weights, gamma, clip)
    v = np.asarray(values, dtype=float)
    data = _filled(rows).select(*COLUMNS, "next_features", "has_next")

    def error(batch: Batch, base: np.ndarray) -> np.ndarray:
        return batch["reward"] + gamma * batch["has_next"] * X.values(X.base_matrix(batch["next_features"]), v) - X.values(base, v)

    if trace == 0:

        def kernel(batch: Batch) -> np.ndarray:
            base, residual, weight = parts(batch)
            found = error(batch, base)
            return _both(weight * found, found, base, residual)

        return _both_moved(weights, values, *summed(data, kernel), lr)

    def errors(batch: Batch) -> Batch:
        base, _, weight = parts(batch)
        found = error(batch, base)
        return {"critic": found, "actor": weight * found}

    # Written once: the running sums read their input more than once, and the kernel should run once.
    numbers = settle(with_numbers(data, f"{STEP}, propensity DOUBLE", "critic DOUBLE, actor DOUBLE", errors), "errors")
    for name in ("critic", "actor"):
        numbers = discounted_suffix(numbers, KEY, "step_count", name, gamma * trace, f"{name}_ahead")

    def traced(batch: Batch) -> np.ndarray:
        base, residual, _ = parts(batch)
        return _both(batch["actor_ahead"], batch["critic_ahead"], base, residual)

    return _both_moved(weights, values, *summed(numbers, traced), lr)
