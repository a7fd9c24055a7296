"""Driver loops over small tables: each round is a Spark job, only scalars come back.

The table that moves (v or q) is small beside the model it is joined with. Its own rows are counted once: if they fit,
the table is broadcast and the model is not shuffled; beyond that the same joins run as shuffle joins. A loop that does
not settle within its rounds raises ``NotSettled``.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.schemas import HISTORY
from ..storage import settle

BROADCAST_BYTES = 64 * 2**20
BYTES_PER_ROW = 48

BROADCAST, SHUFFLE = "broadcast", "shuffle"


class NotSettled(RuntimeError):
    """The rounds allowed were not enough."""


def placement_of(table_rows: int) -> str:
    return BROADCAST if table_rows * BYTES_PER_ROW <= BROADCAST_BYTES else SHUFFLE


def placed(table: DataFrame, placement: str) -> DataFrame:
    """A table whose rows were counted: broadcast or shuffled."""
    return F.broadcast(table) if placement == BROADCAST else table


def checked(written: DataFrame) -> DataFrame:
    """A written table, marked for broadcast if its own rows allow it."""
    return placed(written, placement_of(written.count()))


def kept(model: DataFrame, keys: list[str]) -> tuple[DataFrame, str]:
    """Write the model once (lineage), keep it in memory or on disk for the rounds, and say how rounds should run.

    The moving table has one row for each value of ``keys`` in the model; these are counted.
    """
    written = settle(model, "model")
    placement = placement_of(written.select(*keys).distinct().count())
    return written.persist(StorageLevel.MEMORY_AND_DISK), placement


def repeat(
    table: DataFrame, step: Callable[[DataFrame], DataFrame], rounds: int, placement: str, every: int = 4
) -> DataFrame:
    """A fixed number of rounds; the table is written every few rounds so that plans stay short."""
    for i in range(1, rounds + 1):
        table = step(placed(table, placement))
        if i % every == 0 and i < rounds:
            table = settle(table, "round")
    return table


def until_stable(
    table: DataFrame,
    step: Callable[[DataFrame], DataFrame],
    keys: list[str],
    value: str,
    tolerance: float,
    placement: str,
    max_rounds: int = 1_000,
    every: int = 4,
    extrapolate: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """Repeat until one plain round changes no value by ``tolerance`` or more.

    A job runs ``every`` rounds and writes all their tables side by side, one row per key. The check reads them back as
    a handful of sums. The next job starts from the combination of these rounds with the smallest expected change
    (reduced-rank extrapolation), which saves most rounds; after two starts that turned out worse the loop goes on without.
    Returns the table and the checks as (iteration, max_delta); raises ``NotSettled`` after ``max_rounds``.
    """
    spark = table.sparkSession
    history: list[tuple[int, float]] = []
    start = settle(table.select(*keys, value), "round")
    done, failures = 0, 0
    while True:
        rounds = min(every, max_rounds - done)
        chain = [start]
        for _ in range(rounds):
            chain.append(step(placed(chain[-1], placement)))
        wide = placed(chain[0], placement).select(*keys, F.col(value).alias("x0"))
        for i, later in enumerate(chain[1:], start=1):
            wide = wide.join(placed(later, placement).select(*keys, F.col(value).alias(f"x{i}")), keys)
        wide = settle(wide, "round")
        done += rounds
        moves = [F.col(f"x{i + 1}") - F.col(f"x{i}") for i in range(rounds)]
        products = [F.sum(moves[i] * moves[j]).alias(f"g{i}_{j}") for i in range(rounds) for j in range(i + 1)]
        sums = wide.agg(F.max(F.abs(moves[-1])).alias("delta"), *products).first()
        history.append((done, float(sums["delta"] or 0.0)))
        last = wide.select(*keys, F.col(f"x{rounds}").alias(value))
        if history[-1][1] < tolerance:
            return last, spark.createDataFrame(history, HISTORY)
        if done >= max_rounds:
            raise NotSettled(f"{done} rounds, the last change is {history[-1][1]:g}")
        if len(history) > 1 and history[-1][1] > history[-2][1]:
            failures += 1
        start = last
        if extrapolate and failures < 2 and rounds > 1:
            weights = _combination([[sums[f"g{max(i, j)}_{min(i, j)}"] for j in range(rounds)] for i in range(rounds)])
            mixed = sum((F.lit(w) * F.col(f"x{i + 1}") for i, w in enumerate(weights)), F.lit(0.0))
            start = wide.select(*keys, mixed.alias(value))


def _combination(gram: list[list[float]]) -> list[float]:
    """Weights summing to one that make the combined change smallest."""
    g = np.array(gram, dtype=float)
    g += np.eye(len(g)) * 1e-12 * max(np.trace(g), 1e-300)
    solved = np.linalg.lstsq(g, np.ones(len(g)), rcond=None)[0]
    total = solved.sum()
    if not np.isfinite(total) or abs(total) < 1e-300:
        return [0.0] * (len(g) - 1) + [1.0]
    return [float(w) for w in solved / total]
