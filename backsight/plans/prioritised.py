"""Prioritised sweeping over blocks of states: the block with the largest pending change is solved first.

States are dealt to blocks of about ``rows_per_block`` model rows. A queue holds, per block, a bound of how far the values of its
states may be off since it was last solved: the sum of what the changes of next states in other blocks can move them.
A round pops all blocks whose priority has the largest binary logarithm, solves each in its own task (a prioritised sweep
over its own states, the values outside held fixed), and adds the pending change to the blocks with a predecessor: an index
of (block, state, action) by next state with its share, so that only predecessors of changed states are read. The loop
ends when no priority reaches the tolerance; the values are then within tolerance / (1 - gamma) of the fixed point.

Values are a log: a round writes only the states that it changed, a reader takes a state's latest row, and every ``merge_every``
rounds the log is merged into one table. A state with more than ``rows_per_block`` rows fits in no block: it is a block of its own,
backed up by an aggregation over all tasks. ``NotSettled`` is raised after ``max_rounds``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import bellman as B
from ..storage import settle
from .loop import NotSettled

ROWS_PER_BLOCK = 200_000


def blocked(model: DataFrame, rows_per_block: int) -> DataFrame:
    """The model with ``block``, and ``hot`` for states that are too large for a task."""
    sizes = settle(model.groupBy("state").agg(F.count("*").alias("_n")), "state-sizes")
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    hot = F.col("_n") > rows_per_block
    spread = F.pmod(F.xxhash64("state"), F.lit(max(1, -(-total // rows_per_block))))
    # hot states have blocks below zero
    block = F.when(hot, -1 - F.shiftrightunsigned(F.xxhash64("state"), 1)).otherwise(spread)
    return model.join(sizes.select("state", block.alias("block"), hot.alias("hot")), "state")


def sweep(state: np.ndarray, pair: np.ndarray, following: np.ndarray, probability: np.ndarray, fixed: np.ndarray, v: np.ndarray, gamma: float, tolerance: float, most: int = 100_000) -> np.ndarray:
    """Values of a block's states. ``state[j]`` is the state of pair j, ``pair`` the pair of each outcome, ``following`` its next
    state in the block or -1; ``fixed`` is what each outcome gives without the values of the block."""
    inside = following >= 0
    own, to, weight = pair[inside], following[inside], gamma * probability[inside]
    base = np.bincount(pair, probability * fixed, len(state))
    order = np.argsort(state, kind="stable")
    starts = np.searchsorted(state[order], np.arange(len(v)))
    for _ in range(most):
        q = base + np.bincount(own, weight * v[to], len(state))
        best = np.maximum.reduceat(q[order], starts)
        change = np.abs(best - v)
        top = change.max()
        if top < tolerance:
            return best
        popped = change >= top / 2
        v = np.where(popped, best, v)
    raise NotSettled(f"a block still changes by {top:g}")


def _solve_blocks(rows: DataFrame, gamma: float, tolerance: float) -> DataFrame:
    """(state, v) of each block of ``rows`` (block, state, action, next_state, done, probability, reward, next_v)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def close() -> pa.RecordBatch:
            state, action, to, known, probability, reward, next_v = (np.concatenate(c) for c in zip(*held, strict=True))
            states, s = np.unique(state, return_inverse=True)
            _, first, pair = np.unique(np.stack((s, action)), axis=1, return_index=True, return_inverse=True)
            at = np.minimum(np.searchsorted(states, to), len(states) - 1)
            inside = known & (states[at] == to)
            v = np.zeros(len(states))
            v[at[inside]] = next_v[inside]
            fixed = reward + np.where(inside, 0.0, gamma * next_v)
            found = sweep(s[first], pair.ravel(), np.where(inside, at, -1), probability, fixed, v, gamma, tolerance)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(states), pa.array(found)], ["state", "v"])

        now = None
        for batch in batches:
            blocks = batch.column(0).to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(blocks)) + 1), len(blocks)]
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(1, 8)]
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if a == b:
                    continue
                if held and blocks[a] != now:
                    yield close()
                now = blocks[a]
                held.append([c[a:b] for c in columns])
        if held:
            yield close()

    chosen = rows.select(
        "block", "state", "action", F.coalesce("next_state", F.lit(0)).cast("long").alias("to"), (~F.col("done") & F.col("next_state").isNotNull()).alias("known"),
        F.col("probability").cast("double"), F.col("reward").cast("double"), "next_v",
    )
    return chosen.repartition("block").sortWithinPartitions("block").mapInArrow(work, "state long, v double")


class ValueLog:
    """Values as written rounds: the latest row of a state counts."""

    def __init__(self, start: DataFrame, merge_every: int):
        self.parts, self.merge_every = [settle(start.select("state", "v", F.lit(0).alias("round")), "values")], merge_every

    def latest(self) -> DataFrame:
        if len(self.parts) == 1:
            return self.parts[0].select("state", "v")
        rows = self.parts[0]
        for part in self.parts[1:]:
            rows = rows.unionByName(part)
        return rows.groupBy("state").agg(F.max_by("v", "round").alias("v"))

    def add(self, changed: DataFrame, number: int) -> None:
        self.parts.append(changed.select("state", "v", F.lit(number).alias("round")))
        if len(self.parts) > self.merge_every:
            self.parts = [settle(self.latest().withColumn("round", F.lit(number)), "values")]


def prioritised_values(
    model: DataFrame, gamma: float, tolerance: float, rows_per_block: int = ROWS_PER_BLOCK, max_rounds: int = 10_000, merge_every: int = 8
) -> tuple[DataFrame, int]:
    """(state, v) at the fixed point of the optimal backup, and the number of rounds."""
    parts = settle(blocked(model, rows_per_block), "blocked-model")
    predecessors = parts.where(~F.col("done")).join(parts.select(F.col("state").alias("next_state"), F.col("block").alias("_to")).distinct(), "next_state")
    index = settle(predecessors.where((F.col("block") != F.col("_to")) | F.col("hot")).groupBy("block", "state", "action", "next_state").agg(F.sum("probability").alias("share")), "predecessors")
    values = ValueLog(parts.select("state", F.lit(0.0).alias("v")).distinct(), merge_every)
    queue = settle(parts.select("block", "hot", F.lit(float("inf")).alias("priority")).distinct(), "queue")
    for number in range(1, max_rounds + 1):
        top = queue.agg(F.max("priority")).first()[0]
        if top is None or top < tolerance:
            return values.latest(), number - 1
        level = F.col("priority") == float("inf") if np.isinf(top) else F.col("priority") >= 2.0 ** np.floor(np.log2(top))
        popped = queue.where(level & (F.col("priority") >= tolerance))
        v = values.latest()
        rows = B.with_next_value(parts.drop("hot").join(popped.select("block", "hot"), "block"), v)
        solved = _solve_blocks(rows.where(~F.col("hot")), gamma, tolerance * 1e-2).unionByName(B.best_value(_pair_values(rows.where("hot"), gamma)))
        old = v.select("state", F.col("v").alias("_old"))
        changed = solved.join(old, "state").withColumn("change", F.abs(F.col("v") - F.col("_old"))).where("change > 0")
        changed = settle(changed.select("state", "v", "change"), "changed")
        values.add(changed, number)
        reached = index.join(changed.select(F.col("state").alias("next_state"), "change"), "next_state")
        pending = reached.groupBy("block", "state", "action").agg((F.lit(gamma) * F.sum(F.col("share") * F.col("change"))).alias("p"))
        pending = pending.groupBy("block").agg(F.max("p").alias("_more"))
        left = queue.withColumn("priority", F.when(level & (F.col("priority") >= tolerance), F.lit(0.0)).otherwise(F.col("priority")))
        queue = settle(left.join(pending, "block", "left").select("block", "hot", (F.col("priority") + F.coalesce("_more", F.lit(0.0))).alias("priority")), "queue")
    raise NotSettled(f"the queue is not empty after {max_rounds} rounds")


def _pair_values(rows: DataFrame, gamma: float) -> DataFrame:
    return rows.groupBy("state", "action").agg(F.sum(F.col("probability") * B.backed_up(gamma)).alias("q"))
