"""Bandit rules replayed on logged pulls, all contexts of a task at once.

Replay evaluation goes through the log in order; a pull counts only if the rule, given what it has learned so far in
that context, draws the logged arm (Li, Chu, Langford, Wang 2011). A rule is a row of numbers, and what it has learned is
one row of numbers per context: estimates (or preferences) and counts per arm. Pulls are dealt by context and sorted by
their number, so the k-th pulls of all contexts of a task are chosen and learned as one batch of matrix operations. No
context's pulls are ever held together: a task streams them and keeps one row of state per context.

Cases: contexts are compared as they are, null included; an arm outside 0..n_arms-1 or a null reward raises an error.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import uniform
from .bandits import OPTIMISTIC_START
from .policies import TIE

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Rule:
    """``eps`` of the choices are uniform; ``bonus`` rewards rare arms; ``softmax`` makes the estimates preferences."""

    rate: float = 0.01
    start: float = 0.0
    eps: float = 0.0
    bonus: float | None = None
    softmax: bool = False
    mean_baseline: bool = False


#: Step 0.01, eps 0.01, bonus 100.
RULES = {
    "greedy": Rule(),
    "optimistic": Rule(start=OPTIMISTIC_START),
    "eps_greedy": Rule(eps=0.01),
    "ucb": Rule(bonus=100.0),
    "gradient": Rule(softmax=True),
}


def chances(rule: Rule, estimates: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The probability of each arm in each row."""
    if rule.softmax:
        raised = np.exp(estimates - estimates.max(axis=1, keepdims=True))
        return raised / raised.sum(axis=1, keepdims=True)
    scores = estimates
    if rule.bonus is not None:
        with np.errstate(divide="ignore", invalid="ignore"):
            rare = rule.bonus * np.sqrt(np.log(counts.sum(axis=1, keepdims=True)) / counts)
        # The first arm that was never pulled comes before all scores.
        untried = (counts == 0) & (np.cumsum(counts == 0, axis=1) == 1)
        scores = np.where((counts == 0).any(axis=1, keepdims=True), untried.astype(float), estimates + rare)
    best = scores >= scores.max(axis=1, keepdims=True) - TIE
    return (1 - rule.eps) * best / best.sum(axis=1, keepdims=True) + rule.eps / estimates.shape[1]


class _Learned:
    """One row of state per context; contexts get rows as they appear."""

    def __init__(self, rule: Rule, n_arms: int):
        self.rule, self.n_arms, self.rows = rule, n_arms, {}
        self.estimates, self.counts, self.base = np.full((0, n_arms), rule.start), np.zeros((0, n_arms)), np.zeros((0, 2))

    def rows_of(self, contexts: list) -> np.ndarray:
        found = np.array([self.rows.setdefault(c, len(self.rows)) for c in contexts], np.int64)
        if (missing := len(self.rows) - len(self.estimates)) > 0:
            room = max(missing, len(self.estimates))
            self.estimates = np.vstack([self.estimates, np.full((room, self.n_arms), self.rule.start)])
            self.counts = np.vstack([self.counts, np.zeros((room, self.n_arms))])
            self.base = np.vstack([self.base, np.zeros((room, 2))])
        return found

    def choose(self, rows: np.ndarray, draws: np.ndarray) -> np.ndarray:
        below = np.cumsum(chances(self.rule, self.estimates[rows], self.counts[rows]), axis=1) <= draws[:, None]
        return np.minimum(below.sum(axis=1), self.n_arms - 1)

    def learn(self, rows: np.ndarray, arms: np.ndarray, rewards: np.ndarray) -> None:
        """One pull of each row; the rows are different contexts."""
        if self.rule.softmax:
            gain = (np.arange(self.n_arms) == arms[:, None]) - chances(self.rule, self.estimates[rows], self.counts[rows])
            self.estimates[rows] += (self.rule.rate * (rewards - self.base[rows, 0]))[:, None] * gain
            if self.rule.mean_baseline:
                self.base[rows, 1] += 1
                self.base[rows, 0] += (rewards - self.base[rows, 0]) / self.base[rows, 1]
        else:
            self.estimates[rows, arms] += self.rule.rate * (rewards - self.estimates[rows, arms])
        self.counts[rows, arms] += 1


OUTPUT = "context LONG, pull_no LONG, arm LONG, reward DOUBLE, n LONG, estimate DOUBLE"


def _replay(pulls: DataFrame, n_arms: int, rule: Rule, seed: int | None) -> DataFrame:
    """The accepted pulls (all, without a seed) and, with a null pull number, the final state of every context."""
    draw = F.lit(0.0) if seed is None else uniform(seed, F.coalesce(F.col("context").cast("string"), F.lit("null")), "pull_no")
    rows = pulls.select("context", "pull_no", "arm", "reward", draw.alias("draw"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = _Learned(rule, n_arms)
        for batch in batches:
            if not len(batch):
                continue
            if batch.column(2).null_count or batch.column(3).null_count:
                raise ValueError("a pull without arm or reward")
            number, arms, rewards, draws = (batch.column(k).to_numpy() for k in range(1, 5))
            if arms.min() < 0 or arms.max() >= n_arms:
                raise ValueError(f"an arm outside 0..{n_arms - 1}")
            at = state.rows_of(batch.column(0).to_pylist())
            edges = np.flatnonzero(np.concatenate(([True], number[1:] != number[:-1], [True])))
            accepted = np.ones(len(at), bool)
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                if seed is not None:
                    accepted[a:b] = state.choose(at[a:b], draws[a:b]) == arms[a:b]
                some = a + np.flatnonzero(accepted[a:b])
                state.learn(at[some], arms[some], rewards[some])
            if seed is not None:
                kept = batch.select(["context", "pull_no", "arm", "reward"]).filter(pa.array(accepted))
                empty = [pa.nulls(len(kept), pa.int64()), pa.nulls(len(kept), pa.float64())]
                yield pa.RecordBatch.from_arrays([*kept.columns, *empty], [x.split()[0] for x in OUTPUT.split(", ")])
        size = len(state.rows)
        contexts = pa.array([c for c in state.rows for _ in range(n_arms)], pa.int64())
        columns = [contexts, pa.nulls(len(contexts), pa.int64()), pa.array(np.tile(np.arange(n_arms), size)), pa.nulls(len(contexts), pa.float64())]
        columns += [pa.array(state.counts[:size].ravel().astype(np.int64)), pa.array(state.estimates[:size].ravel())]
        yield pa.RecordBatch.from_arrays(columns, [x.split()[0] for x in OUTPUT.split(", ")])

    return rows.repartition("context").sortWithinPartitions("pull_no", "context").mapInArrow(run, OUTPUT)


def learned_preferences(pulls: DataFrame, n_arms: int, rule: Rule) -> DataFrame:
    """Final (context, arm, n, estimate) of a rule that learns from every pull in order."""
    return _replay(pulls, n_arms, rule, None).select("context", "arm", "n", "estimate")


def replay_evaluation(pulls: DataFrame, n_arms: int, rule: Rule, seed: int) -> tuple[DataFrame, DataFrame]:
    """Accepted pulls (context, pull_no, arm, reward) and final estimates (context, arm, n, estimate)."""
    rows = _replay(pulls, n_arms, rule, seed)
    accepted = rows.where(F.col("pull_no").isNotNull()).select("context", "pull_no", "arm", "reward")
    return accepted, rows.where(F.col("pull_no").isNull()).select("context", "arm", "n", "estimate")
