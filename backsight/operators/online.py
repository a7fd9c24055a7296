"""Online learners replayed step by step on each segment's own log.

Batch sweeps are a different estimator than learning one step at a time. Here every segment (a user, a cohort, a policy
version) learns its own table from its steps in order, each update reading the writes before it. What a learner needs
from elsewhere (the next action, replayed experience) is attached to its step by joins and windows beforehand, so a
learner keeps only its table and a few recent steps.
"""

from __future__ import annotations

import sys
from collections import deque

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.draws import uniform
from ..functions.schedules import learning_rate_value
from .backups import with_next_action
from .ordering import ROWS_PER_CHUNK, numbered
from .replay import ROWS_PER_ROUND, replay

cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(sys.modules[learning_rate_value.__module__])

OUTPUT = "state LONG, action LONG, value DOUBLE"


class _Learner:
    """Shared loop: feeds (lr, row) to ``step`` and reports the table."""

    def __init__(self, gamma: float, rate: tuple[float, float, float], actions: int):
        self.gamma, self.rate, self.actions = gamma, rate, actions
        self.table: dict[int, np.ndarray] = {}
        self.memory: dict = {}

    def saved(self) -> dict:
        return {"table": dict(self.table), "memory": self.memory}

    def restore(self, values: dict) -> None:
        self.table, self.memory = values["table"], values["memory"]

    def values(self, state: int) -> np.ndarray:
        return self.table.setdefault(state, np.zeros(self.actions))

    def feed(self, frame: pd.DataFrame) -> None:
        for row in frame.itertuples(index=False):
            self.step(learning_rate_value(row.position, *self.rate), row)

    def move(self, lr: float, state: int, action: int, target: float) -> None:
        row = self.values(state)
        row[action] += lr * (target - row[action])

    def result(self) -> pd.DataFrame:
        rows = [(s, a, float(x)) for s, row in sorted(self.table.items()) for a, x in enumerate(row)]
        return pd.DataFrame(rows, columns=["state", "action", "value"])


class _Td0(_Learner):
    def step(self, lr, row):
        ahead = 0.0 if row.done else self.values(int(row.next_state))[0]
        self.move(lr, row.state, 0, row.reward + self.gamma * ahead)


class _NStepTd(_Learner):
    """A step learns once n rewards are known, or at the episode's end from those that came."""

    def __init__(self, gamma, rate, actions, n):
        super().__init__(gamma, rate, actions)
        self.n = n

    def step(self, lr, row):
        waiting = self.memory.setdefault("waiting", deque())
        waiting.append((row.state, row.reward))
        if row.done:
            while waiting:
                self._learn(lr, waiting, 0.0)
        elif len(waiting) == self.n:
            self._learn(lr, waiting, self.gamma**self.n * self.values(int(row.next_state))[0])

    def _learn(self, lr, waiting, ahead):
        partial = sum(self.gamma**k * reward for k, (_, reward) in enumerate(waiting))
        self.move(lr, waiting.popleft()[0], 0, partial + ahead)


class _TdLambda(_Learner):
    """Decaying traces; Dutch traces also fade by (1 - lr). Traces cross episode borders unless ``per_episode``."""

    def __init__(self, gamma, rate, actions, trace, dutch, per_episode):
        super().__init__(gamma, rate, actions)
        self.trace, self.dutch, self.per_episode = trace, dutch, per_episode

    def step(self, lr, row):
        traces = self.memory.setdefault("traces", {})
        fade = self.gamma * self.trace * ((1 - lr) if self.dutch else 1.0)
        for state in traces:
            traces[state] *= fade
        traces[row.state] = traces.get(row.state, 0.0) + 1.0
        ahead = 0.0 if row.done else self.values(int(row.next_state))[0]
        error = row.reward + self.gamma * ahead - self.values(row.state)[0]
        for state, weight in traces.items():
            self.values(state)[0] += lr * error * weight
        if row.done and self.per_episode:
            traces.clear()


class _Sarsa(_Learner):
    def step(self, lr, row):
        ahead = 0.0 if row.done else self.values(int(row.next_state))[int(row.next_action)]
        self.move(lr, row.state, row.action, row.reward + self.gamma * ahead)


class _ExpectedSarsa(_Learner):
    """The policy's probabilities at the step's two states come with the step."""

    def expectation(self, state: int, chances: np.ndarray) -> float:
        return float(chances @ self.values(state))

    def step(self, lr, row):
        ahead = 0.0 if row.done else self.expectation(int(row.next_state), row.next_chances)
        self.move(lr, row.state, row.action, row.reward + self.gamma * ahead)


class _TreeBackup(_ExpectedSarsa):
    """A later step's contribution is fixed when the step is seen; it is weighed when an earlier step learns."""

    def __init__(self, gamma, rate, actions, n):
        super().__init__(gamma, rate, actions)
        self.n = n

    def step(self, lr, row):
        waiting = self.memory.setdefault("waiting", deque())
        chance = float(row.chances[row.action])
        swapped = self.expectation(row.state, row.chances) + chance * (row.reward - self.values(row.state)[row.action])
        waiting.append((row.state, row.action, row.reward, chance, swapped))
        if row.done:
            while waiting:
                self._learn(lr, waiting, None)
        elif len(waiting) == self.n:
            self._learn(lr, waiting, row)

    def _learn(self, lr, waiting, leaf):
        state, action, reward, _, _ = waiting.popleft()
        later = np.array([step[3:] for step in waiting]).reshape(-1, 2)
        # How much each later step counts, and after them the leaf: products of the chances on the way, discounted.
        reach = self.gamma * np.cumprod(np.concatenate(([1.0], self.gamma * later[:, 0])))
        target = reward + float(reach[:-1] @ later[:, 1])
        if leaf is not None:
            target += reach[-1] * self.expectation(int(leaf.next_state), leaf.next_chances)
        self.move(lr, state, action, target)


class _QLearning(_Learner):
    def target(self, reward, next_state, done) -> float:
        return reward if done else reward + self.gamma * self.values(int(next_state)).max()

    def step(self, lr, row):
        self.move(lr, row.state, row.action, self.target(row.reward, row.next_state, row.done))


class _DynaQ(_QLearning):
    """After each real step, the replayed ones attached to it."""

    def step(self, lr, row):
        super().step(lr, row)
        for past in row.replays:
            self.move(lr, past["state"], past["action"], self.target(past["reward"], past["next_state"], past["done"]))


class _DoubleQ(_Learner):
    """Columns 0..n-1 of a row are the first table, n..2n-1 the second; the step's coin picks the one that learns."""

    def values(self, state):
        return self.table.setdefault(state, np.zeros(2 * self.actions))

    def step(self, lr, row):
        own = 0 if row.coin > 0.5 else self.actions
        ahead = 0.0
        if not row.done:
            following = self.values(int(row.next_state))
            best = int(following[own : own + self.actions].argmax())
            ahead = following[self.actions - own + best]
        self.move(lr, row.state, own + row.action, row.reward + self.gamma * ahead)

    def result(self):
        n = self.actions
        rows = [(s, a, float(x[a] + x[n + a]) / 2) for s, x in sorted(self.table.items()) for a in range(n)]
        return pd.DataFrame(rows, columns=["state", "action", "value"])


def positioned(steps: DataFrame, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Dense ``position`` from 0 in each segment."""
    rows = numbered(steps, ["segment"], ["ts", "event_id"], "position", rows_per_chunk)
    return rows.withColumn("position", F.col("position") - 1)


def with_replays(steps: DataFrame, count: int, seed: int) -> DataFrame:
    """Attach to each step ``count`` steps of its segment drawn uniformly from those up to it, by an equi-join."""
    draws = steps.select("segment", "position", F.explode(F.sequence(F.lit(0), F.lit(count - 1))).alias("draw")).withColumn(
        "pick", F.floor(uniform(seed, "segment", "position", "draw") * (F.col("position") + 1)).cast("long")
    )
    past = steps.select(
        "segment", F.col("position").alias("pick"), F.struct("state", "action", "reward", "next_state", "done").alias("past")
    )
    replays = (
        draws.join(past, ["segment", "pick"])
        .groupBy("segment", "position")
        .agg(F.transform(F.array_sort(F.collect_list(F.struct("draw", "past"))), lambda x: x["past"]).alias("replays"))
    )
    return steps.join(replays, ["segment", "position"])


def with_chances(steps: DataFrame, policy: DataFrame, actions: int) -> DataFrame:
    """Attach the policy's probabilities at ``state`` and ``next_state`` as arrays by action number."""
    listed = policy.groupBy("state").agg(F.map_from_entries(F.collect_list(F.struct("action", "policy"))).alias("_map"))
    rows = listed.select(
        "state",
        F.array(*[F.coalesce(F.try_element_at("_map", F.lit(a).cast("long")), F.lit(0.0)) for a in range(actions)]).alias("chances"),
    )
    after = rows.select(F.col("state").alias("next_state"), F.col("chances").alias("next_chances"))
    none = F.array(*[F.lit(0.0)] * actions)  # a state that the policy lacks: no action has a chance
    return steps.join(rows, "state", "left").join(after, "next_state", "left").withColumns(
        {"chances": F.coalesce("chances", none), "next_chances": F.coalesce("next_chances", none)}
    )


def learn_per_segment(
    steps: DataFrame,
    algorithm: str,
    gamma: float,
    rate: tuple[float, float, float],
    actions: int,
    policy: DataFrame | None = None,
    n: int = 1,
    trace: float = 0.9,
    dutch: bool = True,
    per_episode: bool = False,
    replays: int = 10,
    seed: int = 0,
    rows_per_round: int = ROWS_PER_ROUND,
) -> DataFrame:
    """(segment, state, action, value) learned by one of: td0, n_step_td, td_lambda, sarsa, expected_sarsa, tree_backup,
    q_learning, double_q_learning, dyna_q. ``rate`` = (base, period, power) over the segment's step number. Evaluations
    of states report action 0."""
    columns = ["segment", "position", "state", "action", "reward", "next_state", "done"]
    rows = positioned(with_next_action(steps) if algorithm == "sarsa" else steps)
    rows = rows.select(*columns, *(["next_action"] if algorithm == "sarsa" else []))
    if policy is not None:
        rows = with_chances(rows, policy, actions)
    if algorithm == "double_q_learning":
        rows = rows.withColumn("coin", uniform(seed, "segment", "position"))
    if algorithm == "dyna_q":
        rows = with_replays(rows, replays, seed)
    makers = {
        "td0": lambda: _Td0(gamma, rate, 1),
        "n_step_td": lambda: _NStepTd(gamma, rate, 1, n),
        "td_lambda": lambda: _TdLambda(gamma, rate, 1, trace, dutch, per_episode),
        "sarsa": lambda: _Sarsa(gamma, rate, actions),
        "expected_sarsa": lambda: _ExpectedSarsa(gamma, rate, actions),
        "tree_backup": lambda: _TreeBackup(gamma, rate, actions, n),
        "q_learning": lambda: _QLearning(gamma, rate, actions),
        "double_q_learning": lambda: _DoubleQ(gamma, rate, actions),
        "dyna_q": lambda: _DynaQ(gamma, rate, actions),
    }
    return replay(rows, "segment", "position", makers[algorithm], OUTPUT, rows_per_round)
