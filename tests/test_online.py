"""Replay per segment against plain loops written from the definitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from backsight.functions.schedules import learning_rate_value
from backsight.operators import online
from backsight.sources.schemas import POLICY, TRANSITIONS
from golden import policy_rows, random_episodes, transition_rows

GAMMA, RATE, S, A = 0.9, (0.5, 5.0, 0.6), 5, 3


@pytest.fixture(scope="module")
def logs(spark):
    first = transition_rows(random_episodes(1, 14), 1)
    second = transition_rows(random_episodes(2, 4), 2, 1000)
    steps = spark.createDataFrame(first + second, TRANSITIONS).repartition(5).cache()
    return {1: first, 2: second}, steps


def plain(rows, kind, pi=None, n=1, trace=0.9, coins=None, replays=None):
    q = np.zeros((S, A))
    v = np.zeros(S)
    e = np.zeros(S)
    q2 = np.zeros((S, A))
    c = {}
    for t, row in enumerate(rows):
        _, episode, step, s, a, r, s2, done, *_ = row
        lr = learning_rate_value(t, *RATE)
        own = [x for x in rows if x[1] == episode]
        if kind == "td0":
            v[s] += lr * (r + (0 if done else GAMMA * v[s2]) - v[s])
        elif kind == "td_lambda":
            e = GAMMA * trace * (1 - lr) * e + (np.arange(S) == s)
            v += lr * (r + (0 if done else GAMMA * v[s2]) - v[s]) * e
        elif kind == "n_step_td":
            learners = range(max(0, step - n + 1), step + 1) if done else ([step - n + 1] if step + 1 >= n else [])
            for k in learners:
                target = sum(GAMMA ** (j - k) * own[j][5] for j in range(k, step + 1))
                target += 0 if done else GAMMA**n * v[s2]
                v[own[k][3]] += lr * (target - v[own[k][3]])
        elif kind == "sarsa":
            q[s, a] += lr * (r + (0 if done else GAMMA * q[s2, own[step + 1][4]]) - q[s, a])
        elif kind == "expected_sarsa":
            q[s, a] += lr * (r + (0 if done else GAMMA * pi[s2] @ q[s2]) - q[s, a])
        elif kind == "tree_backup":
            c[step] = pi[s] @ q[s] + pi[s, a] * (r - q[s, a])
            learners = range(max(0, step - n + 1), step + 1) if done else ([step - n + 1] if step + 1 >= n else [])
            for k in learners:
                target, f = own[k][5], GAMMA
                for j in range(k + 1, step + 1):
                    target += f * c[j]
                    f *= GAMMA * pi[own[j][3], own[j][4]]
                target += 0 if done else f * pi[s2] @ q[s2]
                q[own[k][3], own[k][4]] += lr * (target - q[own[k][3], own[k][4]])
        elif kind == "double_q_learning":
            mine, other = (q, q2) if coins[t] > 0.5 else (q2, q)
            mine[s, a] += lr * (r + (0 if done else GAMMA * other[s2, mine[s2].argmax()]) - mine[s, a])
        else:
            for x in [row] + ([rows[i] for i in replays[t]] if kind == "dyna_q" else []):
                best = 0 if x[7] else GAMMA * q[x[6]].max()
                q[x[3], x[4]] += lr * (x[5] + best - q[x[3], x[4]])
    if kind in ("td0", "td_lambda", "n_step_td"):
        return {(s, 0): v[s] for s in range(S)}
    table = (q + q2) / 2 if kind == "double_q_learning" else q
    return {(s, a): table[s, a] for s in range(S) for a in range(A)}


@pytest.mark.parametrize(
    "kind", ["td0", "n_step_td", "td_lambda", "sarsa", "expected_sarsa", "tree_backup", "q_learning", "double_q_learning", "dyna_q"]
)
def test_replay_equals_the_plain_loop(spark, logs, kind):
    from backsight.functions.draws import uniform

    by_segment, steps = logs
    chances = policy_rows(3)
    pi = np.zeros((S, A))
    for s, a, p in chances:
        pi[s, a] = p
    policy = spark.createDataFrame(chances, POLICY) if kind in ("expected_sarsa", "tree_backup") else None
    draws = {
        (r.segment, r.position): r
        for r in online.positioned(steps).select(
            "segment", "position", uniform(4, "segment", "position").alias("coin"),
            F.array(*[
                F.floor(uniform(4, "segment", "position", F.lit(i)) * (F.col("position") + 1)) for i in range(3)
            ]).alias("picks"),
        ).collect()
    }
    # the long segment needs several rounds, the short one ends in the first
    found = online.learn_per_segment(
        steps, kind, GAMMA, RATE, A, policy, n=3, replays=3, seed=4, rows_per_round=40 if kind in ("tree_backup", "td_lambda") else 10**6
    ).collect()
    for segment, rows in by_segment.items():
        expected = plain(
            rows, kind, pi, 3,
            coins=[draws[segment, t].coin for t in range(len(rows))],
            replays=[draws[segment, t].picks for t in range(len(rows))],
        )
        own = {(r.state, r.action): r.value for r in found if r.segment == segment}
        assert own and own == pytest.approx({k: expected[k] for k in own}, abs=1e-12)
        assert all(abs(x) < 1e-12 for k, x in expected.items() if k not in own)
