"""Batch gradients against plain numpy written from the definitions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from backsight.functions import features as X
from backsight.operators import linear as L
from backsight.plans import linear_learning as P
from backsight.sources.schemas import LINEAR_STEPS

ACTIONS, GAMMA, TRACE, LR = [0, 1, 2], 0.9, 0.6, 0.3
D = X.pair_size(2, ACTIONS)


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(1)
    episodes = [
        [(rng.normal(size=2), int(rng.integers(3)), float(rng.normal())) for _ in range(n)] for n in (1, 4, 9, 2)
    ]
    rows = [
        (e, t, x.tolist(), a, r, 0.25 if (e + t) % 2 else None) for e, steps in enumerate(episodes) for t, (x, a, r) in enumerate(steps)
    ]
    df = spark.createDataFrame(rows, LINEAR_STEPS).repartition(3).cache()
    return episodes, df, L.with_next_step(df)


def psi(x):
    b = np.concatenate([[1.0], x])
    return np.outer(b, b).ravel()


def phi(x, a):
    return np.outer(psi(x), np.concatenate([[1.0], (np.array(ACTIONS)[:-1] == a).astype(float)])).ravel()


def policy(x, theta):
    z = np.array([theta @ phi(x, a) for a in ACTIONS])
    p = np.exp(z - z.max())
    return p / p.sum()


def grad_log(x, a, theta):
    p = policy(x, theta)
    return phi(x, a) - sum(p[i] * phi(x, b) for i, b in enumerate(ACTIONS))


THETA = np.random.default_rng(2).normal(size=D) / 3
OMEGA = np.random.default_rng(3).normal(size=X.state_size(2)) / 3


def steps(episodes):
    return sum(map(len, episodes))


def test_features(data):
    episodes, df, _ = data
    rows = df.select(
        "episode", "step_count", X.state_features(F.col("features")).alias("s"),
        X.pair_features(F.col("features"), F.col("action"), ACTIONS).alias("p"),
    ).collect()
    for r in rows:
        x, a, _ = episodes[r.episode][r.step_count]
        assert r.s == pytest.approx(psi(x)) and r.p == pytest.approx(phi(x, a))


def test_scores(data):
    episodes, df, _ = data
    for r in L.score_rows(df, ACTIONS, list(THETA), 0.3).collect():
        x = episodes[r.episode][r.step_count][0]
        z = [THETA @ phi(x, a) for a in ACTIONS]
        assert r.score == pytest.approx(z[r.candidate])
        assert r.policy == pytest.approx(0.1 + (0.7 if r.candidate == int(np.argmax(z)) else 0.0))


@pytest.mark.parametrize("trace", [0.0, TRACE])
@pytest.mark.parametrize("eps", [None, 0.2])
def test_sarsa(data, trace, eps):
    episodes, _, rows = data
    fixed = THETA[::-1]
    total = np.zeros(D)
    for episode in episodes:
        z = np.zeros(D)
        for t, (x, a, r) in enumerate(episode):
            target = r
            if t + 1 < len(episode):
                x2, a2, _ = episode[t + 1]
                if eps is None:
                    target += GAMMA * THETA @ phi(x2, a2)
                else:
                    best = int(np.argmax([fixed @ phi(x2, b) for b in ACTIONS]))
                    target += GAMMA * sum((eps / 3 + (1 - eps) * (b == best)) * THETA @ phi(x2, b) for b in ACTIONS)
            z = GAMMA * trace * z + phi(x, a)
            total += (target - THETA @ phi(x, a)) * z
    expected = THETA + LR * total / steps(episodes)
    found = L.sarsa_sweep(rows, ACTIONS, list(THETA), GAMMA, LR, trace, eps, None if eps is None else list(fixed))
    assert found == pytest.approx(expected)


def correction(episode, t, x, a, clip):
    if not (episode + t) % 2:
        return 1.0
    ratio = policy(x, THETA)[a] / 0.25
    return ratio if clip is None else min(ratio, clip)


@pytest.mark.parametrize("clip", [None, 1.1])
@pytest.mark.parametrize("from_step", [False, True])
def test_reinforce(data, clip, from_step):
    episodes, df, _ = data
    total = np.zeros(D)
    for e, episode in enumerate(episodes):
        for t, (x, a, _) in enumerate(episode):
            g = sum(GAMMA ** (k - t) * s[2] for k, s in enumerate(episode) if k >= t) if from_step else sum(s[2] for s in episode)
            total += GAMMA**t * correction(e, t, x, a, clip) * g * grad_log(x, a, THETA)
    found = L.reinforce_sweep(df, ACTIONS, list(THETA), GAMMA, LR, clip, from_step)
    assert found == pytest.approx(THETA + LR * total / steps(episodes))


def test_baseline(data):
    episodes, df, _ = data
    actor, critic = np.zeros(D), np.zeros(len(OMEGA))
    for e, episode in enumerate(episodes):
        for t, (x, a, _) in enumerate(episode):
            error = sum(s[2] for s in episode) - OMEGA @ psi(x)
            critic += error * psi(x)
            actor += GAMMA**t * correction(e, t, x, a, None) * error * grad_log(x, a, THETA)
    weights, values = L.baseline_sweep(df, ACTIONS, list(THETA), list(OMEGA), GAMMA, LR)
    assert weights == pytest.approx(THETA + LR * actor / steps(episodes))
    assert values == pytest.approx(OMEGA + LR * critic / steps(episodes))


@pytest.mark.parametrize("trace", [0.0, TRACE])
def test_actor_critic(data, trace):
    episodes, _, rows = data
    actor, critic = np.zeros(D), np.zeros(len(OMEGA))
    for e, episode in enumerate(episodes):
        za, zc = np.zeros(D), np.zeros(len(OMEGA))
        for t, (x, a, r) in enumerate(episode):
            ahead = GAMMA * OMEGA @ psi(episode[t + 1][0]) if t + 1 < len(episode) else 0.0
            error = r + ahead - OMEGA @ psi(x)
            zc = GAMMA * trace * zc + psi(x)
            za = GAMMA * trace * za + grad_log(x, a, THETA)
            critic += error * zc
            actor += GAMMA**t * correction(e, t, x, a, None) * error * za
    weights, values = L.actor_critic_sweep(rows, ACTIONS, list(THETA), list(OMEGA), GAMMA, LR, trace)
    assert weights == pytest.approx(THETA + LR * actor / steps(episodes))
    assert values == pytest.approx(OMEGA + LR * critic / steps(episodes))


def test_policy_iteration_keeps_its_policy_while_evaluating(data):
    _, _, rows = data
    evaluate = P.evaluate_linear_sarsa(rows, ACTIONS, GAMMA, [LR, LR])
    weights, changes = P.linear_policy_iteration(evaluate, [0.0] * D, [0.5, 0.0])
    by_hand = [0.0] * D
    for eps in (0.5, 0.0):
        fixed = list(by_hand)
        for _ in range(2):
            by_hand = L.sarsa_sweep(rows, ACTIONS, by_hand, GAMMA, LR, 0.0, eps, fixed)
    assert weights == pytest.approx(by_hand) and len(changes) == 2 and changes[0] > 0
