import pytest
from pyspark.sql import functions as F

from backsight.functions.schedules import learning_rate_value
from backsight.operators import models as M
from backsight.operators import returns as R
from backsight.sources.schemas import POLICY
from golden import as_dict, policy_rows, random_episodes, transitions

GAMMA, RATE = 0.95, (0.1, 10.0, 0.51)


def loop(episodes, targets_of, states, rate=RATE):
    """The plain sequence of blends."""
    v = dict.fromkeys(states, 0.0)
    for number, episode in enumerate(episodes):
        lr = learning_rate_value(number, *rate)
        for state, target in targets_of(episode).items():
            v[state] = (1 - lr) * v[state] + lr * target
    return v


def returns(episode, gamma=GAMMA):
    out, after = [], 0.0
    for _, _, reward in reversed(episode):
        after = reward + gamma * after
        out.append(after)
    return out[::-1]


def mean_targets(episode):
    found = {}
    for (state, _, _), value in zip(episode, returns(episode)):
        found.setdefault(state, []).append(value)
    return {s: sum(x) / len(x) for s, x in found.items()}


def weighted_targets(pi, b):
    def targets(episode):
        kept = [(i, step) for i, step in enumerate(episode) if (step[0], step[1]) in pi]
        found, ratio, value, last = {}, 1.0, 0.0, None
        for i, (state, action, reward) in reversed(kept):
            ratio *= pi[state, action] / b[state, action]
            value = reward + (value * GAMMA ** (last - i) if last is not None else 0.0)
            last = i
            found.setdefault(state, []).append((ratio, value))
        return {
            s: (sum(w * g for w, g in x) / sum(w for w, _ in x) if sum(w for w, _ in x) else 0.0) for s, x in found.items()
        }

    return targets


def test_return_chain(spark):
    steps = transitions(spark, [[(0, 0, 0), (1, 0, 0), (2, 0, 1)]])
    found = R.discounted_returns(steps, GAMMA).orderBy("step_count").collect()
    assert [r.remaining_return for r in found] == pytest.approx([0.9025, 0.95, 1.0])


def test_monte_carlo_equals_the_loop(spark):
    episodes = random_episodes(1, 40) + [[(9, 0, 1.0)]]
    steps = transitions(spark, episodes)
    states = M.state_space(steps).union(spark.createDataFrame([(77,)], "state LONG"))
    found = as_dict(R.monte_carlo_evaluation(steps, M.init_v(states), GAMMA, *RATE), "state")
    assert found == pytest.approx({**loop(episodes, mean_targets, [0, 1, 2, 3, 4, 9]), 77: 0.0})


def test_full_step_size_keeps_only_the_last_episode(spark):
    episodes = random_episodes(2, 8)
    steps = transitions(spark, episodes)
    found = as_dict(R.monte_carlo_evaluation(steps, M.init_v(M.state_space(steps)), GAMMA, 1.0, 1e9, 0.5), "state")
    assert found == pytest.approx(loop(episodes, mean_targets, found, (1.0, 1e9, 0.5)))


def test_off_policy_equals_the_loop(spark):
    episodes = random_episodes(3, 30)
    steps = transitions(spark, episodes)
    rows, behaviour = policy_rows(4), policy_rows(5)
    target = spark.createDataFrame([r for r in rows if r[:2] != (2, 1)], POLICY)  # one action is not listed
    b = spark.createDataFrame(behaviour, POLICY)
    found = as_dict(R.off_policy_monte_carlo_evaluation(steps, M.init_v(M.state_space(steps)), target, b, GAMMA, *RATE), "state")
    pi = {r[:2]: r[2] for r in rows if r[:2] != (2, 1)}
    assert found == pytest.approx(loop(episodes, weighted_targets(pi, {r[:2]: r[2] for r in behaviour}), found))
    small = R.weighted_visit_targets(R.weighted_returns(steps, target, b, GAMMA, span=2))
    large = R.weighted_visit_targets(R.weighted_returns(steps, target, b, GAMMA))
    key = ("segment", "episode", "state")
    assert as_dict(small, *key) == pytest.approx(as_dict(large, *key))


def test_same_policies_mean_no_correction(spark):
    steps = transitions(spark, random_episodes(6, 20))
    policy = spark.createDataFrame(policy_rows(1), POLICY)
    v0 = M.init_v(M.state_space(steps))
    on = as_dict(R.monte_carlo_evaluation(steps, v0, GAMMA, *RATE), "state")
    off = as_dict(R.off_policy_monte_carlo_evaluation(steps, v0, policy, policy, GAMMA, *RATE), "state")
    assert off == pytest.approx(on)


def test_zero_weights(spark):
    steps = transitions(spark, [[(0, 0, 5.0)]])
    target = spark.createDataFrame([(0, 0, 0.0), (0, 1, 1.0)], POLICY)
    b = spark.createDataFrame([(0, 0, 0.5), (0, 1, 0.5)], POLICY)
    assert R.weighted_visit_targets(R.weighted_returns(steps, target, b, GAMMA)).first().target == 0.0


def test_two_state_batch(spark):
    """A0 B0 once, B1 six times, B0 once: Monte Carlo says v(A) = 0, batch TD says 3/4."""
    from backsight.plans import learning

    episodes = [[(0, 0, 0), (1, 0, 0)]] + [[(1, 0, 1)]] * 6 + [[(1, 0, 0)]]
    steps = transitions(spark, episodes)
    means = as_dict(R.discounted_returns(steps, 1.0).groupBy("state").agg(F.avg("remaining_return")), "state")
    assert means == pytest.approx({0: 0.0, 1: 0.75})
    v = learning.td0(steps, M.init_v(M.state_space(steps)), 1.0, [1.0] * 3)
    assert as_dict(v, "state") == pytest.approx({0: 0.75, 1: 0.75})


def test_segments_are_their_own_sequences(spark):
    episodes = random_episodes(8, 12)
    one = transitions(spark, episodes, 1)
    both = one.unionByName(transitions(spark, random_episodes(9, 5), 2))
    found = R.monte_carlo_evaluation(both, M.init_v(M.state_space(both)), GAMMA, *RATE, by_segment=True)
    first = as_dict(found.filter("segment = 1").drop("segment"), "state")
    assert first == pytest.approx(loop(episodes, mean_targets, first))
