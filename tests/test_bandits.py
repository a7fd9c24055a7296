import math
import random

import pytest

from backsight.functions.draws import uniform
from backsight.operators import agents as A
from backsight.operators import bandits as N
from golden import as_dict

LR = 0.1


@pytest.fixture(scope="module")
def pulls(spark):
    rng = random.Random(2)
    rows = [(c, i + 1, rng.randrange(3), round(rng.uniform(0, 2), 3)) for c, n in ((0, 90), (1, 13), (2, 1)) for i in range(n)]
    return rows, spark.createDataFrame(rows, "context LONG, pull_no LONG, arm LONG, reward DOUBLE").repartition(4).cache()


@pytest.mark.parametrize("span", [1, 7, 1000])
def test_estimates_equal_the_loop(pulls, span):
    rows, df = pulls
    expected, counts = {}, {}
    for c, _, arm, reward in rows:
        e = expected.get((c, arm), 2.0)
        expected[c, arm] = e + LR * (reward - e)
        counts[c, arm] = counts.get((c, arm), 0) + 1
    found = N.constant_step_estimates(df, LR, 2.0, span).collect()
    assert {(r.context, r.arm): r.estimate for r in found} == pytest.approx(expected)
    assert {(r.context, r.arm): r.n for r in found} == counts


def test_ucb_tries_every_arm_first(spark, pulls):
    _, df = pulls
    arms = N.all_arms(N.constant_step_estimates(df, LR), [0, 1, 2, 3])
    assert arms.count() == 12 and as_dict(N.ucb_choice(arms, 2.0), "context")[0] == 3
    pulled = arms.filter("context = 0 and n > 0")
    total = sum(r.n for r in pulled.collect())
    for r in N.ucb_scores(pulled, 2.0).collect():
        assert r.score == pytest.approx(r.estimate + 2.0 * math.sqrt(math.log(total) / r.n))


@pytest.mark.parametrize("span", [5, 1000])
def test_curves(pulls, span):
    rows, df = pulls
    found = {(r.context, r.pull_no): r for r in N.reward_curves(df, span).collect()}
    so_far = 0.0
    for c, i, arm, reward in rows:
        if c == 0:
            so_far += reward
            same = [x[3] for x in rows if x[0] == 0 and x[2] == arm]
            assert found[0, i].cumulative_reward == pytest.approx(so_far)
            assert found[0, i].expected_reward == pytest.approx(sum(same) / len(same))


def plain_chances(rule, estimates, counts):
    n = len(estimates)
    if rule.softmax:
        total = sum(math.exp(e) for e in estimates)
        return [math.exp(e) / total for e in estimates]
    scores = list(estimates)
    if rule.bonus is not None:
        if 0 in counts:
            scores = [float(i == counts.index(0)) for i in range(n)]
        else:
            scores = [e + rule.bonus * math.sqrt(math.log(sum(counts)) / k) for e, k in zip(estimates, counts, strict=True)]
    ties = [s >= max(scores) - 1e-9 for s in scores]
    return [(1 - rule.eps) * t / sum(ties) + rule.eps / n for t in ties]


def plain_replay(rows, n_arms, rule, draws):
    """One pull after the other; without draws every pull counts."""
    state, kept = {}, []
    for context, number, arm, reward in sorted(rows, key=lambda r: (r[0], r[1])):
        estimates, counts, base = state.setdefault(context, ([rule.start] * n_arms, [0] * n_arms, [0.0, 0]))
        chance = plain_chances(rule, estimates, counts)
        if draws is not None:
            below = sum(sum(chance[: i + 1]) <= draws[context, number] for i in range(n_arms))
            if min(below, n_arms - 1) != arm:
                continue
            kept.append((context, number, arm, reward))
        if rule.softmax:
            for i in range(n_arms):
                estimates[i] += rule.rate * (reward - base[0]) * ((i == arm) - chance[i])
            if rule.mean_baseline:
                base[1] += 1
                base[0] += (reward - base[0]) / base[1]
        else:
            estimates[arm] += rule.rate * (reward - estimates[arm])
        counts[arm] += 1
    return state, kept


@pytest.mark.parametrize("mean_baseline", [False, True])
def test_gradient_bandit_equals_the_loop(pulls, mean_baseline):
    rows, df = pulls
    rule = A.Rule(rate=LR, softmax=True, mean_baseline=mean_baseline)
    state, _ = plain_replay(rows, 3, rule, None)
    found = {(r.context, r.arm): (r.n, r.estimate) for r in A.learned_preferences(df, 3, rule).collect()}
    assert {k: v[0] for k, v in found.items()} == {(c, i): n for c, s in state.items() for i, n in enumerate(s[1])}
    assert {k: v[1] for k, v in found.items()} == pytest.approx({(c, i): e for c, s in state.items() for i, e in enumerate(s[0])})


@pytest.mark.parametrize("name", sorted(A.RULES))
def test_replay_evaluation_equals_the_loop(pulls, name):
    rows, df = pulls
    draws = {(r.context, r.pull_no): r.u for r in df.withColumn("u", uniform(5, "context", "pull_no")).collect()}
    state, kept = plain_replay(rows, 3, A.RULES[name], draws)
    accepted, arms = A.replay_evaluation(df, 3, A.RULES[name], 5)
    assert sorted(map(tuple, accepted.collect())) == sorted(kept)
    found = {(r.context, r.arm): r.estimate for r in arms.collect()}
    assert found == pytest.approx({(c, i): e for c, s in state.items() for i, e in enumerate(s[0])})


def test_bad_pulls_are_refused(spark):
    bad = spark.createDataFrame([(1, 1, 7, 0.5)], "context LONG, pull_no LONG, arm LONG, reward DOUBLE")
    with pytest.raises(Exception, match="an arm outside"):
        A.learned_preferences(bad, 3, A.RULES["greedy"]).collect()


def test_a_null_context_is_a_context(spark):
    rows = [(c, n, n % 2, float(n)) for c in (None, 1) for n in range(1, 6)]
    pulls = spark.createDataFrame(rows, "context LONG, pull_no LONG, arm LONG, reward DOUBLE")
    for frame in (N.constant_step_estimates(pulls, 0.1, span=2), N.reward_curves(pulls, span=2).drop("pull_no")):
        found = [tuple(r)[1:] for r in frame.collect() if r.context is None]
        assert found and sorted(found) == sorted(tuple(r)[1:] for r in frame.collect() if r.context == 1)
