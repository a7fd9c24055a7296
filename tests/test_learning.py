import pytest

from backsight.operators import models as M
from backsight.plans import learning
from backsight.plans.loop import NotSettled
from golden import as_dict, transitions


@pytest.mark.parametrize("evaluator", ["expected_sarsa", "sarsa"])
def test_policy_iteration_finds_the_better_actions(spark, evaluator):
    steps = transitions(spark, [[(0, 0, 0.0), (1, 0, 1.0)], [(0, 1, 0.2)], [(1, 1, 0.0)]])
    pairs = (M.state_space(steps), [0, 1])

    def evaluate(q, policy):
        if evaluator == "sarsa":
            return learning.sarsa(steps, q, 0.5, [1.0] * 2, policy, 3)
        return learning.expected_sarsa(steps, q, policy, 0.5, [1.0] * 2)

    q, policy, used = learning.generalised_policy_iteration(
        evaluate, M.init_q(*pairs), M.uniform_policy(*pairs), [0.0], max_rounds=5
    )
    assert as_dict(q, "state", "action") == pytest.approx({(0, 0): 0.5, (0, 1): 0.2, (1, 0): 1.0, (1, 1): 0.0})
    assert as_dict(policy, "state", "action") == {(0, 0): 1.0, (0, 1): 0.0, (1, 0): 1.0, (1, 1): 0.0}
    assert used[0][1] <= 4


@pytest.mark.parametrize("evaluator", ["expected_sarsa", "sarsa"])
def test_settled_policy_iteration_reaches_the_fixed_point_or_raises(spark, evaluator):
    chain = [(s, 0, 0.0) for s in range(2)] + [(2, 0, 1.0)]
    steps = transitions(spark, [chain, [(0, 1, 0.2)]])
    pairs = (M.state_space(steps), [0, 1])

    def evaluate(q, policy):
        if evaluator == "sarsa":
            return learning.settled_sarsa(steps, q, policy, 0.9, 3, 1e-10)
        return learning.settled_expected_sarsa(steps, q, policy, 0.9, 1e-10)

    q, policy = learning.settled_policy_iteration(evaluate, M.init_q(*pairs), M.uniform_policy(*pairs), [0.0])
    expected = {(s, 0): 0.9 ** (2 - s) for s in range(3)} | {(0, 1): 0.2} | {(s, 1): 0.0 for s in range(1, 3)}
    assert as_dict(q, "state", "action") == pytest.approx(expected)
    assert all(p == (a == 0) for (_, a), p in as_dict(policy, "state", "action").items())
    with pytest.raises(NotSettled):
        learning.settled_policy_iteration(evaluate, M.init_q(*pairs), M.uniform_policy(*pairs), [0.0], max_rounds=1)
