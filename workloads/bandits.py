"""Bandit statistics on logged pulls (f*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from backsight.functions.draws import uniform as draw
from backsight.operators import agents as A
from backsight.operators import bandits as N
from backsight.operators import policies as P

from . import common as C
from .common import ORACLES, query
from .sqltext import r, statement, uniform_draw

ARMS = [0, 1, 2, 3, 4]
LR = 0.01
SEED = 42
# one estimate per (context, arm) after all its pulls; i counts from the arm's last pull
ESTIMATES = (
    "SELECT context, arm, count(*)::BIGINT AS n, {start} * pow(1 - 0.01, count(*)) + sum(0.01 * pow(1 - 0.01, i - 1) * reward) AS estimate "
    "FROM (SELECT *, row_number() OVER (PARTITION BY context, arm ORDER BY pull_no DESC) AS i FROM pulls) GROUP BY ALL"
)


# the arms of the vocabulary that a context never pulled, too
EVERY = (
    "SELECT c.context, c.arm, coalesce(n, 0) AS n, coalesce(estimate, {start}) AS estimate FROM "
    "(SELECT DISTINCT context, a AS arm FROM pulls, range(5) t(a)) c LEFT JOIN arms USING (context, arm)"
)


@query("f0_pulls")
def f0(spark, sf_dir):
    return C.pulls(spark, sf_dir)


ORACLES["f0_pulls"] = statement(f"SELECT context, pull_no, arm, {r('reward', 'reward')} FROM pulls", "pulls")


@query("f1_arm_estimates")
def f1(spark, sf_dir):
    return N.constant_step_estimates(C.pulls(spark, sf_dir), LR)


ORACLES["f1_arm_estimates"] = statement(
    f"SELECT context, arm, n, {r('estimate', 'estimate')} FROM arms", "pulls", extra=[("arms", ESTIMATES.format(start=0))]
)


@query("f2_optimistic_choice")
def f2(spark, sf_dir):
    arms = N.constant_step_estimates(C.pulls(spark, sf_dir), LR, N.OPTIMISTIC_START)
    every = N.all_arms(arms, ARMS, N.OPTIMISTIC_START)
    return every.join(P.greedy_draw(every, "estimate", ["context"], "arm", SEED).withColumnRenamed("arm", "choice"), "context")


ORACLES["f2_optimistic_choice"] = statement(
    f"SELECT a.context, a.arm, a.n, {r('a.estimate', 'estimate')}, b.choice FROM every a JOIN (SELECT context, arm AS choice FROM "
    "(SELECT *, row_number() OVER (PARTITION BY context ORDER BY u, arm) AS k FROM (SELECT *, "
    f"{uniform_draw(SEED, 'context', 'arm')} AS u FROM every QUALIFY estimate >= max(estimate) OVER (PARTITION BY context) - 1e-9)) "
    "WHERE k = 1) b USING (context)",
    "pulls", extra=[("arms", ESTIMATES.format(start=N.OPTIMISTIC_START)), ("every", EVERY.format(start=N.OPTIMISTIC_START))],
)


@query("f3_eps_greedy_choice")
def f3(spark, sf_dir):
    pulls = C.pulls(spark, sf_dir)
    policy = N.eps_greedy_arms(N.constant_step_estimates(pulls, LR), 0.1).select(
        F.col("context").alias("state"), F.col("arm").alias("action"), "policy"
    )
    rows = pulls.select("context", "pull_no")
    return P.sample_action(rows, policy, draw(SEED, "context", "pull_no"), "choice", "context")


ORACLES["f3_eps_greedy_choice"] = statement(
    f"SELECT p.context, p.pull_no, i.arm AS choice FROM (SELECT *, {uniform_draw(SEED, 'context', 'pull_no')} AS u FROM pulls) p "
    "JOIN intervals i ON p.context = i.context AND p.u >= i.lo AND p.u < i.hi",
    "pulls",
    extra=[
        ("arms", ESTIMATES.format(start=0)),
        ("greedy", "SELECT *, (estimate >= max(estimate) OVER (PARTITION BY context) - 1e-9)::INT::DOUBLE AS g FROM arms"),
        ("policy", "SELECT context, arm, 0.9 * g / sum(g) OVER (PARTITION BY context) + 0.1 / count(*) OVER (PARTITION BY context) AS policy FROM greedy"),
        ("stacked", "SELECT *, sum(policy) OVER (PARTITION BY context ORDER BY arm) AS top FROM policy"),
        ("intervals", "SELECT *, coalesce(lag(top) OVER w, 0) AS lo, CASE WHEN lead(1) OVER w IS NULL THEN 2 ELSE top END AS hi "
                      "FROM stacked WINDOW w AS (PARTITION BY context ORDER BY arm)"),
    ],
)


@query("f4_ucb_scores")
def f4(spark, sf_dir):
    arms = N.all_arms(N.constant_step_estimates(C.pulls(spark, sf_dir), LR), ARMS)
    choice = N.ucb_choice(arms, 2.0).withColumnRenamed("arm", "choice")
    return N.ucb_scores(arms, 2.0).join(choice, "context")


ORACLES["f4_ucb_scores"] = statement(
    f"SELECT context, arm, n, {r('estimate', 'estimate')}, {r('score', 'score')}, first_value(arm) OVER (PARTITION BY context ORDER BY score DESC, arm) AS choice "
    "FROM (SELECT *, CASE WHEN n = 0 THEN 'infinity'::DOUBLE ELSE estimate + 2.0 * sqrt(ln(sum(n) OVER (PARTITION BY context)) / n) END AS score FROM every)",
    "pulls", extra=[("arms", ESTIMATES.format(start=0)), ("every", EVERY.format(start=0))],
)


@query("f5_gradient_bandit")
def f5(spark, sf_dir):
    learned = A.learned_preferences(C.pulls(spark, sf_dir), len(ARMS), A.RULES["gradient"])
    return P.softmax_policy(learned, "estimate", ["context"], "arm").join(learned, ["context", "arm"])


def _replayed(name: str):
    @query(f"f6_replay_{name}")
    def run(spark, sf_dir):
        return A.replay_evaluation(C.pulls(spark, sf_dir), len(ARMS), A.RULES[name], SEED)[0]


for _name in A.RULES:
    _replayed(_name)


SOFTMAX = "list_transform(est, lambda x: exp(x - list_max(est)) / list_sum(list_transform(est, lambda y: exp(y - list_max(est)))))"


def _chances_sql(rule: A.Rule) -> str:
    """The chance of each arm from the lists ``est`` and ``n``."""
    if rule.softmax:
        return SOFTMAX
    scores = "est"
    if rule.bonus is not None:
        rare = f"list_transform(range(1, 6), lambda i: est[i] + {rule.bonus} * sqrt(ln(list_sum(n)) / n[i]))"
        scores = f"CASE WHEN list_contains(n, 0) THEN list_transform(range(1, 6), lambda i: (i = list_position(n, 0))::INT::DOUBLE) ELSE {rare} END"
    best = f"list_transform(range(1, 6), lambda i: ({{s}}[i] >= list_max({{s}}) - 1e-9)::INT::DOUBLE)".replace("{s}", "sc")
    return f"(SELECT list_transform(g, lambda x: (1 - {rule.eps}) * x / list_sum(g) + {rule.eps} / 5) FROM (SELECT {best} AS g FROM (SELECT {scores} AS sc)))"


def _replay_sql(rule: A.Rule, accept: bool) -> list[tuple[str, str]]:
    """All contexts at once, one pull of each per round; what is learned travels as lists."""
    chosen = f"least(4, len(list_filter(range(1, 6), lambda i: list_sum(ch[1:i]) <= u)))" if accept else "arm"
    if rule.softmax:
        moved = f"list_transform(range(1, 6), lambda i: est[i] + {rule.rate} * reward * ((i = arm + 1)::INT - ch[i]))"
    else:
        moved = f"list_transform(range(1, 6), lambda i: CASE WHEN i = arm + 1 THEN est[i] + {rule.rate} * (reward - est[i]) ELSE est[i] END)"
    return [
        ("drawn", f"SELECT *, {uniform_draw(SEED, 'context', 'pull_no')} AS u FROM pulls"),
        (
            "run",
            f"SELECT DISTINCT context, 0::BIGINT AS k, [{', '.join([f'{rule.start}::DOUBLE'] * 5)}] AS est, [0, 0, 0, 0, 0]::DOUBLE[] AS n, false AS hit FROM drawn "
            f"UNION ALL SELECT context, k + 1, CASE WHEN hit THEN {moved} ELSE est END, "
            "CASE WHEN hit THEN list_transform(range(1, 6), lambda i: n[i] + (i = arm + 1)::INT) ELSE n END, hit "
            f"FROM (SELECT *, {chosen} = arm AS hit FROM (SELECT r.context, r.k, r.est, r.n, d.arm, d.reward, d.u, {_chances_sql(rule)} AS ch "
            "FROM run r JOIN drawn d ON d.context = r.context AND d.pull_no = r.k + 1))",
        ),
    ]


for _name, _rule in A.RULES.items():
    ORACLES[f"f6_replay_{_name}"] = statement(
        f"SELECT context, pull_no, arm, {r('reward', 'reward')} FROM pulls JOIN run USING (context) WHERE k = pull_no AND hit",
        "pulls", extra=_replay_sql(_rule, True),
    )
ORACLES["f5_gradient_bandit"] = statement(
    f"SELECT context, arm, n, {r('estimate', 'estimate')}, {r('policy', 'policy')} FROM "
    f"(SELECT context, unnest(range(0, 5)) AS arm, unnest(n)::BIGINT AS n, unnest(est) AS estimate, unnest({SOFTMAX}) AS policy FROM run "
    "QUALIFY k = max(k) OVER (PARTITION BY context))",
    "pulls", extra=_replay_sql(A.RULES["gradient"], False),
)


@query("f7_reward_curves")
def f7(spark, sf_dir):
    return N.reward_curves(C.pulls(spark, sf_dir))


ORACLES["f7_reward_curves"] = statement(
    f"SELECT context, pull_no, arm, {r('sum(reward) OVER (PARTITION BY context ORDER BY pull_no)', 'cumulative_reward')}, "
    f"{r('avg(reward) OVER (PARTITION BY context, arm)', 'expected_reward')} FROM pulls",
    "pulls",
)
