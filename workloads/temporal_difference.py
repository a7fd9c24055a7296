"""Temporal-difference evaluation and control on logged steps (e*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from backsight.functions.draws import uniform as draw
from backsight.operators import backups as S
from backsight.operators import models as M
from backsight.operators import online
from backsight.plans import learning, planning

from . import common as C
from .common import EVENT_ACTIONS, GAMMA, ORACLES, query
from .planning_and_returns import TIGHT
from .sqltext import r, statement, uniform_draw, v_sweeps
from .tables_and_policies import INTERVALS

SEED = 42
LR = 0.5
RATES = [LR, LR, LR]


def zero_v(spark, sf_dir):
    return M.init_v(C.states(spark, sf_dir))


def zero_q(spark, sf_dir):
    return M.init_q(C.states(spark, sf_dir), EVENT_ACTIONS)


Q0 = ("q0", "SELECT state, action, 0.0::DOUBLE AS q FROM pairs")


def v_learning(targets: str, count: int) -> list[tuple[str, str]]:
    """v_i from v_{i-1} and the step targets; ``targets`` yields (state, target)."""
    step = (
        f"SELECT o.state, coalesce(o.v + {LR} * (n.target - o.v), o.v) AS v FROM {{prev}} o LEFT JOIN "
        f"(SELECT state, avg(target) AS target FROM ({targets}) GROUP BY state) n USING (state)"
    )
    return v_sweeps(step, count)


def q_learning_blocks(targets: str, count: int, before: list[tuple[str, str]] | None = None) -> list[tuple[str, str]]:
    """q_i from q_{i-1}; ``targets`` yields (state, action, target) and may use {q}."""
    blocks = list(before or []) + [Q0]
    for i in range(1, count + 1):
        blocks.append(
            (
                f"q{i}",
                f"SELECT o.state, o.action, coalesce(o.q + {LR} * (n.target - o.q), o.q) AS q FROM q{i - 1} o LEFT JOIN "
                f"(SELECT state, action, avg(target) AS target FROM ({targets.replace('{q}', f'q{i - 1}')}) GROUP BY ALL) n "
                "USING (state, action)",
            )
        )
    return blocks


def q_result(name: str) -> str:
    return f"SELECT state, action, {r('q', 'q')} FROM {name}"


@query("e1_td0")
def e1(spark, sf_dir):
    return learning.td0(C.transitions(spark, sf_dir), zero_v(spark, sf_dir), GAMMA, RATES)


ORACLES["e1_td0"] = statement(
    f"SELECT state, {r('v', 'v')} FROM v3", "transitions", "v0",
    extra=v_learning(
        f"SELECT t.state, t.reward + {GAMMA} * coalesce(p.v, 0) AS target FROM transitions t LEFT JOIN {{prev}} p ON t.next_state = p.state", 3
    ),
)


@query("e2_n_step_targets")
def e2_targets(spark, sf_dir):
    return S.n_step_targets(C.transitions(spark, sf_dir), GAMMA, 5)


N_STEP = f"""
SELECT *, sum(reward * pow({GAMMA}, step_count)) OVER (w ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) / pow({GAMMA}, step_count) AS partial_return,
       lead(state, 5) OVER w AS src_state FROM transitions WINDOW w AS (PARTITION BY segment, episode ORDER BY step_count)"""

ORACLES["e2_n_step_targets"] = statement(
    f"SELECT segment, episode, step_count, state, {r('reward', 'reward')}, {r('partial_return', 'partial_return')}, src_state FROM n_step",
    "transitions", extra=[("n_step", N_STEP)],
)


@query("e2_n_step_td")
def e2(spark, sf_dir):
    return learning.n_step_td(C.transitions(spark, sf_dir), zero_v(spark, sf_dir), GAMMA, 5, RATES)


ORACLES["e2_n_step_td"] = statement(
    f"SELECT state, {r('v', 'v')} FROM v3", "transitions", "v0",
    extra=[("n_step", N_STEP)] + v_learning(
        f"SELECT t.state, t.partial_return + pow({GAMMA}, 5) * coalesce(p.v, 0) AS target FROM n_step t LEFT JOIN {{prev}} p ON t.src_state = p.state", 3
    ),
)


@query("e3_td_lambda")
def e3(spark, sf_dir):
    return learning.td_lambda(C.transitions(spark, sf_dir), zero_v(spark, sf_dir), GAMMA, 0.9, [LR, LR])


ORACLES["e3_td_lambda"] = statement(
    f"SELECT state, {r('v', 'v')} FROM v2", "transitions", "v0",
    extra=v_learning(
        f"SELECT state, here + sum(error * pow({GAMMA} * 0.9, step_count)) OVER (PARTITION BY segment, episode ORDER BY step_count DESC) "
        f"/ pow({GAMMA} * 0.9, step_count) AS target FROM (SELECT t.*, h.v AS here, "
        f"t.reward + {GAMMA} * coalesce(p.v, 0) - h.v AS error FROM transitions t JOIN {{prev}} h USING (state) "
        "LEFT JOIN {prev} p ON t.next_state = p.state)", 2
    ),
)


@query("e4_sarsa")
def e4(spark, sf_dir):
    return learning.sarsa(C.transitions(spark, sf_dir), zero_q(spark, sf_dir), GAMMA, RATES)


FOLLOWED = ("followed", "SELECT *, lead(action) OVER (PARTITION BY segment, episode ORDER BY step_count) AS next_action FROM transitions")
SARSA = (
    f"SELECT t.state, t.action, t.reward + {GAMMA} * coalesce(n.q, 0) AS target FROM followed t "
    "LEFT JOIN {q} n ON t.next_state = n.state AND t.next_action = n.action"
)
ORACLES["e4_sarsa"] = statement(q_result("q3"), "transitions", "pairs", extra=q_learning_blocks(SARSA, 3, [FOLLOWED]))


@query("e4_sarsa_drawn")
def e4_drawn(spark, sf_dir):
    return learning.sarsa(
        C.transitions(spark, sf_dir), zero_q(spark, sf_dir), GAMMA, RATES, C.target_policy(spark, sf_dir), SEED
    )


DRAWN = (
    "followed",
    f"SELECT t.*, i.action AS next_action FROM (SELECT *, {uniform_draw(SEED, 'segment', 'episode', 'step_count')} AS u FROM transitions) t "
    "LEFT JOIN intervals i ON t.next_state = i.state AND t.u >= i.lo AND t.u < i.hi",
)
ORACLES["e4_sarsa_drawn"] = statement(
    q_result("q3"), "transitions", "pairs", "target",
    extra=q_learning_blocks(SARSA, 3, [("intervals", INTERVALS.format(policy="target")), DRAWN]),
)


@query("e5_expected_sarsa")
def e5(spark, sf_dir):
    return learning.expected_sarsa(
        C.transitions(spark, sf_dir), zero_q(spark, sf_dir), C.target_policy(spark, sf_dir), GAMMA, RATES
    )


ORACLES["e5_expected_sarsa"] = statement(
    q_result("q3"), "transitions", "pairs", "target",
    extra=q_learning_blocks(
        f"SELECT t.state, t.action, t.reward + {GAMMA} * coalesce(n.v, 0) AS target FROM transitions t LEFT JOIN "
        "(SELECT state, sum(policy * q) AS v FROM {q} JOIN target USING (state, action) GROUP BY state) n ON t.next_state = n.state", 3
    ),
)


@query("e6_tree_backup")
def e6(spark, sf_dir):
    return learning.tree_backup(
        C.transitions(spark, sf_dir), zero_q(spark, sf_dir), C.target_policy(spark, sf_dir), GAMMA, 3, RATES
    )


AHEAD = (
    "ahead",
    "SELECT t.*, p.policy AS p0, lead(t.state) OVER w AS s1, lead(t.action) OVER w AS a1, lead(t.reward) OVER w AS r1, "
    "lead(p.policy) OVER w AS p1, lead(t.state, 2) OVER w AS s2, lead(t.action, 2) OVER w AS a2, lead(t.reward, 2) OVER w AS r2, "
    "lead(p.policy, 2) OVER w AS p2, lead(t.state, 3) OVER w AS s3 FROM transitions t JOIN target p USING (state, action) "
    "WINDOW w AS (PARTITION BY t.segment, t.episode ORDER BY t.step_count)",
)
TREE = (
    "SELECT t.state, t.action, t.reward "
    f"+ coalesce({GAMMA} * (v1.v + p1 * (r1 - q1.q)), 0) "
    f"+ coalesce({GAMMA} * {GAMMA} * p1 * (v2.v + p2 * (r2 - q2.q)), 0) "
    f"+ coalesce({GAMMA} * {GAMMA} * p1 * {GAMMA} * p2 * v3.v, 0) AS target FROM ahead t "
    "LEFT JOIN {e} v1 ON v1.state = s1 LEFT JOIN {q} q1 ON q1.state = s1 AND q1.action = a1 "
    "LEFT JOIN {e} v2 ON v2.state = s2 LEFT JOIN {q} q2 ON q2.state = s2 AND q2.action = a2 LEFT JOIN {e} v3 ON v3.state = s3"
).replace("{e}", "(SELECT state, sum(policy * q) AS v FROM {q} JOIN target USING (state, action) GROUP BY state)")
ORACLES["e6_tree_backup"] = statement(
    q_result("q3"), "transitions", "pairs", "target", extra=q_learning_blocks(TREE, 3, [AHEAD])
)


@query("e7_q_learning")
def e7(spark, sf_dir):
    return learning.q_learning(C.transitions(spark, sf_dir), zero_q(spark, sf_dir), GAMMA, RATES)


BEST = (
    f"SELECT t.state, t.action, t.reward + {GAMMA} * coalesce(n.v, 0) AS target FROM {{rows}} t LEFT JOIN "
    "(SELECT state, max(q) AS v FROM {q} GROUP BY state) n ON t.next_state = n.state"
)
ORACLES["e7_q_learning"] = statement(
    q_result("q3"), "transitions", "pairs", extra=q_learning_blocks(BEST.replace("{rows}", "transitions"), 3)
)


@query("e8_double_q_learning")
def e8(spark, sf_dir):
    return learning.double_q_learning(
        C.transitions(spark, sf_dir), zero_q(spark, sf_dir), GAMMA, RATES, ["event_id"], SEED
    )


def _double_blocks(count: int) -> list[tuple[str, str]]:
    blocks = [("d0", "SELECT state, action, 0.0::DOUBLE AS q1, 0.0::DOUBLE AS q2 FROM pairs")]
    for i in range(1, count + 1):
        prev = f"d{i - 1}"
        blocks.append((f"h{i}", f"SELECT *, {uniform_draw(SEED, str(i - 1), 'event_id')} > 0.5 AS heads FROM transitions"))
        blocks.append(
            (
                f"c{i}",
                f"SELECT state, max(q2) FILTER (k1 = 1) AS for1, max(q1) FILTER (k2 = 1) AS for2 FROM (SELECT *, "
                "row_number() OVER (PARTITION BY state ORDER BY q1 DESC, action) AS k1, "
                f"row_number() OVER (PARTITION BY state ORDER BY q2 DESC, action) AS k2 FROM {prev}) GROUP BY state",
            )
        )
        blocks.append(
            (
                f"t{i}",
                f"SELECT t.state, t.action, avg(t.reward + {GAMMA} * coalesce(c.for1, 0)) FILTER (t.heads) AS t1, "
                f"avg(t.reward + {GAMMA} * coalesce(c.for2, 0)) FILTER (NOT t.heads) AS t2 "
                f"FROM h{i} t LEFT JOIN c{i} c ON t.next_state = c.state GROUP BY ALL",
            )
        )
        blocks.append(
            (
                f"d{i}",
                f"SELECT state, action, coalesce(q1 + {LR} * (t1 - q1), q1) AS q1, coalesce(q2 + {LR} * (t2 - q2), q2) AS q2 "
                f"FROM {prev} LEFT JOIN t{i} USING (state, action)",
            )
        )
    return blocks


ORACLES["e8_double_q_learning"] = statement(
    f"SELECT state, action, {r('(q1 + q2) / 2', 'q')} FROM d3", "transitions", "pairs", extra=_double_blocks(3)
)


@query("e9_replay_draws")
def e9_draws(spark, sf_dir):
    steps = C.transitions(spark, sf_dir)
    experience = learning.numbered_experience(steps, by_pair=False)
    return learning.draw_experience(experience, steps.count(), SEED, by_pair=False).select("draw", "event_id")


@query("e9_replay_draws_by_pair")
def e9_pairs(spark, sf_dir):
    steps = C.transitions(spark, sf_dir)
    experience = learning.numbered_experience(steps, by_pair=True)
    return learning.draw_experience(experience, steps.count(), SEED, by_pair=True).select("draw", "event_id")


DRAWS = ("draws", "SELECT i AS draw FROM (SELECT count(*) AS n FROM transitions) c, range(c.n) t(i)")
NUMBERED = ("numbered", "SELECT *, row_number() OVER (ORDER BY ts, event_id) AS row_no FROM transitions")


def _picked(seed: int) -> str:
    return (
        f"SELECT d.draw, x.* FROM (SELECT draw, floor({uniform_draw(seed, 'draw')} * (SELECT count(*) FROM transitions)) + 1 AS row_no FROM draws) d "
        "JOIN numbered x USING (row_no)"
    )


ORACLES["e9_replay_draws"] = statement(
    "SELECT draw, event_id FROM picked", "transitions", extra=[DRAWS, NUMBERED, ("picked", _picked(SEED))]
)
ORACLES["e9_replay_draws_by_pair"] = statement(
    f"SELECT d.draw, x.event_id FROM (SELECT draw, floor({uniform_draw(SEED, chr(39) + 'pair' + chr(39), 'draw')} * (SELECT count(*) FROM seen)) + 1 AS pair_no FROM draws) d "
    f"JOIN seen s USING (pair_no) JOIN within x ON x.state = s.state AND x.action = s.action AND "
    f"x.row_no = floor({uniform_draw(SEED, chr(39) + 'step' + chr(39), 'draw')} * s.size) + 1",
    "transitions",
    extra=[
        DRAWS,
        ("within", "SELECT *, row_number() OVER (PARTITION BY state, action ORDER BY ts, event_id) AS row_no FROM transitions"),
        ("seen", "SELECT state, action, count(*) AS size, row_number() OVER (ORDER BY state, action) AS pair_no FROM transitions GROUP BY state, action"),
    ],
)


@query("e9_dyna_q")
def e9(spark, sf_dir):
    steps = C.transitions(spark, sf_dir)
    return learning.dyna_q(steps, zero_q(spark, sf_dir), GAMMA, [LR, LR], steps.count(), SEED)


def _dyna_blocks() -> list[tuple[str, str]]:
    blocks = [DRAWS, NUMBERED, ("picked0", _picked(SEED)), ("picked1", _picked(SEED + 1)), Q0]
    for i, rows in enumerate(["transitions", "picked0", "transitions", "picked1"], start=1):
        targets = BEST.replace("{rows}", rows).replace("{q}", f"q{i - 1}")
        blocks.append(
            (
                f"q{i}",
                f"SELECT o.state, o.action, coalesce(o.q + {LR} * (n.target - o.q), o.q) AS q FROM q{i - 1} o LEFT JOIN "
                f"(SELECT state, action, avg(target) AS target FROM ({targets}) GROUP BY ALL) n USING (state, action)",
            )
        )
    return blocks


ORACLES["e9_dyna_q"] = statement(q_result("q4"), "transitions", "pairs", extra=_dyna_blocks())


@query("e10_prioritised_dyna_q")
def e10(spark, sf_dir):
    return planning.prioritised_q_iteration(C.model(spark, sf_dir), GAMMA, TIGHT)[0]


ORACLES["e10_prioritised_dyna_q"] = ORACLES["c11_q_value_iteration"]


EVALUATED = 1e-10


@query("e11_policy_iteration_sarsa")
def e11_sarsa(spark, sf_dir):
    steps = C.transitions(spark, sf_dir)

    def evaluate(q, policy):
        return learning.settled_sarsa(steps, q, policy, GAMMA, SEED, EVALUATED)

    q, policy = learning.settled_policy_iteration(evaluate, zero_q(spark, sf_dir), C.uniform(spark, sf_dir), [0.2, 0.0])
    return q.join(policy, ["state", "action"])


@query("e11_policy_iteration_expected_sarsa")
def e11(spark, sf_dir):
    steps = C.transitions(spark, sf_dir)

    def evaluate(q, policy):
        return learning.settled_expected_sarsa(steps, q, policy, GAMMA, EVALUATED)

    q, policy = learning.settled_policy_iteration(evaluate, zero_q(spark, sf_dir), C.uniform(spark, sf_dir), [0.2, 0.0])
    return q.join(policy, ["state", "action"])


# --- learning one step at a time, per segment ---------------------------------------------------------------------

RATE = (C.LR_BASE, C.LR_PERIOD, C.LR_POWER)


def _online(name: str, **options):
    @query(f"e12_online_{name}")
    def run(spark, sf_dir):
        policy = C.target_policy(spark, sf_dir) if name in ("expected_sarsa", "tree_backup") else None
        return online.learn_per_segment(
            C.transitions(spark, sf_dir), name, GAMMA, RATE, len(EVENT_ACTIONS), policy, seed=SEED, **options
        )


_online("td0")
_online("n_step_td", n=5)
_online("td_lambda", trace=0.9)
_online("sarsa")
_online("expected_sarsa")
_online("tree_backup", n=3)
_online("q_learning")
_online("double_q_learning")
_online("dyna_q", replays=10)
