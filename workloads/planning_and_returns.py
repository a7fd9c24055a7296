"""Planning over the model table (c*) and Monte Carlo evaluation (d*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from backsight.operators import bellman as B
from backsight.operators import models as M
from backsight.operators import priorities as PQ
from backsight.operators import returns as R
from backsight.plans import planning
from backsight.storage import settle

from . import common as C
from .common import GAMMA, LR_BASE, LR_PERIOD, LR_POWER, ORACLES, query
from .sqltext import r, statement, v_sweeps
from .tables_and_policies import OPTIMAL_V, Q_FROM

EXPECTED_V = """
SELECT m.state, sum(u.policy * m.probability * (m.reward + {g} * CASE WHEN m.done THEN 0 ELSE coalesce(p.v, 0) END)) AS v
FROM model m JOIN uniform u USING (state, action) LEFT JOIN {prev} p ON m.next_state = p.state GROUP BY m.state"""


TIGHT = 1e-11  # of the last change; the value is then within 2e-10 of the fixed point
SWEEPS = 700  # of the check SQL: 0.95 ** 700 is 3e-16


def fixed_point(name: str, step: str) -> list[tuple[str, str]]:
    """``name`` (state, v) after many sweeps; ``step`` gives (k, state, v) from the table ``it``."""
    return [
        ("it", f"SELECT 0 AS k, state, 0.0::DOUBLE AS v FROM states UNION ALL {step}"),
        (name, f"SELECT state, v FROM it WHERE k = {SWEEPS}"),
    ]


TARGETS = f"m.probability * (m.reward + {GAMMA} * CASE WHEN m.done THEN 0 ELSE p.v END)"
NEXT = f"model m JOIN it p ON coalesce(m.next_state, m.state) = p.state WHERE p.k < {SWEEPS}"
OPTIMAL = fixed_point(
    "best",
    f"SELECT k + 1, state, max(q) FROM (SELECT p.k, m.state, m.action, sum({TARGETS}) AS q FROM {NEXT} GROUP BY ALL) GROUP BY k, state",
)
EVALUATED = fixed_point(
    "value",
    f"SELECT p.k + 1, m.state, sum(u.policy * {TARGETS}) FROM {NEXT.replace(' WHERE', ' JOIN uniform u ON u.state = m.state AND u.action = m.action WHERE')} GROUP BY p.k, m.state",
)


@query("c1_expected_backup")
def c1(spark, sf_dir):
    model = C.model(spark, sf_dir)
    v = settle(planning.value_iteration_sweeps(model, GAMMA, 1), "v")
    return B.expected_backup(model, v, C.uniform(spark, sf_dir), GAMMA)


ORACLES["c1_expected_backup"] = statement(
    f"SELECT state, {r('v', 'v')} FROM e", "model", "v0", "uniform",
    extra=v_sweeps(OPTIMAL_V, 1) + [("e", EXPECTED_V.format(prev="v1", g=GAMMA))],
)


@query("c1_expected_backup_one_state")
def c1_state(spark, sf_dir):
    model = C.model(spark, sf_dir)
    v = settle(planning.value_iteration_sweeps(model, GAMMA, 1), "v")
    return B.expected_backup(model, v, C.uniform(spark, sf_dir), GAMMA, state=7)


ORACLES["c1_expected_backup_one_state"] = ORACLES["c1_expected_backup"] + " WHERE state = 7"


@query("c2_optimal_backup")
def c2(spark, sf_dir):
    model = C.model(spark, sf_dir)
    return B.optimal_backup(model, settle(planning.value_iteration_sweeps(model, GAMMA, 1), "v"), GAMMA)


ORACLES["c2_optimal_backup"] = statement(f"SELECT state, {r('v', 'v')} FROM v2", "model", "v0", extra=v_sweeps(OPTIMAL_V, 2))


@query("c3_optimal_q_backup")
def c3(spark, sf_dir):
    model = C.model(spark, sf_dir)
    q = settle(planning.q_value_iteration_sweeps(model, GAMMA, 1), "q")
    return B.optimal_q_backup(model, q, GAMMA)


def q_sweeps(count: int) -> list[tuple[str, str]]:
    blocks = [("q0", "SELECT DISTINCT state, action, 0.0::DOUBLE AS q FROM model")]
    for i in range(1, count + 1):
        blocks.append((f"w{i}", f"SELECT state, max(q) AS v FROM q{i - 1} GROUP BY state"))
        blocks.append((f"q{i}", Q_FROM.format(prev=f"w{i}", g=GAMMA)))
    return blocks


ORACLES["c3_optimal_q_backup"] = statement(f"SELECT state, action, {r('q', 'q')} FROM q2", "model", extra=q_sweeps(2))


@query("c4_q_from_v")
def c4(spark, sf_dir):
    model = C.model(spark, sf_dir)
    return B.q_from_v(model, settle(planning.value_iteration_sweeps(model, GAMMA, 1), "v"), GAMMA)


ORACLES["c4_q_from_v"] = statement(
    f"SELECT state, action, {r('q', 'q')} FROM q", "model", "v0",
    extra=v_sweeps(OPTIMAL_V, 1) + [("q", Q_FROM.format(prev="v1", g=GAMMA))],
)


@query("c5_policy_evaluation")
def c5(spark, sf_dir):
    return planning.evaluate_policy(C.model(spark, sf_dir), _zero_v(spark, sf_dir), C.uniform(spark, sf_dir), GAMMA, TIGHT)[0]


@query("c5_policy_evaluation_sweeps")
def c5_sweeps(spark, sf_dir):
    model = C.model(spark, sf_dir)
    return planning.evaluate_policy_sweeps(model, _zero_v(spark, sf_dir), C.uniform(spark, sf_dir), GAMMA, 5)


def _zero_v(spark, sf_dir):
    return M.init_v(C.states(spark, sf_dir))


ORACLES["c5_policy_evaluation"] = statement(f"SELECT state, {r('v', 'v')} FROM value", "model", "states", "uniform", extra=EVALUATED)
ORACLES["c5_policy_evaluation_sweeps"] = statement(
    f"SELECT state, {r('v', 'v')} FROM v5", "model", "v0", "uniform", extra=v_sweeps(EXPECTED_V, 5)
)


@query("c6_policy_evaluation_in_blocks")
def c6(spark, sf_dir):
    return planning.evaluate_policy_in_blocks(
        C.model(spark, sf_dir), _zero_v(spark, sf_dir), C.uniform(spark, sf_dir), GAMMA, blocks=2, sweeps=2
    )


def _block_sweeps() -> list[tuple[str, str]]:
    blocks, turn = [], 0
    for _ in range(2):
        for block in range(2):
            turn += 1
            part = EXPECTED_V.format(prev=f"v{turn - 1}", g=GAMMA).replace(
                "GROUP BY m.state", f"WHERE m.state % 2 = {block} GROUP BY m.state"
            )
            blocks.append(
                (f"v{turn}", f"SELECT o.state, coalesce(n.v, o.v) AS v FROM v{turn - 1} o LEFT JOIN ({part}) n USING (state)")
            )
    return blocks


ORACLES["c6_policy_evaluation_in_blocks"] = statement(
    f"SELECT state, {r('v', 'v')} FROM v4", "model", "v0", "uniform", extra=_block_sweeps()
)


@query("c6_policy_evaluation_in_place")
def c6_in_place(spark, sf_dir):
    return planning.evaluate_policy_in_place(C.model(spark, sf_dir), C.uniform(spark, sf_dir), GAMMA, TIGHT)[0]


ORACLES["c6_policy_evaluation_in_place"] = ORACLES["c5_policy_evaluation"]


@query("c7_linear_system_left")
def c7_left(spark, sf_dir):
    return B.linear_system(C.model(spark, sf_dir), C.uniform(spark, sf_dir), GAMMA)[0]


@query("c7_linear_system_right")
def c7_right(spark, sf_dir):
    return B.linear_system(C.model(spark, sf_dir), C.uniform(spark, sf_dir), GAMMA)[1]


ORACLES["c7_linear_system_left"] = statement(
    f"SELECT state, next_state, {r('sum(c)', 'coefficient')} FROM ("
    f"SELECT m.state, m.next_state, -{GAMMA} * u.policy * m.probability AS c FROM model m JOIN uniform u USING (state, action) "
    "WHERE NOT m.done UNION ALL SELECT state, state, 1.0 FROM states) GROUP BY state, next_state",
    "model", "uniform",
)
ORACLES["c7_linear_system_right"] = statement(
    f"SELECT m.state, {r('sum(u.policy * m.probability * m.reward)', 'b')} FROM model m JOIN uniform u USING (state, action) GROUP BY m.state",
    "model", "uniform",
)


@query("c8_solve_policy_value")
def c8(spark, sf_dir):
    return planning.solve_policy_value(C.model(spark, sf_dir), C.uniform(spark, sf_dir), GAMMA, TIGHT)[0]


ORACLES["c8_solve_policy_value"] = ORACLES["c5_policy_evaluation"]


@query("c9_policy_iteration")
def c9(spark, sf_dir):
    v, policy, _ = planning.policy_iteration(C.model(spark, sf_dir), C.uniform(spark, sf_dir), GAMMA, TIGHT)
    return policy.join(v, "state")


ORACLES["c9_policy_iteration"] = statement(
    f"SELECT state, action, {r('g / sum(g) OVER (PARTITION BY state)', 'policy')}, {r('v', 'v')} FROM "
    "(SELECT q.*, b.v, (q.q >= max(q.q) OVER (PARTITION BY q.state) - 1e-9)::INT::DOUBLE AS g FROM q JOIN best b USING (state))",
    "model", "states", extra=[*OPTIMAL, ("q", Q_FROM.format(prev="best", g=GAMMA))],
)


@query("c10_value_iteration")
def c10(spark, sf_dir):
    return planning.value_iteration(C.model(spark, sf_dir), GAMMA, TIGHT)[0]


@query("c10_value_iteration_sweeps")
def c10_sweeps(spark, sf_dir):
    return planning.value_iteration_sweeps(C.model(spark, sf_dir), GAMMA, 5)


ORACLES["c10_value_iteration"] = statement(f"SELECT state, {r('v', 'v')} FROM best", "model", "states", extra=OPTIMAL)
ORACLES["c10_value_iteration_sweeps"] = statement(f"SELECT state, {r('v', 'v')} FROM v5", "model", "v0", extra=v_sweeps(OPTIMAL_V, 5))


@query("c11_q_value_iteration")
def c11(spark, sf_dir):
    return planning.q_value_iteration(C.model(spark, sf_dir), GAMMA, TIGHT)[0]


@query("c11_q_value_iteration_sweeps")
def c11_sweeps(spark, sf_dir):
    return planning.q_value_iteration_sweeps(C.model(spark, sf_dir), GAMMA, 4)


ORACLES["c11_q_value_iteration"] = statement(
    f"SELECT state, action, {r('q', 'q')} FROM q", "model", "states", extra=[*OPTIMAL, ("q", Q_FROM.format(prev="best", g=GAMMA))]
)
ORACLES["c11_q_value_iteration_sweeps"] = statement(f"SELECT state, action, {r('q', 'q')} FROM q4", "model", extra=q_sweeps(4))


@query("c12_visited_value_iteration")
def c12(spark, sf_dir):
    steps = C.transitions(spark, sf_dir)
    days = [F.dayofmonth("ts") == day for day in range(1, 7)]
    visits = [steps.filter(day) for day in days] + [steps]
    return planning.visited_value_iteration(C.model(spark, sf_dir), visits, GAMMA, 0.1, plateau=8)[0]


def _visit_blocks() -> list[tuple[str, str]]:
    blocks = []
    for i in range(1, 8):
        day = f"WHERE day(ts) = {i}" if i < 7 else ""
        fresh = OPTIMAL_V.format(prev=f"v{i - 1}", g=GAMMA)
        blocks.append(
            (f"v{i}", f"SELECT o.state, CASE WHEN s.state IS NULL THEN o.v ELSE n.v END AS v FROM v{i - 1} o JOIN ({fresh}) n USING (state) "
                      f"LEFT JOIN (SELECT DISTINCT state FROM transitions {day}) s USING (state)")
        )
    return blocks


ORACLES["c12_visited_value_iteration"] = statement(
    f"SELECT state, {r('v', 'v')} FROM v7", "transitions", "model", "v0", extra=_visit_blocks()
)


@query("c13_prioritised_value_iteration")
def c13(spark, sf_dir):
    return planning.prioritised_value_iteration(C.model(spark, sf_dir), GAMMA, TIGHT)[0]


ORACLES["c13_prioritised_value_iteration"] = ORACLES["c10_value_iteration"]


@query("c14_priority_put")
def c14_put(spark, sf_dir):
    steps = C.transitions(spark, sf_dir)
    old = steps.filter("reward < 1").select("state", "action", F.col("reward").alias("priority"))
    new = steps.filter("reward >= 1").select("state", "action", F.col("reward").alias("priority"))
    return PQ.put(old, new, ["state", "action"])


@query("c14_priority_pop")
def c14_pop(spark, sf_dir):
    steps = C.transitions(spark, sf_dir)
    queue = steps.groupBy("state", "action").agg(F.max("reward").alias("priority"))
    return PQ.pop(queue, ["state", "action"], 10)[1]


ORACLES["c14_priority_put"] = statement(
    f"SELECT state, action, {r('max(reward)', 'priority')} FROM transitions GROUP BY state, action", "transitions"
)
ORACLES["c14_priority_pop"] = statement(
    f"SELECT state, action, {r('priority', 'priority')} FROM (SELECT *, row_number() OVER (ORDER BY priority DESC, state, action) AS k "
    "FROM (SELECT state, action, max(reward) AS priority FROM transitions GROUP BY ALL)) WHERE k > 10",
    "transitions",
)


# --- returns --------------------------------------------------------------------------------------------------

RETURNS = f"""
SELECT *, sum(reward * pow({GAMMA}, step_count)) OVER (PARTITION BY segment, episode ORDER BY step_count DESC)
          / pow({GAMMA}, step_count) AS remaining_return FROM transitions"""
VISIT_TARGETS = "SELECT segment, episode, state, avg(remaining_return) AS target FROM returns GROUP BY ALL"
WEIGHTED = f"""
SELECT t.*, product(p.policy / b.policy) OVER w AS ratio,
       sum(t.reward * pow({GAMMA}, t.step_count)) OVER w / pow({GAMMA}, t.step_count) AS remaining_return
FROM transitions t JOIN target p USING (state, action) JOIN behaviour b USING (state, action)
WINDOW w AS (PARTITION BY t.segment, t.episode ORDER BY t.step_count DESC)"""
WEIGHTED_TARGETS = """
SELECT segment, episode, state, CASE WHEN sum(ratio) = 0 THEN 0 ELSE sum(ratio * remaining_return) / sum(ratio) END AS target
FROM weighted GROUP BY ALL"""
BLENDED = """
SELECT z.state, coalesce(m.v, z.v) AS v FROM v0 z LEFT JOIN (
  SELECT state, sum(lr * target * later) AS v FROM (
    SELECT state, lr, target, coalesce(product(1 - lr) OVER (PARTITION BY state ORDER BY number DESC
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS later
    FROM (SELECT t.state, t.target, n.number, 0.1 / pow(greatest(1.0, (n.number - 1) / 100.0), 0.51) AS lr
          FROM {targets} t JOIN numbers n USING (segment, episode))) GROUP BY state) m USING (state)"""
NUMBERS = """
SELECT segment, episode, row_number() OVER (ORDER BY ts, event_id) AS number FROM transitions WHERE step_count = 0"""


@query("d1_discounted_returns")
def d1(spark, sf_dir):
    return R.discounted_returns(C.transitions(spark, sf_dir), GAMMA).select("segment", "episode", "step_count", "remaining_return")


ORACLES["d1_discounted_returns"] = statement(
    f"SELECT segment, episode, step_count, {r('remaining_return', 'remaining_return')} FROM returns",
    "transitions", extra=[("returns", RETURNS)],
)


@query("d2_visit_targets")
def d2(spark, sf_dir):
    return R.visit_targets(R.discounted_returns(C.transitions(spark, sf_dir), GAMMA))


ORACLES["d2_visit_targets"] = statement(
    f"SELECT segment, episode, state, {r('target', 'target')} FROM targets",
    "transitions", extra=[("returns", RETURNS), ("targets", VISIT_TARGETS)],
)


@query("d3_blend")
def d3(spark, sf_dir):
    targets = R.discounted_returns(C.transitions(spark, sf_dir), GAMMA).groupBy("state").agg(F.avg("remaining_return").alias("target"))
    v = planning.value_iteration_sweeps(C.model(spark, sf_dir), GAMMA, 1)
    return R.blend(v, targets.filter("target > 5"), 0.1)


ORACLES["d3_blend"] = statement(
    f"SELECT state, {r('CASE WHEN target IS NULL THEN v ELSE 0.9 * v + 0.1 * target END', 'v')} FROM v1 LEFT JOIN "
    "(SELECT state, avg(remaining_return) AS target FROM returns GROUP BY state HAVING avg(remaining_return) > 5) USING (state)",
    "transitions", "model", "v0", extra=[("returns", RETURNS)] + v_sweeps(OPTIMAL_V, 1),
)


@query("d4_monte_carlo_evaluation")
def d4(spark, sf_dir):
    return R.monte_carlo_evaluation(
        C.transitions(spark, sf_dir), _zero_v(spark, sf_dir), GAMMA, LR_BASE, LR_PERIOD, LR_POWER
    )


ORACLES["d4_monte_carlo_evaluation"] = statement(
    f"SELECT state, {r('v', 'v')} FROM blended", "transitions", "v0",
    extra=[("returns", RETURNS), ("targets", VISIT_TARGETS), ("numbers", NUMBERS), ("blended", BLENDED.format(targets="targets"))],
)


@query("d4_monte_carlo_by_segment")
def d4_segment(spark, sf_dir):
    return R.monte_carlo_evaluation(
        C.transitions(spark, sf_dir), _zero_v(spark, sf_dir), GAMMA, LR_BASE, LR_PERIOD, LR_POWER, by_segment=True
    )


ORACLES["d4_monte_carlo_by_segment"] = statement(
    f"SELECT segment, state, {r('sum(lr * target * later)', 'v')} FROM ("
    "SELECT segment, state, lr, target, coalesce(product(1 - lr) OVER (PARTITION BY segment, state ORDER BY episode DESC "
    "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 1) AS later FROM (SELECT *, "
    "0.1 / pow(greatest(1.0, (episode - 1) / 100.0), 0.51) AS lr FROM targets)) GROUP BY segment, state",
    "transitions", extra=[("returns", RETURNS), ("targets", VISIT_TARGETS)],
)


def _weighted(spark, sf_dir):
    return R.weighted_returns(C.transitions(spark, sf_dir), C.target_policy(spark, sf_dir), C.behaviour(spark, sf_dir), GAMMA)


@query("d5_importance_ratio")
def d5(spark, sf_dir):
    return _weighted(spark, sf_dir).select("segment", "episode", "step_count", F.log("ratio").alias("log_ratio"))


ORACLES["d5_importance_ratio"] = statement(
    f"SELECT segment, episode, step_count, {r('ln(ratio)', 'log_ratio')} FROM weighted",
    "transitions", "target", "behaviour", extra=[("weighted", WEIGHTED)],
)


@query("d6_weighted_targets")
def d6(spark, sf_dir):
    return R.weighted_visit_targets(_weighted(spark, sf_dir))


ORACLES["d6_weighted_targets"] = statement(
    f"SELECT segment, episode, state, {r('target', 'target')} FROM targets", "transitions", "target", "behaviour",
    extra=[("weighted", WEIGHTED), ("targets", WEIGHTED_TARGETS)],
)


@query("d7_off_policy_monte_carlo")
def d7(spark, sf_dir):
    return R.off_policy_monte_carlo_evaluation(
        C.transitions(spark, sf_dir), _zero_v(spark, sf_dir), C.target_policy(spark, sf_dir), C.behaviour(spark, sf_dir),
        GAMMA, LR_BASE, LR_PERIOD, LR_POWER,
    )


ORACLES["d7_off_policy_monte_carlo"] = statement(
    f"SELECT state, {r('v', 'v')} FROM blended", "transitions", "target", "behaviour", "v0",
    extra=[("weighted", WEIGHTED), ("targets", WEIGHTED_TARGETS), ("numbers", NUMBERS), ("blended", BLENDED.format(targets="targets"))],
)
