"""Table builders (a*) and policy operators (b*)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from backsight.functions import schedules
from backsight.functions.draws import uniform as draw
from backsight.operators import bellman as B
from backsight.operators import models as M
from backsight.operators import policies as P
from backsight.plans import planning
from backsight.sources import models as source_models
from backsight.storage import new_path, settle

from . import common as C
from .common import EVENT_ACTIONS, GAMMA, ORACLES, query
from .sqltext import r, statement, uniform_draw, v_sweeps

SEED = 42

OPTIMAL_V = """
SELECT state, max(q) AS v FROM (
  SELECT m.state, m.action, sum(m.probability * (m.reward + {g} * CASE WHEN m.done THEN 0 ELSE coalesce(p.v, 0) END)) AS q
  FROM model m LEFT JOIN {prev} p ON m.next_state = p.state GROUP BY ALL) GROUP BY state"""

Q_FROM = """
SELECT m.state, m.action, sum(m.probability * (m.reward + {g} * CASE WHEN m.done THEN 0 ELSE coalesce(p.v, 0) END)) AS q
FROM model m LEFT JOIN {prev} p ON m.next_state = p.state GROUP BY ALL"""

GREEDY = """
SELECT state, action, g / sum(g) OVER (PARTITION BY state) AS policy FROM (
  SELECT state, action, (q >= max(q) OVER (PARTITION BY state) - 1e-9)::INT::DOUBLE AS g FROM {q})"""


def two_sweeps_q(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Action values after two optimality sweeps: the input of the policy operators."""
    model = C.model(spark, sf_dir)
    return B.q_from_v(model, planning.value_iteration_sweeps(model, GAMMA, 2), GAMMA)


two_sweeps = C.written_once("q-two-sweeps", two_sweeps_q)
Q_BLOCKS = v_sweeps(OPTIMAL_V, 2) + [("q", Q_FROM.format(prev="v2", g=GAMMA))]


# --- tables ---------------------------------------------------------------------------------------------------

@query("a1_model_check")
def a1(spark, sf_dir):
    model = C.model(spark, sf_dir)
    totals = model.groupBy("state", "action").agg(F.sum("probability").alias("total"), F.count("*").alias("outcomes"))
    broken = source_models.model_violations(model).select("state", "action", F.lit(True).alias("broken"))
    return totals.join(broken, ["state", "action"], "left").select(
        "state", "action", "total", "outcomes", F.coalesce("broken", F.lit(False)).alias("broken")
    )


ORACLES["a1_model_check"] = statement(
    f"SELECT state, action, {r('sum(probability)', 'total')}, count(*)::BIGINT AS outcomes, "
    "abs(sum(probability) - 1) > 1e-9 AS broken FROM model GROUP BY state, action",
    "model",
)


@query("a1_model_flatten")
def a1_flatten(spark, sf_dir):
    nested = C.model(spark, sf_dir).groupBy("state", "action").agg(
        F.collect_list(F.struct("probability", "next_state", "reward", "done")).alias("outcomes")
    )
    return source_models.flatten_model(nested)


ORACLES["a1_model_flatten"] = statement(
    f"SELECT state, action, {r('probability', 'probability')}, next_state, {r('reward', 'reward')}, done FROM model", "model"
)


@query("a2_transitions")
def a2(spark, sf_dir):
    return C.transitions(spark, sf_dir).drop("ts", "event_id")


ORACLES["a2_transitions"] = statement(
    f"SELECT segment, episode, step_count, state, action, {r('reward', 'reward')}, next_state, done FROM transitions",
    "transitions",
)


@query("a3_empirical_model")
def a3(spark, sf_dir):
    return M.empirical_model(C.transitions(spark, sf_dir))


ORACLES["a3_empirical_model"] = statement(
    f"SELECT state, action, next_state, {r('reward', 'reward')}, experience_count, {r('probability', 'probability')}, done FROM model",
    "model",
)


@query("a4_model_upsert")
def a4(spark, sf_dir):
    steps = C.transitions(spark, sf_dir)
    first = M.empirical_model(steps.filter(F.col("ts") < F.lit("2024-01-16").cast("timestamp_ntz")))
    return M.upsert_model(first, steps.filter(F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")))


ORACLES["a4_model_upsert"] = ORACLES["a3_empirical_model"]


@query("a5_init_v")
def a5_v(spark, sf_dir):
    return M.init_v(C.states(spark, sf_dir))


@query("a5_init_q")
def a5_q(spark, sf_dir):
    return M.init_q(C.states(spark, sf_dir), C.actions(spark, sf_dir))


@query("a5_uniform_policy")
def a5_uniform(spark, sf_dir):
    return M.uniform_policy(C.states(spark, sf_dir), C.actions(spark, sf_dir))


@query("a5_target_policy")
def a5_target(spark, sf_dir):
    return M.preferring_policy(C.states(spark, sf_dir), C.actions(spark, sf_dir))


ORACLES["a5_init_v"] = statement(f"SELECT state, {r('v', 'v')} FROM v0", "v0")
ORACLES["a5_init_q"] = statement(f"SELECT state, action, {r('0', 'q')} FROM pairs", "pairs")
ORACLES["a5_uniform_policy"] = statement(f"SELECT state, action, {r('policy', 'policy')} FROM uniform", "uniform")
ORACLES["a5_target_policy"] = statement(f"SELECT state, action, {r('policy', 'policy')} FROM target", "target")


@query("a6_space_sizes")
def a6(spark, sf_dir):
    return M.space_sizes(C.transitions(spark, sf_dir))


ORACLES["a6_space_sizes"] = statement(
    "SELECT count(DISTINCT state)::BIGINT AS n_states, count(DISTINCT action)::BIGINT AS n_actions, "
    "count(DISTINCT (state, action))::BIGINT AS n_pairs FROM transitions",
    "transitions",
)


@query("a7_q_matrix")
def a7(spark, sf_dir):
    return M.matrix_view(two_sweeps(spark, sf_dir), "q", EVENT_ACTIONS).orderBy("state")


ORACLES["a7_q_matrix"] = statement(
    "SELECT state, " + ", ".join(r(f"coalesce(max(q) FILTER (action = {a}), 0)", f"a{a}") for a in EVENT_ACTIONS)
    + " FROM q GROUP BY state ORDER BY state",
    "model", "v0", extra=Q_BLOCKS,
)


@query("a8_policy_value")
def a8(spark, sf_dir):
    return M.policy_value(two_sweeps(spark, sf_dir), C.target_policy(spark, sf_dir))


ORACLES["a8_policy_value"] = statement(
    f"SELECT state, {r('sum(policy * q)', 'v')} FROM q JOIN target USING (state, action) GROUP BY state",
    "model", "v0", "target", extra=Q_BLOCKS,
)


@query("a9_result_sink")
def a9(spark, sf_dir):
    v = planning.value_iteration_sweeps(C.model(spark, sf_dir), GAMMA, 2)
    return spark.read.parquet(source_models.write_result(v, new_path(spark, "results"), "first", ["state"]))


ORACLES["a9_result_sink"] = statement(f"SELECT state, {r('v', 'v')} FROM v2", "model", "v0", extra=v_sweeps(OPTIMAL_V, 2))


# --- policies -------------------------------------------------------------------------------------------------

@query("b1_policy_improvement")
def b1(spark, sf_dir):
    return P.greedy_policy(two_sweeps(spark, sf_dir))


ORACLES["b1_policy_improvement"] = statement(
    f"SELECT state, action, {r('policy', 'policy')} FROM greedy", "model", "v0",
    extra=Q_BLOCKS + [("greedy", GREEDY.format(q="q"))],
)


@query("b2_eps_greedy_policy")
def b2(spark, sf_dir):
    return P.eps_greedy_policy(two_sweeps(spark, sf_dir), 0.1)


ORACLES["b2_eps_greedy_policy"] = statement(
    f"SELECT state, action, {r('0.9 * policy + 0.1 / count(*) OVER (PARTITION BY state)', 'policy')} FROM greedy",
    "model", "v0", extra=Q_BLOCKS + [("greedy", GREEDY.format(q="q"))],
)


@query("b3_eps_greedy_all_actions")
def b3(spark, sf_dir):
    return P.eps_greedy_over_all_actions(two_sweeps(spark, sf_dir), 0.1)


ORACLES["b3_eps_greedy_all_actions"] = statement(
    f"SELECT state, action, {r('0.9 * policy + 0.1 / (SELECT count(DISTINCT action) FROM q)', 'policy')} FROM greedy",
    "model", "v0", extra=Q_BLOCKS + [("greedy", GREEDY.format(q="q"))],
)


@query("b4_softmax_policy")
def b4(spark, sf_dir):
    return P.softmax_policy(two_sweeps(spark, sf_dir), "q", ["state"], "action")


ORACLES["b4_softmax_policy"] = statement(
    f"SELECT state, action, {r('e / sum(e) OVER (PARTITION BY state)', 'policy')} FROM "
    "(SELECT state, action, exp(q - max(q) OVER (PARTITION BY state)) AS e FROM q)",
    "model", "v0", extra=Q_BLOCKS,
)


@query("b5_sample_action")
def b5(spark, sf_dir):
    rows = C.transitions(spark, sf_dir).select("event_id", "state")
    return P.sample_action(rows, C.target_policy(spark, sf_dir), draw(SEED, "event_id")).select("event_id", "state", "action")


INTERVALS = """
SELECT *, coalesce(lag(top) OVER w, 0) AS lo, CASE WHEN lead(1) OVER w IS NULL THEN 2 ELSE top END AS hi FROM (
  SELECT *, sum(policy) OVER (PARTITION BY state ORDER BY action) AS top FROM {policy} WHERE policy > 0)
WINDOW w AS (PARTITION BY state ORDER BY action)"""

ORACLES["b5_sample_action"] = statement(
    f"SELECT t.event_id, t.state, i.action FROM (SELECT *, {uniform_draw(SEED, 'event_id')} AS u FROM transitions) t "
    "JOIN intervals i ON t.state = i.state AND t.u >= i.lo AND t.u < i.hi",
    "transitions", "target", extra=[("intervals", INTERVALS.format(policy="target"))],
)


@query("b6_greedy_draw")
def b6(spark, sf_dir):
    counts = C.transitions(spark, sf_dir).groupBy("state", "action").agg(
        F.floor(F.log2(F.count("*"))).cast("double").alias("q")  # coarse on purpose, so that ties occur
    )
    return P.greedy_draw(counts, "q", ["state"], "action", SEED)


ORACLES["b6_greedy_draw"] = statement(
    "SELECT state, action FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY q DESC, "
    f"{uniform_draw(SEED, 'state', 'action')}, action) AS k FROM "
    "(SELECT state, action, floor(log2(count(*))) AS q FROM transitions GROUP BY ALL)) WHERE k = 1",
    "transitions",
)


@query("b7_first_best")
def b7(spark, sf_dir):
    return P.first_best(two_sweeps(spark, sf_dir), "q", ["state"], "action")


ORACLES["b7_first_best"] = statement(
    "SELECT state, action FROM (SELECT *, row_number() OVER (PARTITION BY state ORDER BY q DESC, action) AS k FROM q) WHERE k = 1",
    "model", "v0", extra=Q_BLOCKS,
)


@query("b8_policy_changes")
def b8(spark, sf_dir):
    return P.policy_changes(C.uniform(spark, sf_dir), P.greedy_policy(two_sweeps(spark, sf_dir)))


ORACLES["b8_policy_changes"] = statement(
    f"SELECT state, action, {r('g.policy', 'policy')}, {r('u.policy', 'policy_old')} FROM greedy g JOIN uniform u "
    "USING (state, action) WHERE abs(g.policy - u.policy) > 1e-9",
    "model", "v0", "uniform", extra=Q_BLOCKS + [("greedy", GREEDY.format(q="q"))],
)


@query("b9_behaviour_policy")
def b9(spark, sf_dir):
    return M.behaviour_policy(C.transitions(spark, sf_dir))


ORACLES["b9_behaviour_policy"] = statement(f"SELECT state, action, {r('policy', 'policy')} FROM behaviour", "behaviour")


@query("b10_learning_rates")
def b10(spark, sf_dir):
    rate = schedules.learning_rate(F.col("event_id"), C.LR_BASE, C.LR_PERIOD, C.LR_POWER)
    return C.transitions(spark, sf_dir).select("event_id", rate.alias("lr"))


ORACLES["b10_learning_rates"] = f"SELECT event_id, {r('0.1 / pow(greatest(1.0, event_id / 100.0), 0.51)', 'lr')} FROM events"


@query("b11_exploration_schedule")
def b11(spark, sf_dir):
    count = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    return schedules.schedule_table(spark, count, eps=schedules.spaced(F.col("number"), 1.0, 0.25, count))


ORACLES["b11_exploration_schedule"] = (
    f"SELECT i AS number, {r('1.0 + (0.25 - 1.0) * i / (n - 1)', 'eps')} "
    "FROM (SELECT count(*) AS n FROM events) c, range(c.n) t(i)"
)


@query("b12_largest_change")
def b12(spark, sf_dir):
    model = C.model(spark, sf_dir)
    v = settle(planning.value_iteration_sweeps(model, GAMMA, 2), "v")
    return P.largest_change(v, B.optimal_backup(model, v, GAMMA), ["state"], "v")


ORACLES["b12_largest_change"] = statement(
    f"SELECT {r('max(abs(n.v - o.v))', 'max_delta')} FROM v3 n JOIN v2 o USING (state)",
    "model", "v0", extra=v_sweeps(OPTIMAL_V, 3),
)
