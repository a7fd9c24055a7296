"""Linear values and policy gradients on vector rows (h*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from backsight.functions import features as X
from backsight.operators import linear as L
from backsight.plans import linear_learning as P

from . import common as C
from .common import GAMMA, ORACLES, query
from .sqltext import r, statement

WIDTH, ACTIONS = 63, [0, 1]  # the given vectors: 63 numbers of state and the reward
PAIR, STATE = X.pair_size(WIDTH, ACTIONS), X.state_size(WIDTH)
THETA = [((7 * k) % 11 - 5) / 1000 for k in range(PAIR)]
OMEGA = [((5 * k) % 7 - 3) / 1000 for k in range(STATE)]
TRACE, LR = 0.75, 1e-4


def rows(spark, sf_dir):
    return C.linear_steps(spark, sf_dir)


prepared = C.written_once("linear-steps", lambda spark, sf_dir: L.with_next_step(rows(spark, sf_dir)))


def exploded(df, column):
    return df.select("episode", "step_count", F.posexplode(column).alias("position", "value"))


def by_position(df, column):
    """Sums over all rows, plain and weighted by the step, for each of the thousands of positions."""
    each = exploded(df, column).groupBy("position")
    return each.agg(F.sum("value").alias("value"), F.sum(F.col("value") * (F.col("step_count") + F.col("episode") % 7)).alias("weighted"))


BY_POSITION = f"SELECT position, {r('sum({0})', 'value')}, {r('sum({0} * (step_count + episode % 7))', 'weighted')} FROM {{1}} GROUP BY position"


def weights_out(spark, weights, name="weight_x10000"):
    """Changes are of the order 1e-4, so weights are reported in units of 1e-4."""
    return P.weight_table(spark, [w * 10_000 for w in weights]).withColumnRenamed("weight", name)


BLOCKS = [
    ("steps", "SELECT vec_id // 10 AS episode, vec_id % 10 AS step_count, (label % 2)::BIGINT AS action, embedding[-1]::DOUBLE AS reward, "
              "list_concat([1.0::DOUBLE], list_transform(embedding[1:len(embedding) - 1], lambda x: x::DOUBLE)) AS b FROM embeddings"),
    ("psi", "SELECT episode, step_count, i * 64 + j AS position, b[i + 1] * b[j + 1] AS value FROM steps, range(64) x(i), range(64) y(j)"),
    ("phi", "SELECT episode, step_count, a AS candidate, position * 2 + k AS position, "
            "value * CASE WHEN k = 0 OR a = 0 THEN 1 ELSE 0 END AS value FROM psi, range(2) u(a), range(2) z(k)"),
    ("theta", "SELECT k AS position, ((7 * k) % 11 - 5) / 1000::DOUBLE AS weight FROM range(8192) t(k)"),
    ("omega", "SELECT k AS position, ((5 * k) % 7 - 3) / 1000::DOUBLE AS weight FROM range(4096) t(k)"),
    ("zero", "SELECT k AS position, 0.0::DOUBLE AS weight FROM range(8192) t(k)"),
    ("own", "SELECT p.* FROM phi p JOIN steps s ON p.episode = s.episode AND p.step_count = s.step_count AND p.candidate = s.action"),
]


def blocks(*names: str) -> list[tuple[str, str]]:
    return [block for block in BLOCKS if block[0] in names]


ALL = [name for name, _ in BLOCKS]


@query("h1_state_features")
def h1(spark, sf_dir):
    return by_position(rows(spark, sf_dir), X.state_features(F.col("features")))


ORACLES["h1_state_features"] = statement(
    BY_POSITION.format("value", "psi"), extra=blocks("steps", "psi")
)


@query("h2_pair_features")
def h2(spark, sf_dir):
    return by_position(rows(spark, sf_dir), X.pair_features(F.col("features"), F.col("action"), ACTIONS))


ORACLES["h2_pair_features"] = statement(
    BY_POSITION.format("value", "own"), extra=blocks("steps", "psi", "phi", "own")
)


@query("h3_linear_scores")
def h3(spark, sf_dir):
    return L.score_rows(rows(spark, sf_dir), ACTIONS, THETA, 0.1)


SCORES = "SELECT episode, step_count, candidate, sum(value * weight) AS score FROM phi JOIN theta USING (position) GROUP BY ALL"
ORACLES["h3_linear_scores"] = statement(
    f"SELECT episode, step_count, candidate, {r('score', 'score')}, "
    f"{r('0.9 * g / sum(g) OVER (PARTITION BY episode, step_count) + 0.05', 'policy')} FROM "
    "(SELECT *, (score >= max(score) OVER (PARTITION BY episode, step_count) - 1e-9)::INT::DOUBLE AS g FROM scores)",
    extra=blocks("steps", "psi", "phi", "theta") + [("scores", SCORES)],
)


def _sarsa(spark, sf_dir, trace):
    data = prepared(spark, sf_dir)
    weights, _ = P.train(
        lambda w, lr: L.sarsa_sweep(data, ACTIONS, w, GAMMA, lr, trace), [0.0] * PAIR, [LR, LR]
    )
    return weights_out(spark, weights)


@query("h4_linear_sarsa")
def h4(spark, sf_dir):
    return _sarsa(spark, sf_dir, 0.0)


@query("h5_linear_sarsa_lambda")
def h5(spark, sf_dir):
    return _sarsa(spark, sf_dir, TRACE)


def _sarsa_blocks(trace: float) -> list[tuple[str, str]]:
    out, previous = [], "zero"
    for i in (1, 2):
        out.append((f"val{i}", f"SELECT episode, step_count, sum(value * weight) AS v FROM own JOIN {previous} USING (position) GROUP BY ALL"))
        out.append(
            (f"err{i}", f"SELECT episode, step_count, reward + {GAMMA} * coalesce(lead(v) OVER w, 0) - v AS e "
                        f"FROM steps JOIN val{i} USING (episode, step_count) WINDOW w AS (PARTITION BY episode ORDER BY step_count)")
        )
        factor = "e" if trace == 0 else (
            f"sum(e * pow({GAMMA} * {trace}, step_count)) OVER (PARTITION BY episode ORDER BY step_count DESC) / pow({GAMMA} * {trace}, step_count)"
        )
        out.append((f"fac{i}", f"SELECT episode, step_count, {factor} AS f FROM err{i}"))
        out.append(
            (f"w{i}", f"SELECT p.position, any_value(o.weight) + {LR} * avg(f.f * p.value) AS weight FROM own p "
                      f"JOIN fac{i} f USING (episode, step_count) JOIN {previous} o USING (position) GROUP BY p.position")
        )
        previous = f"w{i}"
    return out


for _name, _trace in (("h4_linear_sarsa", 0.0), ("h5_linear_sarsa_lambda", TRACE)):
    ORACLES[_name] = statement(
        f"SELECT position, {r('weight * 10000', 'weight_x10000')} FROM w2",
        extra=blocks("steps", "psi", "phi", "zero", "own") + _sarsa_blocks(_trace),
    )


@query("h6_linear_policy_iteration")
def h6(spark, sf_dir):
    evaluate = P.evaluate_linear_sarsa(prepared(spark, sf_dir), ACTIONS, GAMMA, [LR, LR])
    weights, _ = P.linear_policy_iteration(evaluate, [0.0] * PAIR, [0.5, 0.25, 0.0])
    return weights_out(spark, weights)


@query("b13_weight_change_norms")
def b13(spark, sf_dir):
    data = prepared(spark, sf_dir)
    _, changes = P.train(lambda w, lr: L.sarsa_sweep(data, ACTIONS, w, GAMMA, lr), [0.0] * PAIR, [LR, LR])
    return P.history_table(spark, changes)


ORACLES["b13_weight_change_norms"] = statement(
    f"SELECT 1::BIGINT AS iteration, {r('sqrt(sum((n.weight - o.weight) ** 2))', 'change')} FROM w1 n JOIN zero o USING (position) "
    f"UNION ALL SELECT 2, {r('sqrt(sum((n.weight - o.weight) ** 2))', 'change')} FROM w2 n JOIN w1 o USING (position)",
    extra=blocks("steps", "psi", "phi", "zero", "own") + _sarsa_blocks(0.0),
)


@query("h7_softmax_policy")
def h7_policy(spark, sf_dir):
    graded = L.policy_gradient_rows(rows(spark, sf_dir), ACTIONS, THETA)
    return exploded(graded, "chances").withColumnRenamed("position", "candidate")


@query("h7_log_policy_gradient")
def h7(spark, sf_dir):
    return by_position(L.policy_gradient_rows(rows(spark, sf_dir), ACTIONS, THETA), "gradient")


GRADED = [
    ("scores", SCORES),
    ("raised", "SELECT *, exp(score - max(score) OVER (PARTITION BY episode, step_count)) AS e FROM scores"),
    ("chances", "SELECT episode, step_count, candidate, e / sum(e) OVER (PARTITION BY episode, step_count) AS chance FROM raised"),
    ("expected", "SELECT episode, step_count, position, sum(chance * value) AS x FROM phi JOIN chances USING (episode, step_count, candidate) GROUP BY ALL"),
    ("gradient", "SELECT o.episode, o.step_count, o.position, o.value - x.x AS g FROM own o JOIN expected x USING (episode, step_count, position)"),
]
BASE = blocks(*ALL) + GRADED

ORACLES["h7_softmax_policy"] = statement(
    f"SELECT episode, step_count, candidate, {r('chance', 'value')} FROM chances", extra=BASE
)
ORACLES["h7_log_policy_gradient"] = statement(
    BY_POSITION.format("g", "gradient"), extra=BASE
)


@query("h8_reinforce")
def h8(spark, sf_dir):
    return weights_out(spark, L.reinforce_sweep(rows(spark, sf_dir), ACTIONS, THETA, GAMMA, LR))


@query("h8_reinforce_from_step")
def h8_from(spark, sf_dir):
    return weights_out(spark, L.reinforce_sweep(rows(spark, sf_dir), ACTIONS, THETA, GAMMA, LR, from_step=True))


TOTALS = ("totals", "SELECT episode, sum(reward) AS total FROM steps GROUP BY episode")
AHEAD = (
    "ahead",
    f"SELECT episode, step_count, sum(reward * pow({GAMMA}, step_count)) OVER (PARTITION BY episode ORDER BY step_count DESC) "
    f"/ pow({GAMMA}, step_count) AS total FROM steps",
)


def _actor(factor: str, source: str) -> str:
    return (
        f"SELECT g.position, any_value(t.weight) + {LR} * avg({factor} * g.g) AS weight FROM gradient g "
        f"JOIN {source} JOIN theta t ON t.position = g.position GROUP BY g.position"
    )


def _critic(factor: str, source: str) -> str:
    return (
        f"SELECT p.position, any_value(t.weight) + {LR} * avg({factor} * p.value) AS weight FROM psi p "
        f"JOIN {source} JOIN omega t ON t.position = p.position GROUP BY p.position"
    )


def _weights(name: str = "w") -> str:
    return f"SELECT position, {r('weight * 10000', 'weight_x10000')} FROM {name}"


DISCOUNT = f"pow({GAMMA}, g.step_count)"
ORACLES["h8_reinforce"] = statement(
    _weights(), extra=BASE + [TOTALS, ("w", _actor(f"{DISCOUNT} * f.total", "totals f ON f.episode = g.episode"))]
)
ORACLES["h8_reinforce_from_step"] = statement(
    _weights(),
    extra=BASE + [AHEAD, ("w", _actor(f"{DISCOUNT} * f.total", "ahead f ON f.episode = g.episode AND f.step_count = g.step_count"))],
)


def _both(spark, actor, critic):
    """Both weight vectors as one table."""
    a = weights_out(spark, actor).withColumn("part", F.lit("actor"))
    return a.unionByName(weights_out(spark, critic).withColumn("part", F.lit("critic")))


def _both_sql(factor: str, critic_factor: str, extra: list[tuple[str, str]]) -> str:
    on_g = "err f ON f.episode = g.episode AND f.step_count = g.step_count"
    on_p = "err f ON f.episode = p.episode AND f.step_count = p.step_count"
    return statement(
        f"SELECT position, {r('weight * 10000', 'weight_x10000')}, 'actor' AS part FROM wa "
        f"UNION ALL SELECT position, {r('weight * 10000', 'weight_x10000')}, 'critic' FROM wc",
        extra=BASE + extra + [("wa", _actor(factor, on_g)), ("wc", _critic(critic_factor, on_p))],
    )


VALUES = ("vals", "SELECT episode, step_count, sum(value * weight) AS v FROM psi JOIN omega USING (position) GROUP BY ALL")
ONE_STEP = f"reward + {GAMMA} * coalesce(lead(v) OVER (PARTITION BY episode ORDER BY step_count), 0) - v"


@query("h9_reinforce_with_baseline")
def h9(spark, sf_dir):
    return _both(spark, *L.baseline_sweep(rows(spark, sf_dir), ACTIONS, THETA, OMEGA, GAMMA, LR))


ORACLES["h9_reinforce_with_baseline"] = _both_sql(
    f"{DISCOUNT} * f.e", "f.e",
    [TOTALS, VALUES, ("err", "SELECT episode, step_count, total - v AS e FROM vals JOIN totals USING (episode)")],
)


@query("h10_actor_critic")
def h10(spark, sf_dir):
    return _both(spark, *L.actor_critic_sweep(prepared(spark, sf_dir), ACTIONS, THETA, OMEGA, GAMMA, LR))


ORACLES["h10_actor_critic"] = _both_sql(
    f"{DISCOUNT} * f.e", "f.e",
    [VALUES, ("err", f"SELECT episode, step_count, {ONE_STEP} AS e FROM steps JOIN vals USING (episode, step_count)")],
)


@query("h11_actor_critic_lambda")
def h11(spark, sf_dir):
    return _both(spark, *L.actor_critic_sweep(prepared(spark, sf_dir), ACTIONS, THETA, OMEGA, GAMMA, LR, TRACE))


def _ahead(column: str) -> str:
    fade = f"pow({GAMMA} * {TRACE}, step_count)"
    return f"sum({column} * {fade}) OVER (PARTITION BY episode ORDER BY step_count DESC) / {fade}"


ORACLES["h11_actor_critic_lambda"] = _both_sql(
    "f.a", "f.c",
    [
        VALUES,
        ("one", f"SELECT episode, step_count, {ONE_STEP} AS e FROM steps JOIN vals USING (episode, step_count)"),
        ("err", f"SELECT episode, step_count, {_ahead('e')} AS c, {_ahead(f'e * pow({GAMMA}, step_count)')} AS a FROM one"),
    ],
)
