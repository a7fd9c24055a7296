"""Rollouts from the empirical model (g*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from backsight.functions.draws import uniform as draw
from backsight.operators import rollouts as G

from . import common as C
from .common import GAMMA, ORACLES, query
from .sqltext import r, statement, uniform_draw
from .tables_and_policies import INTERVALS, Q_BLOCKS, two_sweeps

SEED = 42
ROLLOUTS = 4

OUTCOMES = """
SELECT *, coalesce(lag(top) OVER w, 0) AS lo, CASE WHEN lead(1) OVER w IS NULL THEN 2 ELSE top END AS hi FROM (
  SELECT *, sum(probability) OVER (PARTITION BY state, action ORDER BY next_state NULLS FIRST, reward, done) AS top FROM model)
WINDOW w AS (PARTITION BY state, action ORDER BY next_state NULLS FIRST, reward, done)"""


@query("g1_sample_outcome")
def g1(spark, sf_dir):
    rows = C.transitions(spark, sf_dir).select("event_id", "state", "action")
    sampled = G.sample_outcome(rows, G.outcome_intervals(C.model(spark, sf_dir)), draw(SEED, "event_id"))
    return sampled.select(
        "event_id", "state", "action", F.col("_next").alias("next_state"), F.col("_reward").alias("reward"), F.col("_done").alias("done")
    )


ORACLES["g1_sample_outcome"] = statement(
    f"SELECT t.event_id, t.state, t.action, o.next_state, {r('o.reward', 'reward')}, o.done FROM "
    f"(SELECT *, {uniform_draw(SEED, 'event_id')} AS u FROM transitions) t "
    "JOIN outcomes o ON t.state = o.state AND t.action = o.action AND t.u >= o.lo AND t.u < o.hi",
    "model", extra=[("outcomes", OUTCOMES)],
)


def _starts(spark, sf_dir):
    return C.model(spark, sf_dir).select(F.col("state").alias("start"), F.col("action").alias("first")).distinct()


@query("g2_simulate_policy")
def g2(spark, sf_dir):
    rows = G.rollout_rows(_starts(spark, sf_dir), ROLLOUTS)
    return G.simulate(rows, C.model(spark, sf_dir), C.target_policy(spark, sf_dir), GAMMA, 2, SEED, two_sweeps(spark, sf_dir))


def _step(i: int, gamma: float = GAMMA) -> list[tuple[str, str]]:
    """Rollout step i: outcome, then the next action where the rollout goes on."""
    outcome = uniform_draw(SEED, "'outcome'", "start", "first", "rollout", str(i))
    chosen = uniform_draw(SEED, "'action'", "start", "first", "rollout", str(i))
    return [
        (
            f"moved{i}",
            f"SELECT s.start, s.first, s.rollout, s.total + CASE WHEN s.open THEN s.factor * o.reward ELSE 0 END AS total, "
            f"CASE WHEN s.open AND NOT o.done THEN o.next_state ELSE s.state END AS state, s.action, "
            f"CASE WHEN s.open AND NOT o.done THEN s.factor * {gamma} ELSE s.factor END AS factor, "
            f"CASE WHEN s.open THEN NOT o.done ELSE false END AS open, {chosen} AS pick "
            f"FROM (SELECT *, {outcome} AS u FROM step{i}) s LEFT JOIN outcomes o "
            "ON s.open AND s.state = o.state AND s.action = o.action AND s.u >= o.lo AND s.u < o.hi",
        ),
        (
            f"step{i + 1}",
            f"SELECT m.start, m.first, m.rollout, m.total, m.state, coalesce(i.action, m.action) AS action, m.factor, m.open "
            f"FROM moved{i} m LEFT JOIN intervals i ON m.open AND m.state = i.state AND m.pick >= i.lo AND m.pick < i.hi",
        ),
    ]


ORACLES["g2_simulate_policy"] = statement(
    f"SELECT s.start, s.first, s.rollout, {r('s.total + CASE WHEN s.open THEN s.factor * q.q ELSE 0 END', 'total')} "
    "FROM step2 s LEFT JOIN q ON s.state = q.state AND s.action = q.action",
    "model", "v0", "target",
    extra=Q_BLOCKS
    + [
        ("outcomes", OUTCOMES),
        ("intervals", INTERVALS.format(policy="target")),
        ("step0", "SELECT state AS start, action AS first, i AS rollout, 0.0::DOUBLE AS total, state, action, 1.0::DOUBLE AS factor, "
                  f"true AS open FROM (SELECT DISTINCT state, action FROM model), range({ROLLOUTS}) t(i)"),
    ]
    + _step(0) + _step(1),
)


@query("g3_best_by_rollout")
def g3(spark, sf_dir):
    means, best = G.best_by_rollout(
        _starts(spark, sf_dir), C.model(spark, sf_dir), C.target_policy(spark, sf_dir), GAMMA, 4, 100, SEED,
        two_sweeps(spark, sf_dir),
    )
    return means.join(best.withColumnRenamed("first", "best"), "start")


ORACLES["g3_best_by_rollout"] = statement(
    f"SELECT start, first, {r('value', 'value')}, first_value(first) OVER (PARTITION BY start ORDER BY value DESC, first) AS best FROM "
    "(SELECT s.start, s.first, avg(s.total + CASE WHEN s.open THEN s.factor * q.q ELSE 0 END) AS value "
    "FROM step4 s LEFT JOIN q ON s.state = q.state AND s.action = q.action GROUP BY s.start, s.first)",
    "model", "v0", "target",
    extra=Q_BLOCKS
    + [
        ("outcomes", OUTCOMES),
        ("intervals", INTERVALS.format(policy="target")),
        ("step0", "SELECT state AS start, action AS first, i AS rollout, 0.0::DOUBLE AS total, state, action, 1.0::DOUBLE AS factor, "
                  "true AS open FROM (SELECT DISTINCT state, action FROM model), range(100) t(i)"),
    ]
    + [block for i in range(4) for block in _step(i)],
)


@query("g4_tree_search")
def g4(spark, sf_dir):
    table, _ = G.tree_search(
        C.model(spark, sf_dir), two_sweeps(spark, sf_dir), C.states(spark, sf_dir), GAMMA, rounds=3, count=50, depth=4, lr=0.01, seed=SEED
    )
    return table


@query("g5_score_policy")
def g5(spark, sf_dir):
    return G.score_policy(C.states(spark, sf_dir), C.model(spark, sf_dir), C.target_policy(spark, sf_dir), 5, 100, SEED)


ORACLES["g5_score_policy"] = statement(
    f"SELECT start, {r('avg(total)', 'mean_reward')}, {r('stddev_samp(total)', 'spread')}, count(*)::BIGINT AS rollouts FROM step5 GROUP BY start",
    "model", "target",
    extra=[
        ("outcomes", OUTCOMES),
        ("intervals", INTERVALS.format(policy="target")),
        ("opened", f"SELECT state AS start, i AS rollout, {uniform_draw(SEED, chr(39) + 'opening' + chr(39), 'state', 'i')} AS u FROM states, range(100) t(i)"),
        ("step0", "SELECT o.start, i.action AS first, o.rollout, 0.0::DOUBLE AS total, o.start AS state, i.action, 1.0::DOUBLE AS factor, "
                  "true AS open FROM opened o JOIN intervals i ON o.start = i.state AND o.u >= i.lo AND o.u < i.hi"),
    ]
    + [block for i in range(5) for block in _step(i, 1.0)],
)
