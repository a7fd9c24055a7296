"""Small tables with published or independently computed answers."""

from __future__ import annotations

import datetime as dt
import random

from backsight.sources.schemas import MODEL, POLICY, TRANSITIONS

START = dt.datetime(2024, 1, 1)


def plain_grid(spark):
    """4x4 grid, corners 0 and 15 terminal, reward -1 per move, walls keep the place."""
    rows = []
    for s in range(1, 15):
        x, y = s % 4, s // 4
        for a, (dx, dy) in enumerate([(-1, 0), (0, 1), (1, 0), (0, -1)]):
            nx, ny = min(max(x + dx, 0), 3), min(max(y + dy, 0), 3)
            n = 4 * ny + nx
            rows.append((s, a, 1.0, None if n in (0, 15) else n, -1.0, n in (0, 15)))
    return spark.createDataFrame(rows, MODEL)


PLAIN_GRID_UNIFORM_V = {
    1: -14, 2: -20, 3: -22, 4: -14, 5: -18, 6: -20, 7: -20, 8: -20, 9: -20, 10: -18, 11: -14, 12: -22, 13: -20, 14: -14,
}


def slip_grid_rows():
    """S... / ..X. / .... / X..G; a move goes as intended or to either side, a third each; 1 for entering G."""
    ends, goal = {6, 12, 15}, 15
    moves = [(-1, 0), (0, 1), (1, 0), (0, -1)]
    rows = []
    for s in range(16):
        x, y = s % 4, s // 4
        for a in range(4):
            if s in ends:
                rows.append((s, a, 1.0, s, 0.0, True))
                continue
            for b in ((a - 1) % 4, a, (a + 1) % 4):
                dx, dy = moves[b]
                n = 4 * min(max(y + dy, 0), 3) + min(max(x + dx, 0), 3)
                rows.append((s, a, 1 / 3, n, 1.0 if n == goal else 0.0, n in ends))
    return rows


def slip_grid(spark):
    return spark.createDataFrame(slip_grid_rows(), MODEL)


SLIP_GRID_OPTIMAL_V = [
    0.378165, 0.404827, 0.437204, 0.538614, 0.411213, 0.436369, 0, 0.623658, 0.450986, 0.561968, 0.689167, 0.807175,
    0, 0.634481, 0.807175, 0,
]
SLIP_GRID_UNIFORM_V = [
    0.039044, 0.041574, 0.043583, 0.09835, 0.044735, 0.050846, 0, 0.173822, 0.053734, 0.127778, 0.249461, 0.459711,
    0, 0.183973, 0.462873, 0,
]
SLIP_GRID_GREEDY = {
    0: {1, 2}, 1: {2}, 2: {3}, 3: {2}, 4: {1}, 5: {0}, 7: {2}, 8: {3}, 9: {1}, 10: {1}, 11: {1}, 13: {2}, 14: {2},
}


def uniform(spark, model):
    pairs = sorted({(r["state"], r["action"]) for r in model.collect()})
    count = {s: sum(1 for p in pairs if p[0] == s) for s, _ in pairs}
    return spark.createDataFrame([(s, a, 1.0 / count[s]) for s, a in pairs], POLICY)


def transitions(spark, episodes, segment=0):
    """Episodes as lists of (state, action, reward), one hour per step, in order."""
    return spark.createDataFrame(transition_rows(episodes, segment), TRANSITIONS)


def transition_rows(episodes, segment=0, first_event=0):
    rows, event = [], first_event
    for number, episode in enumerate(episodes, start=1):
        for t, (state, action, reward) in enumerate(episode):
            last = t + 1 == len(episode)
            rows.append(
                (segment, number, t, state, action, float(reward), None if last else episode[t + 1][0], last,
                 START + dt.timedelta(hours=event), event)
            )
            event += 1
    return rows


def random_episodes(seed, count, states=5, actions=3, longest=12):
    rng = random.Random(seed)
    return [
        [(rng.randrange(states), rng.randrange(actions), round(rng.uniform(-1, 1), 3)) for _ in range(rng.randint(1, longest))]
        for _ in range(count)
    ]


def policy_rows(seed, states=5, actions=3):
    rng = random.Random(seed)
    rows = []
    for s in range(states):
        weights = [rng.random() + 0.1 for _ in range(actions)]
        rows += [(s, a, w / sum(weights)) for a, w in enumerate(weights)]
    return rows


def as_dict(df, *keys):
    value = [c for c in df.columns if c not in keys][0] if len(df.columns) == len(keys) + 1 else None
    rows = df.collect()
    if len(keys) == 1:
        return {r[keys[0]]: r[value] for r in rows}
    return {tuple(r[k] for k in keys): r[value] for r in rows}
