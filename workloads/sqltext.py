"""Building blocks of the check SQL."""

from __future__ import annotations

from .common import GAMMA, OFF_BORDER

CTES: dict[str, str] = {
    "log": """
SELECT user_id AS segment, ts, event_id,
       (CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3
             WHEN 'view' THEN 4 END * 4 + hour(ts) // 6)::BIGINT AS state,
       (CAST(json_extract(props, '$.k') AS BIGINT) // 25)::BIGINT AS action,
       value / 100 AS reward
FROM events""",
    "flagged": """
SELECT *, CASE WHEN lag(ts) OVER w IS NULL OR ts > lag(ts) OVER w + INTERVAL 24 HOUR THEN 1 ELSE 0 END AS fresh
FROM log WINDOW w AS (PARTITION BY segment ORDER BY ts, event_id)""",
    "sessions": """
SELECT *, (sum(fresh) OVER (PARTITION BY segment ORDER BY ts, event_id))::BIGINT AS episode FROM flagged""",
    "transitions": """
SELECT segment, episode, (row_number() OVER w - 1)::BIGINT AS step_count, state, action, reward,
       lead(state) OVER w AS next_state, lead(state) OVER w IS NULL AS done, ts, event_id
FROM sessions WINDOW w AS (PARTITION BY segment, episode ORDER BY ts, event_id)""",
    "counts": """
SELECT state, action, next_state, count(*)::BIGINT AS experience_count, avg(reward) AS reward
FROM transitions GROUP BY ALL""",
    "model": """
SELECT state, action, next_state, reward, experience_count,
       experience_count / sum(experience_count) OVER (PARTITION BY state, action) AS probability,
       next_state IS NULL AS done
FROM counts""",
    "states": "SELECT DISTINCT state FROM transitions",
    "actions": "SELECT DISTINCT action FROM transitions",
    "pairs": "SELECT state, action FROM states CROSS JOIN actions",
    "uniform": "SELECT state, action, 1.0::DOUBLE / count(*) OVER (PARTITION BY state) AS policy FROM pairs",
    "target": "SELECT state, action, 0.1::DOUBLE + 0.6::DOUBLE * (action = 1)::INT AS policy FROM pairs",
    "behaviour": """
SELECT state, action, n / sum(n) OVER (PARTITION BY state) AS policy
FROM (SELECT state, action, count(*) AS n FROM transitions GROUP BY ALL)""",
    "v0": "SELECT state, 0.0::DOUBLE AS v FROM states",
    "pulls": """
SELECT user_id AS context, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS pull_no,
       (CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2 WHEN 'signup' THEN 3
             WHEN 'view' THEN 4 END)::BIGINT AS arm, value / 100 AS reward
FROM events""",
}

NEEDS: dict[str, list[str]] = {
    "flagged": ["log"],
    "sessions": ["flagged"],
    "transitions": ["sessions"],
    "counts": ["transitions"],
    "model": ["counts"],
    "states": ["transitions"],
    "actions": ["transitions"],
    "pairs": ["states", "actions"],
    "uniform": ["pairs"],
    "target": ["pairs"],
    "behaviour": ["transitions"],
    "v0": ["states"],
}


def r(expression: str, name: str) -> str:
    """The rounding every compared double gets."""
    return f"round(({expression})::DOUBLE + {OFF_BORDER}, 6) + 0.0::DOUBLE AS {name}"


def uniform_draw(seed: int, *key: str) -> str:
    return f"(('0x' || substr(md5(concat_ws('|', '{seed}', {', '.join(key)})), 1, 13))::UBIGINT::DOUBLE / 4503599627370496::DOUBLE)"


def statement(select: str, *needed: str, extra: list[tuple[str, str]] | None = None) -> str:
    """WITH the named blocks (and what they need), then ``extra`` blocks, then the select."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for other in NEEDS.get(name, []):
            add(other)
        if name not in ordered:
            ordered.append(name)

    for name in needed:
        add(name)
    blocks = [(name, CTES[name]) for name in ordered] + (extra or [])
    text = ",\n".join(f"{name} AS MATERIALIZED ({body.strip()})" for name, body in blocks)
    return f"WITH RECURSIVE {text}\n{select.strip()}" if blocks else select.strip()


def v_sweeps(step: str, count: int, first: str = "v0") -> list[tuple[str, str]]:
    """Unrolled sweeps v1..vK; ``step`` uses {prev}."""
    names = [first] + [f"v{i}" for i in range(1, count + 1)]
    return [(names[i], step.format(prev=names[i - 1], g=GAMMA, i=i)) for i in range(1, count + 1)]
