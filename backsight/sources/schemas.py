"""Declared schemas of the canonical tables."""

MODEL = "state LONG, action LONG, probability DOUBLE, next_state LONG, reward DOUBLE, done BOOLEAN"
STATE_VALUES = "state LONG, v DOUBLE"
ACTION_VALUES = "state LONG, action LONG, q DOUBLE"
POLICY = "state LONG, action LONG, policy DOUBLE"
TRANSITIONS = (
    "segment LONG, episode LONG, step_count LONG, state LONG, action LONG, reward DOUBLE, "
    "next_state LONG, done BOOLEAN, ts TIMESTAMP_NTZ, event_id LONG"
)
PULLS = "context LONG, pull_no LONG, arm LONG, reward DOUBLE"
LINEAR_STEPS = "episode LONG, step_count LONG, features ARRAY<DOUBLE>, action LONG, reward DOUBLE, propensity DOUBLE"
HISTORY = "iteration LONG, max_delta DOUBLE"
