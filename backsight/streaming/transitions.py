"""Transitions from an event stream: a step is emitted once the step after it, or the end of its episode, is certain."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

OUTPUT = (
    "segment LONG, episode LONG, step_count LONG, state LONG, action LONG, reward DOUBLE, next_state LONG, done BOOLEAN, "
    "at_us LONG, event_id LONG"
)
NAMES = [part.split()[0] for part in OUTPUT.split(", ")]
STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
HOUR_MS = 3_600_000
#: Events of one segment that are held before they go to the state.
HELD = 10_000


@contextmanager
def keyed_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which map states and timers need."""
    before = spark.conf.get(STORE)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.set(STORE, before)


def _ready_ms(at_us: int) -> int:
    """The least watermark, in milliseconds, that has reached an event."""
    return -(-at_us // 1000)


class Linker(StatefulProcessor):
    """Events wait in slots of event time until timers link them in order.

    State of a segment: the waiting events by (slot, part), what is known of each slot, and its progress: the number of its
    episodes and the open step, null between episodes. A slot has two timers: at its first event it is linked, and a gap after its last one the step that is
    still open then is closed. Timers fire in order of time, so slots are linked in order; an episode's last event is the
    last of its slot, because a slot is no wider than the gap.
    """

    def __init__(self, gap_ms: int, slot_ms: int, forget_ms: int | None) -> None:
        self.gap_ms, self.slot_ms, self.forget_ms = gap_ms, min(slot_ms, gap_ms), forget_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slots = handle.getMapState("slots", "slot LONG", "parts LONG, low LONG, high LONG")
        self.events = handle.getMapState(
            "events", "slot LONG, part LONG",
            "at ARRAY<LONG>, event_id ARRAY<LONG>, state ARRAY<LONG>, action ARRAY<LONG>, reward ARRAY<DOUBLE>",
        )
        self.progress = handle.getValueState(
            "progress", "episode LONG, last LONG, at LONG, event_id LONG, state LONG, action LONG, reward DOUBLE, step_count LONG"
        )

    def closes_ms(self, at_us: int) -> int:
        """The least watermark that is more than the gap past an event."""
        return (at_us + self.gap_ms * 1000) // 1000 + 1

    def forgotten_ms(self, at_us: int) -> float:
        """The least watermark that forgets a segment whose last event this is."""
        return float("inf") if self.forget_ms is None else _ready_ms(at_us) + self.forget_ms

    def put(self, held: list[tuple]) -> None:
        by_slot: dict[int, list[tuple]] = {}
        for event in held:
            by_slot.setdefault(_ready_ms(event[0]) // self.slot_ms, []).append(event)
        for slot, events in by_slot.items():
            low, high = min(e[0] for e in events), max(e[0] for e in events)
            known = self.slots.getValue((slot,))
            parts, known_low, known_high = known if known is not None else (0, None, None)
            if known_low is None or low < known_low:
                self.handle.registerTimer(_ready_ms(low))
                known_low = low
            if known_high is None or high > known_high:
                self.handle.registerTimer(self.closes_ms(high))
                if self.forget_ms is not None:
                    self.handle.registerTimer(self.forgotten_ms(high))
                known_high = high
            self.events.updateValue((slot, parts), tuple(map(list, zip(*events, strict=True))))
            self.slots.updateValue((slot,), (parts + 1, known_low, known_high))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = []
        for row in rows:
            held.append((row.at_us, row.event_id, row.state, row.action, row.reward))
            if len(held) == HELD:
                self.put(held)
                held = []
        if held:
            self.put(held)
        return iter(())

    def take(self, slot: int, watermark_us: int) -> list[tuple]:
        """The events of a slot that the watermark has reached, in order; they leave the state, others stay."""
        known = self.slots.getValue((slot,))
        if known is None:
            return []
        events = []
        for part in range(known[0]):
            events.extend(zip(*self.events.getValue((slot, part)), strict=True))
            self.events.removeKey((slot, part))
        self.slots.removeKey((slot,))
        later = [e for e in events if e[0] > watermark_us]
        for start in range(0, len(later), HELD):
            self.put(later[start : start + HELD])
        return sorted((e for e in events if e[0] <= watermark_us), key=lambda e: e[:2])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now = expiredTimerInfo.getExpiryTimeInMs()
        events = self.take(now // self.slot_ms, timerValues.getCurrentWatermarkInMs() * 1000)
        before = self.progress.get()
        episode, last, step = (0, None, None) if before is None else (before[0], before[1], before[2:])
        if step is not None and step[0] is None:
            step = None

        def emitted(next_state: int | None, done: bool) -> Row:
            at, event_id, state, action, reward, count = step
            return Row(**dict(zip(NAMES, (key[0], episode, count, state, action, reward, next_state, done, at, event_id), strict=True)))

        changed = bool(events)
        for event in events:
            fresh = step is None or event[0] - step[0] > self.gap_ms * 1000
            if step is not None:
                yield emitted(None if fresh else event[2], fresh)
            if last is not None and self.forgotten_ms(last) <= _ready_ms(event[0]):
                episode = 0
            episode += fresh
            step, last = (*event, 0 if fresh else step[5] + 1), event[0]
        if step is not None and self.closes_ms(step[0]) <= now:
            yield emitted(None, True)
            step, changed = None, True
        if last is not None and step is None and self.forgotten_ms(last) <= now:
            self.progress.clear()
        elif changed:
            self.progress.update((episode, last, *(step or (None,) * 6)))


def stream_transitions(log: DataFrame, gap_hours: int = 24, delay: str = "1 hour", slot_hours: int = 24, forget_hours: int | None = None) -> DataFrame:
    """Streaming form of the transition builder; start the stream inside ``keyed_state``.

    ``log`` has (segment, ts, event_id, state, action, reward) with ``ts`` TIMESTAMP or TIMESTAMP_NTZ. Events may arrive
    out of order by up to ``delay``; per segment they wait until the watermark has passed them and are then linked in
    order of (ts, event_id). Later ones are dropped by the watermark. An episode closes when the watermark is more than
    the gap past its last event.

    A task holds the events of one segment in one slot of ``slot_hours`` (the gap, if that is less); narrow the slots for
    segments with more events in a day than a task can hold. After the gap nothing is left of a segment but the number of
    its episodes; with ``forget_hours`` (the gap or more) this goes too, so long after its last event, and the segment's next
    episode is number 1 again.

    Cases: a null segment is a segment; events without a time are left out; null states, actions and rewards stay null;
    repeated events are events of their own; other columns are ignored.
    """
    if forget_hours is not None and forget_hours <= gap_hours:
        raise ValueError("forget_hours has to be more than gap_hours")
    stamped = log.withColumn("ts", F.col("ts").cast("timestamp")).where("ts is not null")
    linked = (
        stamped.withWatermark("ts", delay)
        .select("segment", "ts", F.unix_micros("ts").alias("at_us"), "event_id", "state", "action", "reward")
        .groupBy("segment")
        .transformWithState(
            Linker(gap_hours * HOUR_MS, slot_hours * HOUR_MS, None if forget_hours is None else forget_hours * HOUR_MS),
            OUTPUT, "append", "eventTime",
        )
    )
    return linked.withColumn("ts", F.timestamp_micros("at_us").cast("timestamp_ntz")).select(
        *[n for n in NAMES if n not in ("at_us", "event_id")], "ts", "event_id"
    )
