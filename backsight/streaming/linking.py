"""Transitions from an event stream, linked a micro-batch at a time: one job for all segments, however many there are.

``stream_transitions`` talks to its state for every segment and slot of time. Here the batch builder links, by windows over
ranges of rows, what the watermark has reached, and the state is a few written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.ordering import ROWS_PER_CHUNK, join_on
from ..sources.logs import build_transitions
from .tables import KeyedLog, VersionedTable

EVENT = "segment LONG, at_us LONG, event_id LONG, state LONG, action LONG, reward DOUBLE"
STEP = (
    "segment LONG, episode LONG, step_count LONG, state LONG, action LONG, reward DOUBLE, next_state LONG, done BOOLEAN, "
    "at_us LONG, event_id LONG, is_open BOOLEAN"
)
STEP_NAMES = [part.split()[0] for part in STEP.split(", ")]
HOUR_US = 3_600_000_000


class TransitionLog:
    """The transitions that a stream of events has made certain, and the state to go on from, in folders named by batch number.

    State after a batch: the held events, which are those that the watermark has not reached and the last one of every open
    episode; and for each segment the number of its ended episodes and of the open one's steps before its held event.
    After the gap only the number of its episodes is left of a segment. The watermark follows from the held events,
    because the latest event of all is always one of them.

    Batch n is computed from the state after n - 1 and the batch alone and replaces whatever an interrupted attempt left.
    """

    def __init__(self, spark: SparkSession, path: str, gap_hours: int = 24, delay_hours: int = 1, rows_per_chunk: int = ROWS_PER_CHUNK):
        self.spark, self.gap_hours, self.delay_us, self.rows_per_chunk = spark, gap_hours, delay_hours * HOUR_US, rows_per_chunk
        self.held = VersionedTable(spark, f"{path}/held", EVENT)
        self.progress = KeyedLog(spark, f"{path}/progress", "segment LONG, ended LONG, steps LONG", ["segment"])
        self.steps = VersionedTable(spark, f"{path}/steps", STEP)

    def start(self) -> None:
        """The state before the first batch."""
        self.held.write(self.spark.createDataFrame([], self.held.schema), -1)
        self.progress.write(self.spark.createDataFrame([], self.progress.schema), -1)

    def _mark(self, latest_us: int | None) -> int | None:
        """The watermark in microseconds, at whole milliseconds like Spark's."""
        return None if latest_us is None else latest_us // 1000 * 1000 - self.delay_us

    def link(self, batch: DataFrame, number: int) -> None:
        held = self.held.read(number - 1)
        events = batch.withColumn("at_us", F.unix_micros(F.col("ts").cast("timestamp"))).where("at_us is not null").select(*held.columns)
        before, new = (rows.agg(F.max("at_us")).first()[0] for rows in (held, events))
        passed, mark = self._mark(before), self._mark(max((at for at in (before, new) if at is not None), default=None))
        rows = held.unionByName(events if passed is None else events.where(F.col("at_us") > passed))

        reached = rows.where(F.col("at_us") <= F.lit(mark)).withColumn("ts", F.timestamp_micros("at_us"))
        linked = build_transitions(reached, self.gap_hours, self.rows_per_chunk).withColumn("at_us", F.unix_micros("ts"))
        # an open episode's held event is the first row of its segment
        goes_on = F.when(F.col("episode") == 1, F.coalesce("steps", F.lit(0))).otherwise(0)
        placed = (
            join_on(linked, self.progress.read(number - 1), ["segment"], "left")
            .withColumn("step_count", F.col("step_count") + goes_on)
            .withColumn("episode", F.col("episode") + F.coalesce("ended", F.lit(0)))
            .withColumn("is_open", F.col("done") & (F.col("at_us") + self.gap_hours * HOUR_US >= F.lit(mark)))
        )
        self.steps.write(placed.select(*STEP_NAMES), number)

        written = self.steps.read(number)
        still_open = written.where("is_open").select(*held.columns)
        self.held.write(rows.where(F.col("at_us") > F.lit(mark)).unionByName(still_open), number)
        changed = written.groupBy("segment").agg(
            (F.max("episode") - F.max(F.col("is_open").cast("long"))).alias("ended"),
            F.coalesce(F.max(F.when(F.col("is_open"), F.col("step_count"))), F.lit(0)).alias("steps"),
        )
        self.progress.write(changed, number)

    def read(self, number: int) -> DataFrame:
        """The transitions that are certain after batch ``number``."""
        steps = self.spark.read.schema(f"{STEP}, version LONG").parquet(self.steps.path).where((F.col("version") <= number) & ~F.col("is_open"))
        stamped = steps.withColumn("ts", F.timestamp_micros("at_us").cast("timestamp_ntz"))
        return stamped.select(*[n for n in STEP_NAMES if n not in ("at_us", "event_id", "is_open")], "ts", "event_id")


def run_linked(log: DataFrame, table: TransitionLog, checkpoint: str) -> StreamingQuery:
    """Link every micro-batch of ``log`` (segment, ts, event_id, state, action, reward), with ``ts`` TIMESTAMP or TIMESTAMP_NTZ.

    Events may arrive out of order by up to the table's delay; later ones are dropped, as by a watermark. The cases are
    those of ``stream_transitions``: a null segment is a segment, events without a time are left out, repeated events are
    events of their own.
    """
    return log.writeStream.foreachBatch(table.link).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
