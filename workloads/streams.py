"""Streaming forms (i*), fed from the given tables or from tables Spark wrote from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from backsight.operators import models as M
from backsight.sources import logs
from backsight.sources.schemas import ACTION_VALUES
from backsight.storage import new_path
from backsight.streaming import tables as T
from backsight.streaming.linking import TransitionLog, run_linked

from . import bandits, common as C
from .common import EVENT_ACTIONS, GAMMA, ORACLES, query
from .sqltext import r, statement

COUNTS = "state LONG, action LONG, next_state LONG, experience_count LONG, reward_sum DOUBLE"
ARMS = "context LONG, arm LONG, n LONG, estimate DOUBLE"


def folder_of(table):
    return table.inputFiles()[0].rsplit("/", 1)[0]


def stream_of(spark, table):
    """All files of a written table in one micro-batch, however many there are."""
    return spark.readStream.schema(table.schema).parquet(folder_of(table))


BATCHES = 4


def time_ranges(rows):
    """Rows cut into ranges of their time."""
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    first, last = rows.agg(F.min(at), F.max(at)).first()
    number = F.coalesce(F.floor((at - first) * BATCHES / ((last or 0) - (first or 0) + 1)), F.lit(0))
    return [rows.where(number == k) for k in range(BATCHES)]


def in_date_order(steps, table, fold):
    """Steps arrive in ranges of their time, one range a micro-batch, however many files there are."""
    spark = steps.sparkSession
    arrived, checkpoint = new_path(spark, "arrived-steps"), new_path(spark, "checkpoint")
    for part in time_ranges(steps):
        part.write.mode("append").parquet(arrived)
        run = T.run_batches(spark.readStream.schema(steps.schema).parquet(arrived), table, fold, checkpoint)
        run.awaitTermination()
    return table.read(run.lastProgress["batchId"])


@query("i1_stream_transitions")
def i1(spark, sf_dir):
    """Events arrive in four ranges of their time; a run reads one and goes on with the state of the runs before it."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    arrived, checkpoint = new_path(spark, "arrived-events"), new_path(spark, "checkpoint")
    table = TransitionLog(spark, new_path(spark, "stream-transitions"))
    table.start()
    for part in time_ranges(events):
        part.write.mode("append").parquet(arrived)
        run = run_linked(logs.event_log(spark.readStream.schema(events.schema).parquet(arrived)), table, checkpoint)
        run.awaitTermination()
    return table.read(run.lastProgress["batchId"]).drop("ts")


# what the watermark (latest event - 1 hour, in milliseconds) has made certain
ORACLES["i1_stream_transitions"] = statement(
    f"SELECT segment, episode, step_count, state, action, {r('reward', 'reward')}, next_state, done, event_id FROM "
    "(SELECT *, lead(ts) OVER (PARTITION BY segment ORDER BY ts, event_id) AS next_ts, "
    "(SELECT date_trunc('millisecond', max(ts)) - INTERVAL 1 HOUR FROM transitions) AS mark FROM transitions) "
    "WHERE ts <= mark AND (next_ts <= mark OR ts + INTERVAL 24 HOUR < mark)",
    "transitions",
)


@query("i2_stream_model")
def i2(spark, sf_dir):
    steps = C.transitions(spark, sf_dir)
    out = new_path(spark, "stream-counts")
    counts = T.running_counts(stream_of(spark, steps))

    def write(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/version={number}")

    run = (
        counts.writeStream.outputMode("complete").foreachBatch(write)
        .option("checkpointLocation", new_path(spark, "checkpoint")).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    latest = spark.read.parquet(out)
    newest = latest.agg(F.max("version")).first()[0]
    return T.model_of_counts(latest.filter(F.col("version") == newest).drop("version"))


ORACLES["i2_stream_model"] = ORACLES["a3_empirical_model"]


@query("i2_stream_model_upsert")
def i2_upsert(spark, sf_dir):
    log = T.KeyedLog(spark, new_path(spark, "stream-counts"), COUNTS, ["state", "action", "next_state"])
    log.write(spark.createDataFrame([], COUNTS), -1)
    return T.model_of_counts(in_date_order(C.transitions(spark, sf_dir), log, T.changed_counts))


ORACLES["i2_stream_model_upsert"] = ORACLES["a3_empirical_model"]


@query("i3_stream_q_learning")
def i3(spark, sf_dir):
    log = T.KeyedLog(spark, new_path(spark, "stream-q"), ACTION_VALUES, ["state", "action"])
    log.write(M.init_q(C.states(spark, sf_dir), EVENT_ACTIONS), -1)
    return in_date_order(C.transitions(spark, sf_dir), log, T.changed_q(GAMMA, 0.5))


# one sweep for each range of the time, which reads what the ranges before it learned
Q_BATCH = """
SELECT state, action, q + 0.5 * (coalesce(target, q) - q) AS q FROM {prev} LEFT JOIN (
  SELECT t.state, t.action, avg(t.reward + {g} * CASE WHEN t.done THEN 0 ELSE coalesce(b.v, 0) END) AS target
  FROM dated t LEFT JOIN (SELECT state, max(q) AS v FROM {prev} GROUP BY state) b ON t.next_state = b.state
  WHERE t.batch = {i} GROUP BY t.state, t.action) USING (state, action)"""
ORACLES["i3_stream_q_learning"] = statement(
    f"SELECT state, action, {r('q', 'q')} FROM q{BATCHES}", "transitions", "pairs",
    extra=[
        ("dated", "SELECT t.*, (epoch_us(ts) - low) * 4 // (high - low + 1) AS batch FROM transitions t, "
                  "(SELECT min(epoch_us(ts)) AS low, max(epoch_us(ts)) AS high FROM transitions)"),
        ("q0", "SELECT state, action, 0.0::DOUBLE AS q FROM pairs"),
        *[(f"q{k + 1}", Q_BATCH.format(prev=f"q{k}", g=GAMMA, i=k)) for k in range(BATCHES)],
    ],
)


@query("i4_stream_arms")
def i4(spark, sf_dir):
    """Pulls arrive in ranges of their number, one range a micro-batch: an arm's estimate depends on their order."""
    pulls = C.pulls(spark, sf_dir)
    last = pulls.agg(F.max("pull_no")).first()[0] or 1
    arrived, checkpoint = new_path(spark, "arrived-pulls"), new_path(spark, "checkpoint")
    table = T.VersionedTable(spark, new_path(spark, "stream-arms"), ARMS)
    table.write(spark.createDataFrame([], ARMS), -1)
    for k in range(BATCHES):
        above, upto = last * k // BATCHES, last * (k + 1) // BATCHES
        pulls.where((F.col("pull_no") > above) & (F.col("pull_no") <= upto)).write.mode("append").parquet(arrived)
        stream = spark.readStream.schema(pulls.schema).parquet(arrived)
        run = T.run_batches(stream, table, T.fold_arms(bandits.LR), checkpoint)
        run.awaitTermination()
    return table.read(run.lastProgress["batchId"])


ORACLES["i4_stream_arms"] = ORACLES["f1_arm_estimates"]
