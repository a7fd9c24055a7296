"""Reading logged steps: event logs to transitions, pulls and feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordering import ROWS_PER_CHUNK, hot_keys, join_on, numbered, with_chunk

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]  # fixed values: index = position


def event_type_index(name: str = "event_type") -> Column:
    index = F.lit(None).cast("long")
    for i, kind in enumerate(EVENT_TYPES):
        index = F.when(F.col(name) == kind, F.lit(i).cast("long")).otherwise(index)
    return index


def read_event_log(spark: SparkSession, path: str) -> DataFrame:
    return event_log(spark.read.parquet(path))


def event_log(events: DataFrame) -> DataFrame:
    """Event rows, batch or stream, as (segment, ts, event_id, state, action, reward)."""
    bucket = F.get_json_object("props", "$.k").cast("long")
    return events.select(
        F.col("user_id").alias("segment"),
        "ts",
        "event_id",
        (event_type_index() * 4 + F.floor(F.hour("ts") / 6)).cast("long").alias("state"),
        F.floor(bucket / 25).cast("long").alias("action"),
        (F.col("value") / 100).alias("reward"),
    )


def _beyond(ts: Column, previous: Column, gap_hours: int) -> Column:
    return ts > previous + F.make_dt_interval(hours=F.lit(gap_hours))


def build_transitions(log: DataFrame, gap_hours: int = 24, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Cut each segment's ordered log into episodes at gaps and attach the following state.

    One shuffle by segment and one sort serve every window. Segments with more than ``rows_per_chunk`` rows are
    cut into ranges of their rows, whose borders are settled from one summary row per range.
    """
    hot = hot_keys(log, ["segment"], rows_per_chunk)
    rows = with_chunk(log, ["segment"], ["ts", "event_id"], hot, rows_per_chunk)
    piece = W.partitionBy("segment", "chunk").orderBy("ts", "event_id")
    so_far = piece.rowsBetween(W.unboundedPreceding, W.currentRow)
    inner_start = F.coalesce(_beyond(F.col("ts"), F.lag("ts").over(piece), gap_hours), F.lit(False))
    local = (
        rows.withColumn("_row", F.row_number().over(piece))
        .withColumn("_start", inner_start)
        .withColumn("_next_ts", F.lead("ts").over(piece))
        .withColumn("_next_state", F.lead("state").over(piece))
        .withColumn("_starts", F.sum(F.col("_start").cast("long")).over(so_far))
        .withColumn("_start_row", F.max(F.when(F.col("_start"), F.col("_row"))).over(so_far))
    )
    if hot is None:
        placed = local.select(
            "*",
            F.lit(0).cast("long").alias("_episodes_before"),
            F.lit(True).alias("_first_starts"),
            F.lit(0).cast("long").alias("_open_steps"),
        )
    else:
        placed = (
            join_on(local, _chunk_borders(local.filter("is_hot"), gap_hours), ["segment", "chunk"], "left")
            .withColumn("_episodes_before", F.coalesce("_episodes_before", F.lit(0)))
            .withColumn("_first_starts", F.coalesce("_first_starts", F.lit(True)))
            .withColumn("_open_steps", F.coalesce("_open_steps", F.lit(0)))
            # the next state may itself be null; only a range's last row takes it from the range after
            .withColumn("_next_state", F.when(F.col("_row") == F.col("_chunk_size"), F.col("_border_state")).otherwise(F.col("_next_state")))
            .withColumn("_next_ts", F.coalesce("_next_ts", "_border_ts"))
        )
    in_open = F.col("_start_row").isNull()
    done = F.col("_next_ts").isNull() | _beyond(F.col("_next_ts"), F.col("ts"), gap_hours)
    return placed.select(
        "segment",
        (F.col("_episodes_before") + F.col("_first_starts").cast("long") + F.col("_starts")).alias("episode"),
        F.when(in_open, F.col("_open_steps") + F.col("_row") - 1)
        .otherwise(F.col("_row") - F.col("_start_row")).cast("long").alias("step_count"),
        "state",
        "action",
        "reward",
        F.when(~done, F.col("_next_state")).alias("next_state"),
        done.alias("done"),
        "ts",
        "event_id",
    )


def _chunk_borders(local: DataFrame, gap_hours: int) -> DataFrame:
    """Per chunk of a hot segment: episodes before it, whether it opens one, steps already in the open one, next row."""
    chunks = local.groupBy("segment", "chunk").agg(
        F.min("ts").alias("first_ts"),
        F.min_by("state", F.struct("ts", "event_id")).alias("first_state"),
        F.max("ts").alias("last_ts"),
        F.count("*").alias("size"),
        F.max("_starts").alias("inner_starts"),
        F.max("_start_row").alias("last_start"),
    )
    by_segment = W.partitionBy("segment").orderBy("chunk")
    earlier = by_segment.rowsBetween(W.unboundedPreceding, -1)
    so_far = by_segment.rowsBetween(W.unboundedPreceding, W.currentRow)
    opens = F.coalesce(_beyond(F.col("first_ts"), F.lag("last_ts").over(by_segment), gap_hours), F.lit(True))
    runs = (
        chunks.withColumn("opens", opens)
        .withColumn("border_ts", F.lead("first_ts").over(by_segment))
        .withColumn("border_state", F.lead("first_state").over(by_segment))
        .withColumn("episodes_before", F.coalesce(F.sum(F.col("inner_starts") + F.col("opens").cast("long")).over(earlier), F.lit(0)))
        .withColumn("resets", F.col("opens") | (F.col("inner_starts") > 0))
        .withColumn("run", F.sum(F.col("resets").cast("long")).over(so_far))
        # steps this chunk adds to the episode still open at its end
        .withColumn("tail", F.when(F.col("inner_starts") > 0, F.col("size") - F.col("last_start") + 1).otherwise(F.col("size")))
    )
    in_run = W.partitionBy("segment", "run").orderBy("chunk").rowsBetween(W.unboundedPreceding, W.currentRow)
    open_after = runs.withColumn("open_after", F.sum("tail").over(in_run))
    open_before = F.when(F.col("opens"), F.lit(0)).otherwise(F.coalesce(F.lag("open_after").over(by_segment), F.lit(0)))
    return open_after.select(
        "segment",
        "chunk",
        F.col("episodes_before").alias("_episodes_before"),
        F.col("opens").alias("_first_starts"),
        open_before.alias("_open_steps"),
        F.col("size").alias("_chunk_size"),
        F.col("border_ts").alias("_border_ts"),
        F.col("border_state").alias("_border_state"),
    )


def read_pulls(spark: SparkSession, path: str, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Event rows as bandit pulls (context, pull_no, arm, reward), numbered per context in time order."""
    pulls = spark.read.parquet(path).select(
        F.col("user_id").alias("context"),
        event_type_index().alias("arm"),
        (F.col("value") / 100).alias("reward"),
        "ts",
        "event_id",
    )
    return numbered(pulls, ["context"], ["ts", "event_id"], "pull_no", rows_per_chunk).select(
        "context", "pull_no", "arm", "reward"
    )


def read_linear_steps(spark: SparkSession, path: str, per_episode: int = 10) -> DataFrame:
    """Vectors as logged steps: the last number is the reward, all others are the state."""
    vectors = spark.read.parquet(path)
    numbers = F.col("embedding").cast("array<double>")
    return vectors.select(
        F.floor(F.col("vec_id") / per_episode).cast("long").alias("episode"),
        (F.col("vec_id") % per_episode).cast("long").alias("step_count"),
        F.slice(numbers, 1, F.size(numbers) - 1).alias("features"),
        (F.col("label") % 2).cast("long").alias("action"),
        F.element_at(numbers, -1).alias("reward"),
        F.lit(None).cast("double").alias("propensity"),
    )
