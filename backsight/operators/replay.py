"""Replaying ordered rows one after another, per key.

Some learners read their own writes: each update needs the result of the one before. They are replayed per key by a
grouped pandas function, all keys in parallel. A key of any size is fed in bounded slices: round r replays at most
``rows_per_round`` consecutive rows of every key, and the learner's state goes to the next round as one small row per
key. Ordinary keys finish in the first round.
"""

from __future__ import annotations

import pickle
import sys
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..storage import settle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ROWS_PER_ROUND = 1_000_000


def replay(
    rows: DataFrame,
    key: str,
    position: str,
    new_learner: Callable[[], Any],
    output: str,
    rows_per_round: int = ROWS_PER_ROUND,
) -> DataFrame:
    """Feed each key's rows in order of ``position`` (dense from 0) to its own learner.

    A learner has ``feed(frame)``, which takes the ordered rows of one slice and may return a frame of emitted rows;
    ``result()``, a frame of final rows; both with the columns of ``output`` after the key; and ``saved()`` and
    ``restore(values)`` for its state as plain values.
    """
    spark = rows.sparkSession
    names = [part.split()[0] for part in output.split(",")]
    schema = f"{key} LONG, _state BINARY, {output}"
    state_schema = f"{key} LONG, _state BINARY"

    def revived(saved: pd.DataFrame) -> Any:
        learner = new_learner()
        if len(saved):
            learner.restore(pickle.loads(saved["_state"].iloc[0]))
        return learner

    def run(current: pd.DataFrame, saved: pd.DataFrame) -> pd.DataFrame:
        if current.empty:  # nothing new for this key: its state stays as it is
            return saved.reindex(columns=[key, "_state", *names])
        learner = revived(saved)
        ordered = current.sort_values(position, kind="stable")
        emitted = learner.feed(ordered)
        head = pd.DataFrame({key: [ordered[key].iloc[0]], "_state": [pickle.dumps(learner.saved())]})
        frames = [head] if emitted is None or emitted.empty else [head, emitted.assign(**{key: ordered[key].iloc[0]})]
        return pd.concat(frames, ignore_index=True).reindex(columns=[key, "_state", *names])

    def finish(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for i in range(len(frame)):
                final = revived(frame.iloc[i : i + 1]).result()
                yield final.assign(**{key: frame[key].iloc[i]}).reindex(columns=[key, *names])

    slices = rows.withColumn("_round", F.floor(F.col(position) / rows_per_round).cast("long"))
    last = slices.agg(F.max("_round")).first()[0] or 0
    if last > 0:  # each round reads only its own part of the written table
        slices = settle(slices, "slices", ["_round"])
    states = spark.createDataFrame([], state_schema)
    # the work is in Python, not in bytes: keep the keys spread over all cores even where the data is small
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    emitted = None
    for i in range(last + 1):
        part = slices.filter(F.col("_round") == i).drop("_round") if last > 0 else slices.drop("_round")
        spread = part.repartition(tasks, key)
        done = settle(spread.groupBy(key).cogroup(states.groupBy(key)).applyInPandas(run, schema), "replayed")
        states = done.filter(F.col("_state").isNotNull()).select(key, "_state")
        fresh = done.filter(F.col("_state").isNull()).drop("_state")
        emitted = fresh if emitted is None else emitted.unionByName(fresh)
    results = states.mapInPandas(finish, f"{key} LONG, {output}")
    return emitted.unionByName(results)
