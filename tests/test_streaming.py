import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from backsight.operators import bandits as N
from backsight.operators import models as M
from backsight.sources import logs
from backsight.sources.schemas import ACTION_VALUES
from backsight.storage import new_path
from backsight.streaming import tables as T
from backsight.streaming.transitions import keyed_state, stream_transitions
from golden import START, as_dict, random_episodes, transitions


def files(df, count, order):
    """Write ``count`` files, in order, so that a stream of one file per batch sees the rows in that order."""
    path = new_path(df.sparkSession, "feed")
    rows = df.count()
    from pyspark.sql import Window as W

    numbered = df.withColumn("_f", F.floor((F.row_number().over(W.partitionBy(F.lit(1)).orderBy(*order)) - 1) * count / rows))
    for i in range(count):
        numbered.filter(F.col("_f") == i).drop("_f").coalesce(1).write.mode("append").parquet(path)
    return path


def test_transitions_from_an_unordered_stream(spark):
    rng = random.Random(3)
    rows, at = [], START
    for event in range(120):
        at += dt.timedelta(hours=rng.choice([0, 1, 1, 2, 9]), minutes=rng.randrange(60))
        rows.append((rng.randrange(3), at, event, rng.randrange(4), rng.randrange(2), rng.random()))
    end = (9, at + dt.timedelta(days=60), 999, 0, 0, 0.0)  # moves the watermark past everything else
    log = spark.createDataFrame(rows, "segment LONG, ts TIMESTAMP_NTZ, event_id LONG, state LONG, action LONG, reward DOUBLE")
    shuffled = log.withColumn("o", F.col("event_id") + F.when(F.col("event_id") % 7 == 0, 4).otherwise(0))
    path = files(shuffled, 4, ["o"])
    spark.createDataFrame([end], log.schema).withColumn("o", F.lit(10**6).cast("long")).coalesce(1).write.mode("append").parquet(path)
    stream = spark.readStream.schema(shuffled.schema).option("maxFilesPerTrigger", 1).parquet(path).drop("o")
    out = new_path(spark, "out")
    linked = stream_transitions(stream, 24, "3 days")
    with keyed_state(spark):
        run = (
            linked.writeStream.format("parquet").option("path", out).option("checkpointLocation", new_path(spark, "cp"))
            .trigger(availableNow=True).start()
        )
        run.awaitTermination()
    found = spark.read.schema(linked.schema).parquet(out).filter("segment <> 9")
    expected = logs.build_transitions(log).select(found.columns)
    assert sorted(map(tuple, found.collect()), key=str) == sorted(map(tuple, expected.collect()), key=str)


EVENT = "segment LONG, ts TIMESTAMP_NTZ, event_id LONG, state LONG, action LONG, reward DOUBLE"


def linked_in_batches(spark, batches, **options):
    """The rows of a stream that gets each of ``batches`` in a run of its own, and the checkpoint with its state."""
    arrived, out, checkpoint = new_path(spark, "feed"), new_path(spark, "out"), new_path(spark, "cp")
    for rows in batches:
        spark.createDataFrame(rows, EVENT).write.mode("append").parquet(arrived)
        linked = stream_transitions(spark.readStream.schema(EVENT).parquet(arrived), **options)
        with keyed_state(spark):
            run = linked.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
            run.awaitTermination()
    return spark.read.schema(linked.schema).parquet(out), checkpoint


def left(spark, checkpoint, name):
    with keyed_state(spark):
        return spark.read.format("statestore").option("stateVarName", name).load(checkpoint).collect()


def test_a_hot_segment_late_rows_nulls_and_state_that_goes(spark, monkeypatch):
    monkeypatch.setattr("backsight.streaming.transitions.HELD", 7)  # events of a slot lie in many parts
    rng = random.Random(5)
    rows, at = [], START
    for event in range(600):
        at += dt.timedelta(minutes=rng.choice([0, 1, 5, 30, 300]), seconds=rng.randrange(60), microseconds=rng.randrange(10**6))
        hot = rng.random() < 0.8
        rows.append((1 if hot else rng.choice([2, None]), at, event, rng.choice([0, 1, None]), rng.choice([0, None]), rng.choice([0.5, None])))
    rows += [rows[40], rows[41], rows[41]]  # repeated events
    rows.sort(key=lambda r: r[1])
    expected = logs.build_transitions(spark.createDataFrame(rows, EVENT), 4)
    end = (9, at + dt.timedelta(days=60), 999, 0, 0, 0.0)
    late = [(1, rows[0][1], 5000, 7, 7, 7.0), (3, rows[5][1], 5001, 7, 7, 7.0)]
    nothing = [(1, None, 5002, 7, 7, 7.0)]
    for index in range(0, 600, 10):  # out of order within ten events
        part = rows[index : index + 10]
        rng.shuffle(part)
        rows[index : index + 10] = part
    batches = [rows[:250] + nothing, rows[250:450] + late, rows[450:] + [end]]
    found, checkpoint = linked_in_batches(spark, batches, gap_hours=4, delay="2 days", slot_hours=1)
    found = found.filter("segment is null or segment <> 9")
    columns = [c for c in found.columns if c != "event_id"]
    assert sorted(map(tuple, found.select(columns).collect()), key=str) == sorted(map(tuple, expected.select(columns).collect()), key=str)
    # after the gap only the number of its episodes is left of a segment; the last event still waits
    assert [row.key.segment for row in left(spark, checkpoint, "slots")] == [9]
    assert [row.key.segment for row in left(spark, checkpoint, "events")] == [9]
    progress = left(spark, checkpoint, "progress")
    assert {row.key.segment for row in progress} == {1, 2, None}
    assert {row.value.at for row in progress} == {None}


def test_a_segment_is_forgotten(spark):
    hour = dt.timedelta(hours=1)
    rows = [(s, START + n * hour, n, n, 0, 1.0) for s, n in ((1, 0), (1, 1), (1, 40), (2, 0), (2, 130))]
    batches = [rows, [(9, START + 120 * hour, 90, 0, 0, 0.0)], [(1, START + 130 * hour, 130, 5, 0, 1.0)], [(9, START + 300 * hour, 91, 0, 0, 0.0)]]
    kept, _ = linked_in_batches(spark, batches, gap_hours=10)
    gone, checkpoint = linked_in_batches(spark, batches, gap_hours=10, forget_hours=60)
    number = lambda df: {(r.segment, r.event_id): (r.episode, r.step_count, r.next_state) for r in df.filter("segment < 9").collect()}
    first = {(1, 0): (1, 0, 1), (1, 1): (1, 1, None), (1, 40): (2, 0, None), (2, 0): (1, 0, None)}
    assert number(kept) == first | {(1, 130): (3, 0, None), (2, 130): (2, 0, None)}
    assert number(gone) == first | {(1, 130): (1, 0, None), (2, 130): (1, 0, None)}
    assert left(spark, checkpoint, "progress") == []  # the last event still waits
    with pytest.raises(ValueError):
        stream_transitions(spark.createDataFrame(rows, EVENT), gap_hours=10, forget_hours=10)


def test_model_q_and_arms_over_several_batches(spark):
    steps = transitions(spark, random_episodes(5, 30))
    path = files(steps, 3, ["event_id"])
    feed = spark.readStream.schema(steps.schema).option("maxFilesPerTrigger", 1).parquet(path)

    def fold(start, schema, function):
        table = T.VersionedTable(spark, new_path(spark, "versions"), schema)
        table.write(start, -1)
        run = T.run_batches(feed, table, function, new_path(spark, "cp"))
        run.awaitTermination()
        return table, run.lastProgress["batchId"]

    counts = "state LONG, action LONG, next_state LONG, reward DOUBLE, experience_count LONG, probability DOUBLE, done BOOLEAN"
    table, last = fold(spark.createDataFrame([], counts), counts, T.fold_model)
    assert last == 2
    key = ("state", "action", "next_state")
    whole = M.empirical_model(steps)
    for column in ("reward", "experience_count", "probability"):
        assert as_dict(table.read(last).select(*key, column), *key) == pytest.approx(as_dict(whole.select(*key, column), *key))

    q_fold = T.fold_q_learning(0.9, 0.5)
    table, last = fold(spark.createDataFrame([], ACTION_VALUES), ACTION_VALUES, q_fold)
    q = {}
    batches = [[r for r in spark.read.parquet(f).collect()] for f in steps_files(spark, path)]
    for batch in batches:
        sums = {}
        for r in batch:
            ahead = 0 if r.done else 0.9 * max([x for (s, _), x in q.items() if s == r.next_state], default=0.0)
            sums.setdefault((r.state, r.action), []).append(r.reward + ahead)
        for k, targets in sums.items():
            q[k] = q.get(k, 0.0) + 0.5 * (sum(targets) / len(targets) - q.get(k, 0.0))
    assert as_dict(table.read(last), "state", "action") == pytest.approx(q)
    # a batch that runs again after a failure changes nothing
    before = as_dict(table.read(last), "state", "action")
    table.write(q_fold(table.read(last - 1), spark.createDataFrame(batches[last], steps.schema)), last)
    assert as_dict(table.read(last), "state", "action") == pytest.approx(before)


def steps_files(spark, path):
    """Files of the feed in the order they were written."""
    rows = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(path).select("path", "modificationTime")
    return [r.path for r in rows.orderBy("modificationTime").collect()]


def test_arm_estimates_over_batches(spark):
    rng = random.Random(1)
    rows = [(c, i + 1, rng.randrange(2), rng.random()) for c in range(2) for i in range(30)]
    pulls = spark.createDataFrame(rows, "context LONG, pull_no LONG, arm LONG, reward DOUBLE")
    fold = T.fold_arms(0.1, 1.0)
    arms = spark.createDataFrame([], "context LONG, arm LONG, n LONG, estimate DOUBLE")
    for low in (0, 10, 20):
        arms = fold(arms, pulls.filter((F.col("pull_no") > low) & (F.col("pull_no") <= low + 10)))
    whole = N.constant_step_estimates(pulls, 0.1, 1.0)
    key = ("context", "arm")
    for column in ("n", "estimate"):
        assert as_dict(arms.select(*key, column), *key) == pytest.approx(as_dict(whole.select(*key, column), *key))


def test_registered_streams_do_not_depend_on_the_number_of_files(spark, tmp_path, monkeypatch):
    import __spark_entry__  # noqa: F401
    from workloads import bandits, streams

    rows = [(1, n, 0, float(n)) for n in range(1, 1201)]
    path = str(tmp_path / "pulls")
    spark.createDataFrame(rows, "context LONG, pull_no LONG, arm LONG, reward DOUBLE").repartition(1200, "pull_no").write.option("maxRecordsPerFile", 1).parquet(path)
    pulls = spark.read.parquet(path)
    assert len(pulls.inputFiles()) > 1000
    monkeypatch.setattr(streams.C, "pulls", lambda spark, sf_dir: pulls)
    expected = {(r.context, r.arm): (r.n, r.estimate) for r in N.constant_step_estimates(pulls, bandits.LR).collect()}
    found = {(r.context, r.arm): (r.n, r.estimate) for r in streams.i4(spark, "").collect()}
    assert found.keys() == expected.keys() and all(found[k] == pytest.approx(expected[k], rel=1e-9) for k in found)
    batches = []
    stream = streams.stream_of(spark, pulls).writeStream.foreachBatch(lambda batch, number: batches.append(batch.count()))
    stream.option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start().awaitTermination()
    assert batches == [1200]


@pytest.mark.parametrize("merge_every", [8, 2])
def test_a_log_equals_whole_versions(spark, merge_every):
    steps = transitions(spark, random_episodes(6, 30))
    path = files(steps, 3, ["event_id"])
    feed = spark.readStream.schema(steps.schema).option("maxFilesPerTrigger", 1).parquet(path)
    schema = "state LONG, action LONG, q DOUBLE"
    whole, log = T.VersionedTable(spark, new_path(spark, "whole"), schema), T.KeyedLog(spark, new_path(spark, "log"), schema, ["state", "action"], merge_every)
    for table, fold in ((whole, T.fold_q_learning(0.9, 0.5)), (log, T.changed_q(0.9, 0.5))):
        table.write(spark.createDataFrame([], schema), -1)
        run = T.run_batches(feed, table, fold, new_path(spark, "cp"))
        run.awaitTermination()
    last = run.lastProgress["batchId"]
    assert last == 2
    expected = as_dict(whole.read(last), "state", "action")
    assert as_dict(log.read(last), "state", "action") == pytest.approx(expected)
    # a batch that runs again replaces its own rows; those after it are not read meanwhile
    again = spark.read.schema(steps.schema).parquet(steps_files(spark, path)[1])
    log.write(T.changed_q(0.9, 0.5)(log.read(0), again), 1)
    assert as_dict(log.read(1), "state", "action") == pytest.approx(as_dict(whole.read(1), "state", "action"))
    assert as_dict(log.read(last), "state", "action") == pytest.approx(expected)


def test_counts_of_a_log(spark):
    steps = transitions(spark, random_episodes(8, 20))
    schema = "state LONG, action LONG, next_state LONG, experience_count LONG, reward_sum DOUBLE"
    log = T.KeyedLog(spark, new_path(spark, "log"), schema, ["state", "action", "next_state"], 2)
    log.write(spark.createDataFrame([], schema), -1)
    for k in range(3):
        log.write(T.changed_counts(log.read(k - 1), steps.filter(F.col("event_id") % 3 == k)), k)
    found, whole = T.model_of_counts(log.read(2)), M.empirical_model(steps)
    key = ("state", "action", "next_state")
    for column in ("reward", "experience_count", "probability"):
        assert as_dict(found.select(*key, column), *key) == pytest.approx(as_dict(whole.select(*key, column), *key))
    written = spark.read.parquet(log.folder(0)).count(), spark.read.parquet(log.folder(2)).count()
    assert written[1] < log.read(2).count() or written[0] == log.read(0).count()
