import datetime as dt
import random
import time

import __spark_entry__ as driver
from pyspark.sql import functions as F

from backsight.sources import logs
from backsight.storage import new_path
from backsight.streaming.linking import TransitionLog, run_linked

EVENT = "segment LONG, ts TIMESTAMP_NTZ, event_id LONG, state LONG, action LONG, reward DOUBLE"
START = dt.datetime(1969, 12, 30, 6, 0, 0, 250)  # times before 1970 are times like any other


def linked_in_batches(spark, batches, **options):
    """The log of a stream that gets each of ``batches`` in a run of its own, and the number of the last one."""
    arrived, checkpoint = new_path(spark, "feed"), new_path(spark, "cp")
    table = TransitionLog(spark, new_path(spark, "linked"), **options)
    table.start()
    for rows in batches:
        spark.createDataFrame(rows, EVENT).write.mode("append").parquet(arrived)
        run = run_linked(spark.readStream.schema(EVENT).parquet(arrived), table, checkpoint)
        run.awaitTermination()
    return table, run.lastProgress["batchId"]


def rows_of(df, *columns):
    return sorted(map(tuple, df.select(*columns).collect()), key=str)


def test_a_hot_segment_late_rows_nulls_and_state_that_goes(spark):
    rng = random.Random(11)
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
    batches = [nothing, rows[:250] + nothing, rows[250:450] + late, nothing, rows[450:] + [end]]
    table, last = linked_in_batches(spark, batches, gap_hours=4, delay_hours=48, rows_per_chunk=60)
    assert last == 4
    found = table.read(last)
    columns = [c for c in found.columns if c != "event_id"]
    assert rows_of(found, columns) == rows_of(expected, columns)
    # after the gap only the number of its episodes is left of a segment; the last event still waits
    assert [r.event_id for r in table.held.read(last).collect()] == [999]
    numbers = {r.segment: r.n for r in expected.groupBy("segment").agg(F.max("episode").alias("n")).collect()}
    assert {r.segment: (r.ended, r.steps) for r in table.progress.read(last).collect()} == {s: (n, 0) for s, n in numbers.items()}
    # a batch that runs again after a failure changes nothing
    before = rows_of(table.read(2), *columns), rows_of(table.held.read(2), "event_id"), rows_of(table.progress.read(2), "segment", "ended", "steps")
    table.link(spark.createDataFrame(batches[2], EVENT), 2)
    assert before == (rows_of(table.read(2), *columns), rows_of(table.held.read(2), "event_id"), rows_of(table.progress.read(2), "segment", "ended", "steps"))
    assert before[0] and before[1] and len(before[0]) < len(rows_of(expected, *columns))


def test_a_step_is_certain_at_the_watermark(spark):
    hour, ms, us = dt.timedelta(hours=1), dt.timedelta(milliseconds=1), dt.timedelta(microseconds=1)
    at = START.replace(microsecond=0)
    mark = at + 25 * hour
    rows = [(1, at - us, 0, 0, 0, 1.0), (2, at, 1, 0, 0, 1.0), (3, mark, 2, 0, 0, 1.0), (3, mark + us, 3, 0, 0, 1.0)]
    batches = [[*rows, (9, mark + hour + ms - us, 9, 0, 0, 1.0)], [(3, mark, 4, 5, 0, 1.0), (2, mark + us, 5, 5, 0, 1.0)], [(9, mark + 90 * hour, 10, 0, 0, 1.0)]]
    table, _ = linked_in_batches(spark, batches, gap_hours=25)
    steps = [{r.event_id: (r.episode, r.step_count, r.next_state, r.done) for r in table.read(k).collect()} for k in range(3)]
    assert steps[0] == {0: (1, 0, None, True)}  # more than the gap before the watermark; one is exactly the gap before it
    assert steps[1] == steps[0]  # event 4 is late, event 5 is not
    closed = {1: (1, 0, None, True), 5: (2, 0, None, True), 2: (1, 0, 0, False), 3: (1, 1, None, True), 9: (1, 0, None, True)}
    assert steps[2] == steps[0] | closed


def events_of(spark, segments, path):
    """Eight events of each segment in thirty days, two of them in one day, and one end after them."""
    at = F.expr("CAST('2024-01-01' AS TIMESTAMP_NTZ)") + F.expr("make_dt_interval(n * 4, (n * 7 + id) % 20, id % 60, id % 7)")
    spark.range(segments).withColumn("n", F.explode(F.sequence(F.lit(0), F.lit(7)))).select(
        (F.col("id") * 8 + F.col("n")).alias("event_id"), at.alias("ts"), F.col("id").alias("user_id"),
        F.when(F.col("n") % 2 == 0, "view").otherwise("click").alias("event_type"), (F.col("id") % 100).cast("double").alias("value"),
        F.concat(F.lit('{"k": '), F.col("n") * 9, F.lit("}")).alias("props"),
    ).write.parquet(f"{path}/events.parquet")
    return str(path)


def test_many_segments_take_hardly_more_time_than_a_few(spark, tmp_path):
    seconds = {}
    for segments in (10, 40_000):
        path = events_of(spark, segments, tmp_path / str(segments))
        started = time.perf_counter()
        found = driver.queries()["i1_stream_transitions"](spark, path).collect()
        seconds[segments] = time.perf_counter() - started
        log = logs.read_event_log(spark, f"{path}/events.parquet")
        mark = log.agg(F.max("ts")).first()[0] - dt.timedelta(hours=1)
        steps = logs.build_transitions(log).where((F.col("ts") <= F.lit(mark)) & (~F.col("done") | (F.col("ts") + F.expr("INTERVAL 24 HOURS") < F.lit(mark))))
        key = ("segment", "episode", "step_count", "state", "action", "next_state", "done", "event_id")
        assert len(found) > 6 * segments
        assert sorted((tuple(r[c] for c in key) for r in found), key=str) == sorted(map(tuple, steps.select(*key).collect()), key=str)
    assert seconds[40_000] < 4 * seconds[10], seconds
