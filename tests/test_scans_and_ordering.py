import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from backsight.operators import scans
from backsight.operators.ordering import hot_keys, numbered, with_chunk
from backsight.sources import logs
from golden import START


def steps(spark, lengths, seed=0):
    rng = random.Random(seed)
    rows = [(k, t, rng.uniform(-1, 1)) for k, n in enumerate(lengths) for t in range(n)]
    return rows, spark.createDataFrame(rows, "key LONG, pos LONG, value DOUBLE").repartition(3)


def suffix(values, factor):
    out, after = [], 0.0
    for value in reversed(values):
        after = value + factor * after
        out.append(after)
    return out[::-1]


@pytest.mark.parametrize("factor,span", [(0.95, 4), (0.95, None), (1.0, 5), (0.5, 1), (1e-80, 3), (0.0, 3), (0.999, 2)])
def test_discounted_suffix_over_pieces(spark, factor, span):
    rows, df = steps(spark, [1, 3, 4, 5, 23, 40])
    found = {(r.key, r.pos): r.out for r in scans.discounted_suffix(df, ["key"], "pos", "value", factor, "out", span).collect()}
    for key in {k for k, _, _ in rows}:
        expected = suffix([v for k, _, v in rows if k == key], factor)
        for pos, value in enumerate(expected):
            assert found[key, pos] == pytest.approx(value, abs=1e-12)


def test_discounted_suffix_survives_long_episodes(spark):
    df = spark.range(30_000).select(F.lit(1).alias("key"), F.col("id").alias("pos"), F.lit(1.0).alias("value"))
    found = {r.pos: r.out for r in scans.discounted_suffix(df, ["key"], "pos", "value", 0.95, "out").collect()}
    assert found[0] == pytest.approx(20.0) and found[20_000] == pytest.approx(20.0)
    assert found[29_999] == 1.0 and found[29_998] == pytest.approx(1.95)


@pytest.mark.parametrize("span", [1, 4, 100])
def test_product_suffix(spark, span):
    rows, df = steps(spark, [1, 9, 14])
    found = {(r.key, r.pos): r.out for r in scans.product_suffix(df, ["key"], "pos", "value", "out", span).collect()}
    for key, pos, _ in rows:
        expected = 1.0
        for k, p, v in rows:
            if k == key and p >= pos:
                expected *= v
        assert found[key, pos] == pytest.approx(expected, abs=1e-12)


@pytest.mark.parametrize("span", [1, 3, 1000])
def test_compose_maps(spark, span):
    rng = random.Random(3)
    rows = [(k, p, rng.choice([0.0, 0.9, 0.5]), rng.uniform(-1, 1)) for k in range(3) for p in sorted(rng.sample(range(40), 15))]
    df = spark.createDataFrame(rows, "key LONG, pos LONG, scale DOUBLE, shift DOUBLE")
    for r in scans.compose_maps(df, ["key"], "pos", "scale", "shift", span).collect():
        for start in (0.0, 2.0):
            x = start
            for k, _, a, b in rows:
                if k == r.key:
                    x = a * x + b
            assert r.scale * start + r["shift"] == pytest.approx(x, abs=1e-12)


def test_halo_sees_across_pieces(spark):
    from pyspark.sql import Window as W

    _, df = steps(spark, [11])
    piece = W.partitionBy("key", "_piece").orderBy("pos")
    rows = scans.with_halo(df, "pos", 2, 4).withColumn("ahead", F.lead("pos", 2).over(piece)).filter("not _ghost").collect()
    assert {r.pos: r.ahead for r in rows} == {p: (p + 2 if p + 2 < 11 else None) for p in range(11)}
    with pytest.raises(ValueError):
        scans.with_halo(df, "pos", 4, 4)


def uneven_log(spark):
    """One segment holds most rows, after a stray old one; a null segment is one burst of equal times; gaps of all sizes."""
    rng = random.Random(5)
    rows, event = [], 0
    for segment, count in ((1, 120), (2, 7), (3, 1), (None, 60)):
        at = START
        for i in range(count):
            if segment is not None:
                at += dt.timedelta(hours=rng.choice([0, 1, 2, 5, 24, 25, 60]), microseconds=rng.choice([0, 1]))
            at = dt.datetime(1970, 1, 2) if segment == 1 and i == 0 else max(at, START)
            rows.append((segment, at, event, rng.randrange(4), rng.randrange(2), rng.random()))
            event += 1
    return rows, spark.createDataFrame(rows, "segment LONG, ts TIMESTAMP_NTZ, event_id LONG, state LONG, action LONG, reward DOUBLE")


def plain_transitions(rows):
    out = {}
    for segment in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == segment), key=lambda r: (r[1], r[2]))
        episode, step = 0, 0
        for i, row in enumerate(own):
            fresh = i == 0 or row[1] - own[i - 1][1] > dt.timedelta(hours=24)
            episode, step = (episode + 1, 0) if fresh else (episode, step + 1)
            ahead = own[i + 1] if i + 1 < len(own) and own[i + 1][1] - row[1] <= dt.timedelta(hours=24) else None
            out[row[2]] = (segment, episode, step, row[3], ahead[3] if ahead else None, ahead is None)
    return out


@pytest.mark.parametrize("rows_per_chunk", [1_000_000, 30, 5, 1])
def test_transitions_do_not_depend_on_chunks(spark, rows_per_chunk):
    rows, df = uneven_log(spark)
    found = {
        r.event_id: (r.segment, r.episode, r.step_count, r.state, r.next_state, r.done)
        for r in logs.build_transitions(df, 24, rows_per_chunk).collect()
    }
    assert found == plain_transitions(rows)


@pytest.mark.parametrize("keys", [[], ["segment"]])
@pytest.mark.parametrize("rows_per_chunk", [1_000, 9])
def test_numbers_do_not_depend_on_chunks(spark, keys, rows_per_chunk):
    rows, df = uneven_log(spark)
    found = {r.event_id: r.n for r in numbered(df, keys, ["ts", "event_id"], "n", rows_per_chunk).collect()}
    for group in ([rows] if not keys else [[r for r in rows if r[0] == s] for s in (1, 2, 3, None)]):
        for number, row in enumerate(sorted(group, key=lambda r: (r[1], r[2])), start=1):
            assert found[row[2]] == number


def test_chunks_stay_near_the_limit(spark):
    _, df = uneven_log(spark)
    cut = with_chunk(df, ["segment"], ["ts", "event_id"], hot_keys(df, ["segment"], 20), 20)
    sizes = {(r.segment, r.chunk): r["count"] for r in cut.groupBy("segment", "chunk").count().collect()}
    assert sum(sizes.values()) == df.count() and max(sizes.values()) <= 40
    assert len([k for k in sizes if k[0] is None]) >= 2
