"""Ordered work on keys of any size.

A key may hold a large share of all rows, so no window here runs over a whole hot key. The rows of keys with more than
``rows_per_chunk`` rows are cut by ranges of (key, order, ...) that hold about equally many rows, whatever the order
column looks like; windows run inside a (key, chunk), and what must cross a chunk border travels through a small table
with one row per chunk. A null key is a key like any other.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..storage import settle

ROWS_PER_CHUNK = 5_000_000


def join_on(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """A join on equal keys in which null equals null; the keys are the left side's."""
    renamed = right.select(*[F.col(c).alias(f"_right_{c}") if c in keys else F.col(c) for c in right.columns])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, same, how).drop(*[f"_right_{k}" for k in keys])


def hot_keys(df: DataFrame, keys: list[str], rows_per_chunk: int) -> DataFrame | None:
    """Keys with more than ``rows_per_chunk`` rows and how many they have, or None when there are none.

    At most total rows / rows_per_chunk keys qualify; the written table's size then decides the join.
    """
    table = settle(df.groupBy(*keys).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows_per_chunk), "hot-keys")
    return None if table.isEmpty() else table


def with_chunk(df: DataFrame, keys: list[str], order: list[str], hot: DataFrame | None, rows_per_chunk: int = ROWS_PER_CHUNK) -> DataFrame:
    """Add ``chunk``: 0 for ordinary keys, ascending along ``order`` for hot ones, and ``is_hot``.

    The ranges come from a sample of the rows themselves, so they are written once: a repeated task must not cut anew.
    """
    cold = df.withColumn("chunk", F.lit(0).cast("long")).withColumn("is_hot", F.lit(False))
    if hot is None:
        return cold
    parts = -(-(hot.agg(F.sum("_n")).first()[0]) // rows_per_chunk) + 1
    rows = join_on(df, hot.select(*keys), keys, "left_semi").repartitionByRange(int(parts), *keys, *order)
    cut = settle(rows.withColumn("chunk", F.spark_partition_id().cast("long")), "hot-rows").withColumn("is_hot", F.lit(True))
    return join_on(cold, hot.select(*keys), keys, "left_anti").unionByName(cut)


def numbered(
    df: DataFrame, keys: list[str], order: list[str], out: str, rows_per_chunk: int = ROWS_PER_CHUNK
) -> DataFrame:
    """Dense row number from 1 per key in the given order; ``keys=[]`` numbers the whole table, by ranges at any size."""
    if not keys:
        parts = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.count() // rows_per_chunk + 1)
        cut = df.repartitionByRange(parts, *order).withColumn("chunk", F.spark_partition_id().cast("long"))
        return _numbered(settle(cut, "ranges"), ["chunk"], [], order, out)
    hot = hot_keys(df, keys, rows_per_chunk)
    chunked = with_chunk(df, keys, order, hot, rows_per_chunk)
    if hot is None:
        local = W.partitionBy(*keys, "chunk").orderBy(*order)
        return chunked.withColumn(out, F.row_number().over(local).cast("long")).drop("chunk", "is_hot")
    return _numbered(chunked, [*keys, "chunk"], keys, order, out).drop("is_hot")


def _numbered(chunked: DataFrame, pieces: list[str], keys: list[str], order: list[str], out: str) -> DataFrame:
    """Numbers inside the pieces, plus the rows of the key's earlier pieces: one row for each piece."""
    before = W.partitionBy(*keys).orderBy("chunk").rowsBetween(W.unboundedPreceding, -1)
    sizes = chunked.groupBy(*pieces).agg(F.count("*").alias("_size"))
    offsets = sizes.select(*pieces, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    local = chunked.withColumn(out, F.row_number().over(W.partitionBy(*pieces).orderBy(*order)).cast("long"))
    return join_on(local, offsets, pieces).withColumn(out, F.col(out) + F.col("_offset")).drop("_offset", "chunk")
