"""Keep-max priority tables: put merges by maximum, pop takes the largest."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def put(queue: DataFrame, entries: DataFrame, keys: list[str]) -> DataFrame:
    return (
        queue.select(*keys, "priority")
        .unionByName(entries.select(*keys, "priority"))
        .groupBy(*keys)
        .agg(F.max("priority").alias("priority"))
    )


def pop(queue: DataFrame, keys: list[str], count: int) -> tuple[DataFrame, DataFrame]:
    """The ``count`` largest entries (ties by key) and what is left."""
    top = queue.orderBy(F.desc("priority"), *keys).limit(count)
    return top, queue.join(top, keys, "left_anti")
