"""Step-size and exploration schedules as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def learning_rate(number: Column, base: float, period: float, power: float) -> Column:
    """base / max(1, number / period) ** power."""
    return F.lit(float(base)) / F.pow(F.greatest(F.lit(1.0), number.cast("double") / F.lit(float(period))), F.lit(float(power)))


def learning_rate_value(number: float, base: float, period: float, power: float) -> float:
    """The same schedule for a driver-side loop counter."""
    return base / max(1.0, number / period) ** power


def spaced(number: Column, start: float, stop: float, count: int) -> Column:
    """The ``number``-th of ``count`` evenly spaced values from start to stop."""
    if count == 1:
        return F.lit(float(start))
    return F.lit(float(start)) + F.lit(float(stop) - float(start)) * number.cast("double") / F.lit(float(count - 1))


def spaced_values(start: float, stop: float, count: int) -> list[float]:
    return [start] if count == 1 else [start + (stop - start) * i / (count - 1) for i in range(count)]


def schedule_table(spark: SparkSession, count: int, **columns: Column) -> DataFrame:
    """One row per step number with the given schedule expressions over column ``number``."""
    return spark.range(count).withColumnRenamed("id", "number").select(
        "number", *[expr.alias(name) for name, expr in columns.items()]
    )
