"""Transition-model tables: reading, checking and writing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import MODEL


def read_model(spark: SparkSession, path: str) -> DataFrame:
    """A known model table with the declared schema; repeated outcomes of one (state, action) are kept."""
    return spark.read.schema(MODEL).parquet(path)


def flatten_model(nested: DataFrame) -> DataFrame:
    """Rows (state, action, outcomes ARRAY<STRUCT<probability, next_state, reward, done>>) to one row per outcome."""
    return nested.select("state", "action", F.inline("outcomes"))


def model_violations(model: DataFrame, tolerance: float = 1e-9) -> DataFrame:
    """(state, action) pairs whose outcome probabilities do not sum to one."""
    return (
        model.groupBy("state", "action")
        .agg(F.sum("probability").alias("total"), F.count("*").alias("outcomes"))
        .filter(F.abs(F.col("total") - 1) > tolerance)
    )


def write_result(table: DataFrame, path: str, run_id: str, order: list[str]) -> str:
    """Write a v, q or policy table sorted by its key under the run's own folder."""
    target = f"{path}/run_id={run_id}"
    table.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(target)
    return target
