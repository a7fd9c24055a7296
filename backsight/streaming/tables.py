"""Tables kept up to date by a stream, one written version per micro-batch.

``foreachBatch`` may run a batch again after a failure. Version n is computed from version n - 1 and the batch alone
and replaces whatever an interrupted attempt left, so a repeated batch changes nothing.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import backups as S
from ..operators.bandits import arm_maps
from ..operators.models import upsert_model, with_probability
from ..operators.ordering import join_on


class VersionedTable:
    """Versions of a table in folders named by batch number; -1 is the start."""

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path, schema

    def folder(self, version: int) -> str:
        return f"{self.path}/version={version}"

    def write(self, table: DataFrame, version: int) -> None:
        table.write.mode("overwrite").parquet(self.folder(version))

    def read(self, version: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder(version))


class KeyedLog:
    """A keyed table as a log: a micro-batch writes the rows of the keys it changed, a reader takes each key's latest row.

    Every ``merge_every``-th batch writes the merged table instead, so a reader opens one merged table and fewer than that
    many batches. Which folders count follows from the batch number alone, and a batch that runs again replaces its own
    folder; so what an interrupted attempt left is never read.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: list[str], merge_every: int = 8):
        self.spark, self.path, self.schema, self.keys, self.merge_every = spark, path, schema, keys, merge_every

    def folder(self, number: int) -> str:
        return f"{self.path}/batch={number}"

    def merged_at(self, number: int) -> int:
        """The last batch up to ``number`` that wrote the merged table; -1 is the start."""
        return (number + 1) // self.merge_every * self.merge_every - 1

    def read(self, number: int) -> DataFrame:
        base = self.merged_at(number)
        rows = self._part(base)
        if base == number:
            return rows.drop("_batch")
        for later in range(base + 1, number + 1):
            rows = rows.unionByName(self._part(later))
        return self._latest(rows)

    def _part(self, number: int) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(self.folder(number)).withColumn("_batch", F.lit(number))

    def _latest(self, rows: DataFrame) -> DataFrame:
        values = [c for c in rows.columns if c not in (*self.keys, "_batch")]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*values), "_batch").alias("_row"))
        return newest.select(*self.keys, *[F.col(f"_row.{c}").alias(c) for c in values])

    def write(self, changed: DataFrame, number: int) -> None:
        """The whole table at the start (-1), the changed rows of a batch after it."""
        if number >= 0 and self.merged_at(number) == number:
            before = self.read(number - 1).withColumn("_batch", F.lit(number - 1))
            changed = self._latest(before.unionByName(changed.withColumn("_batch", F.lit(number))))
        changed.write.mode("overwrite").parquet(self.folder(number))


def run_batches(
    stream: DataFrame, table: VersionedTable | KeyedLog, fold: Callable[[DataFrame, DataFrame], DataFrame], checkpoint: str
) -> StreamingQuery:
    """Fold every micro-batch into the table: version n = fold(version n - 1, batch n); of a log, its changed rows."""

    def apply(batch: DataFrame, number: int) -> None:
        table.write(fold(table.read(number - 1), batch), number)

    return (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )


def running_counts(stream: DataFrame) -> DataFrame:
    """Streaming counts and reward sums per (state, action, next_state); use with output mode update or complete."""
    return stream.groupBy("state", "action", "next_state").agg(
        F.count("*").alias("experience_count"), F.sum("reward").alias("reward_sum")
    )


def model_of_counts(counts: DataFrame) -> DataFrame:
    """The empirical model of written running counts."""
    return with_probability(
        counts.select("state", "action", "next_state", "experience_count", (F.col("reward_sum") / F.col("experience_count")).alias("reward"))
    )


def fold_model(model: DataFrame, batch: DataFrame) -> DataFrame:
    return upsert_model(model, batch)


def fold_q_learning(gamma: float, lr: float) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """One Q-learning sweep over the micro-batch; pairs seen for the first time enter with 0."""

    def fold(q: DataFrame, batch: DataFrame) -> DataFrame:
        statistics = S.next_state_statistics(batch, gamma)
        targets = S.mean_targets(statistics, S.best_lookup(q), ["state", "action"])
        moved = F.coalesce("q", F.lit(0.0))
        return q.join(targets, ["state", "action"], "full").select(
            "state", "action",
            F.when(F.col("target").isNull(), moved).otherwise(moved + lr * (F.col("target") - moved)).alias("q"),
        )

    return fold


def changed_q(gamma: float, lr: float) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """The pairs that one Q-learning sweep over the micro-batch moves, for a log."""

    def fold(q: DataFrame, batch: DataFrame) -> DataFrame:
        targets = S.mean_targets(S.next_state_statistics(batch, gamma), S.best_lookup(q), ["state", "action"])
        moved = F.coalesce("q", F.lit(0.0))
        return join_on(targets, q, ["state", "action"], "left").select("state", "action", (moved + lr * (F.col("target") - moved)).alias("q"))

    return fold


def changed_counts(counts: DataFrame, batch: DataFrame) -> DataFrame:
    """(state, action, next_state, experience_count, reward_sum) of the outcomes that the micro-batch saw, for a log."""
    key = ["state", "action", "next_state"]
    before = counts.withColumnsRenamed({"experience_count": "_n", "reward_sum": "_sum"})
    return join_on(running_counts(batch), before, key, "left").select(
        *key,
        (F.col("experience_count") + F.coalesce("_n", F.lit(0))).alias("experience_count"),
        (F.col("reward_sum") + F.coalesce("_sum", F.lit(0.0))).alias("reward_sum"),
    )


def fold_arms(lr: float, start: float = 0.0) -> Callable[[DataFrame, DataFrame], DataFrame]:
    """Constant-step arm estimates: the batch's pulls of an arm act on its estimate as one map."""

    def fold(arms: DataFrame, batch: DataFrame) -> DataFrame:
        maps = arm_maps(batch, lr).withColumnRenamed("n", "_m")
        estimate = F.coalesce("estimate", F.lit(float(start)))
        return arms.join(maps, ["context", "arm"], "full").select(
            "context", "arm",
            (F.coalesce("n", F.lit(0)) + F.coalesce("_m", F.lit(0))).alias("n"),
            F.when(F.col("scale").isNull(), estimate).otherwise(F.col("scale") * estimate + F.col("shift")).alias("estimate"),
        )

    return fold
