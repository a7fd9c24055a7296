"""Connected components of a link table, by alternating large-star and small-star rounds.

Every round is two aggregations and two joins on node ids; a node with very many links is pre-aggregated by its
minimum, and its rows are joined to that one row, which adaptive execution can split. Each round is written, so lost
executors cost one round, and the table before it is deleted. The rounds end when all links are stars, which is counted
before each; nothing but such numbers reach the driver.

Cases: an empty link table has no nodes; null ends, self links and repeated links are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from backsight.storage import drop_path, new_path


#: Rows that a task writes at least, where their number is known: for fewer, starting the task takes longer than its work.
PER_TASK = 5_000


def write(df: DataFrame, label: str, most: int | None = None) -> tuple[DataFrame, str]:
    """The table, written and read again, and its path. ``most``: rows that it has at most, if known."""
    path = new_path(df.sparkSession, label)
    if most is not None:
        df = df.coalesce(most // PER_TASK + 1)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): for every linked node the smallest node that it reaches. ``a`` and ``b`` are longs."""
    ends = links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where("a <> b")
    stars, path = write(ends, "links")
    while True:
        loose, count = _loose(stars)
        if not loose:
            break
        both = _rows(stars, ("a", "b"), ("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m")).withColumnRenamed("a", "b")
        large = stars.join(least, "b").select("a", F.col("m").alias("b"))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = _rows(large.join(least, "a"), ("b", "m"), ("a", "m")).where("a <> b").distinct()
        (stars, made), old = write(small, "stars", 2 * count), path
        drop_path(stars.sparkSession, old)
        path = made
    return stars.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        stars.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )


def _rows(df: DataFrame, *pairs: tuple[str, str]) -> DataFrame:
    """(a, b) of each of the column pairs, from one reading of ``df``."""
    return df.select(F.inline(F.array(*(F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in pairs))))


def _loose(links: DataFrame) -> tuple[int, int]:
    """How many nodes have several smaller neighbours, or smaller and larger ones; none if all links are stars. And the links."""
    ends = links.select(F.inline(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))))
    met = ends.groupBy("node").agg(F.sum("up").alias("up"), F.min("up").alias("least"))
    found = met.agg(F.count_if(F.expr("up > 1 or (up = 1 and least = 0)")), F.sum("up")).first()
    return found[0], found[1] or 0
