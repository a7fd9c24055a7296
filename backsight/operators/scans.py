"""Running calculations inside an episode, safe for episodes of any length.

Steps have a dense position 0, 1, 2, ... An episode is cut every ``span`` positions, windows run inside one piece,
and a table with one row per later piece carries the rest. Episodes shorter than the span, which is nearly all of
them, add no row to that table; its scan filter (position >= span) reaches the parquet reader.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .ordering import join_on

MAX_SPAN = 65_536
ONE_PIECE = 2**40
SMALLEST_FACTOR = 1e-150  # powers of the discount stay above this inside one piece
NEGLIGIBLE_FACTOR = 1e-75  # its square vanishes beside the first term


def span_for(factor: float, limit: int = MAX_SPAN) -> int:
    """Longest piece over which powers of ``factor`` stay representable."""
    if factor <= 0.0 or factor >= 1.0:
        return limit
    return max(1, min(limit, int(math.log(SMALLEST_FACTOR) / math.log(factor))))


def discounted_suffix(
    df: DataFrame, keys: list[str], pos: str, value: str | Column, factor: float, out: str, span: int | None = None
) -> DataFrame:
    """out_t = value_t + factor * out_{t+1} inside each key, in one pass over the steps.

    Inside a piece this is the reversed running sum of value * factor^i divided by factor^i. The piece heads form
    the same recurrence with factor^span, solved by the same function.
    """
    value = F.col(value) if isinstance(value, str) else value
    if factor == 0.0:
        return df.withColumn(out, value)
    if factor <= NEGLIGIBLE_FACTOR:  # two terms are exact in double precision
        ahead = F.lead("_value").over(W.partitionBy(*keys).orderBy(pos))
        return (
            df.withColumn("_value", value)
            .withColumn(out, F.col("_value") + F.lit(factor) * F.coalesce(ahead, F.lit(0.0)))
            .drop("_value")
        )
    span = span or span_for(factor)
    work = (
        df.withColumn("_value", value)
        .withColumn("_piece", F.floor(F.col(pos) / span).cast("long"))
        .withColumn("_weight", F.pow(F.lit(factor), (F.col(pos) % span).cast("double")))
    )
    inside = W.partitionBy(*keys, "_piece").orderBy(F.desc(pos)).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = F.sum(F.col("_value") * F.col("_weight")).over(inside) / F.col("_weight")
    scanned = work.withColumn(out, local)
    if span < ONE_PIECE:
        heads = (
            work.filter(F.col(pos) >= span)
            .select(*keys, pos, "_piece", "_value", "_weight")
            .withColumn("_head", local)
            .filter(F.col(pos) % span == 0)
            .select(*keys, (F.col("_piece") - 1).alias("_head_no"), "_head")
        )
        # an undiscounted sum needs no second split: its heads are one row per 65,536 steps
        next_span = ONE_PIECE if factor == 1.0 else None
        carried = discounted_suffix(heads, keys, "_head_no", "_head", factor**span, "_carry", next_span)
        to_border = F.pow(F.lit(factor), (span - F.col(pos) % span).cast("double"))
        border = carried.select(*keys, F.col("_head_no").alias("_piece"), F.col("_carry").alias("_border"))
        scanned = join_on(scanned, border, keys + ["_piece"], "left").withColumn(
            out, F.col(out) + F.coalesce("_border", F.lit(0.0)) * to_border
        ).drop("_border")
    return scanned.drop("_piece", "_value", "_weight")


def product_suffix(df: DataFrame, keys: list[str], pos: str, value: str, out: str, span: int = MAX_SPAN) -> DataFrame:
    """out_t = value_t * value_{t+1} * ... to the end of the key."""
    work = df.withColumn("_piece", F.floor(F.col(pos) / span).cast("long"))
    inside = W.partitionBy(*keys, "_piece").orderBy(F.desc(pos)).rowsBetween(W.unboundedPreceding, W.currentRow)
    later = W.partitionBy(*keys).orderBy(F.desc("_piece")).rowsBetween(W.unboundedPreceding, W.currentRow)
    carried = (
        work.filter(F.col(pos) >= span).groupBy(*keys, "_piece").agg(F.product(value).alias("_part"))
        .select(*keys, (F.col("_piece") - 1).alias("_piece"), F.product("_part").over(later).alias("_carry"))
    )
    return (
        join_on(work.withColumn(out, F.product(value).over(inside)), carried, keys + ["_piece"], "left")
        .withColumn(out, F.col(out) * F.coalesce("_carry", F.lit(1.0)))
        .drop("_piece", "_carry")
    )


def compose_maps(df: DataFrame, keys: list[str], pos: str, scale: str, shift: str, span: int = MAX_SPAN) -> DataFrame:
    """Fold the ordered maps x -> scale * x + shift of each key into one (scale, shift) per key.

    Maps compose, so each (key, piece of ``span`` positions) is folded first and the pieces in order after that.
    """

    def fold(rows: DataFrame, group: list[str], order: str) -> DataFrame:
        after = W.partitionBy(*group).orderBy(F.desc(order)).rowsBetween(W.unboundedPreceding, -1)
        return (
            rows.withColumn("_after", F.coalesce(F.product(scale).over(after), F.lit(1.0)))
            .groupBy(*group)
            .agg(F.product(scale).alias(scale), F.sum(F.col(shift) * F.col("_after")).alias(shift))
        )

    pieces = fold(df.withColumn("_piece", F.floor(F.col(pos) / span).cast("long")), keys + ["_piece"], pos)
    return fold(pieces, keys, "_piece")


def with_halo(df: DataFrame, pos: str, ahead: int, span: int = MAX_SPAN) -> DataFrame:
    """Add ``_piece`` and ``_ghost`` so that a window over (keys, _piece) sees ``ahead`` following steps.

    The first steps of a piece are repeated in the piece before as ghosts; filter ``_ghost`` out after the window.
    """
    if ahead >= span:
        raise ValueError("the look-ahead must be shorter than the span")
    piece = F.floor(F.col(pos) / span).cast("long")
    repeat = (F.col(pos) >= span) & (F.col(pos) % span < ahead)
    return (
        df.withColumn("_own", piece)
        .withColumn("_piece", F.explode(F.when(repeat, F.array(piece, piece - 1)).otherwise(F.array(piece))))
        .withColumn("_ghost", F.col("_piece") != F.col("_own"))
        .drop("_own")
    )
