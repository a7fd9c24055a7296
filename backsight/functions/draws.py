"""Reproducible uniform draws: a hash of the seed and the row's own key, independent of partitioning."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def uniform(seed: int, *key: str | Column) -> Column:
    """A number in [0, 1), of 52 random bits, that depends only on ``seed`` and the key columns."""
    parts = [F.col(k) if isinstance(k, str) else k for k in key]
    text = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
