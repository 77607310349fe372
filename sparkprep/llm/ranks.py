"""Exact positions in a seeded order, with no group in one task.

A uniform number in [0, 1) orders the rows. It also cuts them into blocks: about the
square root of the number of rows, so that a block and the list of all blocks both
stay small. The rows before a block are a window over one small row per block, and only
rows of one block are sorted together.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_DIGITS = 13  # hex digits that a double holds exactly


def uniform(draw: str) -> Column:
    """A hex digest as a number in [0, 1), in the order of the digest."""
    return F.conv(F.substring(draw, 1, _DIGITS), 16, 10).cast("bigint") / F.lit(float(16**_DIGITS))


def block_count(rows: int) -> int:
    """How many blocks a table of this size is cut into."""
    return max(1, math.isqrt(rows))


def running_total(
    df: DataFrame,
    value: Column,
    *,
    unit: str,
    order: Sequence[str],
    blocks: int,
    within: Sequence[str] = (),
    before: str = "before",
    total: str | None = None,
) -> DataFrame:
    """Add the sum of ``value`` over the rows that come earlier in the group.

    ``unit`` names a number in [0, 1) that ascends in the order ``unit, *order``.
    ``total`` names an extra column for the sum over the whole group. Columns of
    ``within`` may be null: nulls are a group.
    """
    keys = [*within, "_block"]
    cut = df.withColumn("_value", value).withColumn(
        "_block", F.least(F.floor(F.col(unit) * blocks), F.lit(blocks - 1)).cast("bigint")
    )
    earlier = Window.partitionBy(*within).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy(*keys).agg(F.sum("_value").alias("_sum"))
    starts = sums.select(
        *[F.col(k).alias(f"_{k}") for k in keys],
        F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start"),
        F.sum("_sum").over(Window.partitionBy(*within)).alias("_total"),
    )
    inside = Window.partitionBy(*keys).orderBy(unit, *order).rowsBetween(Window.unboundedPreceding, -1)
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_{k}"))
    out = (
        cut.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
        .join(starts, same)
        .withColumn(before, (F.col("_start") + F.col("_inside")).cast("bigint"))
    )
    if total:
        out = out.withColumn(total, F.col("_total").cast("bigint"))
    return out.drop("_value", "_block", "_inside", "_start", "_total", *[f"_{k}" for k in keys])
