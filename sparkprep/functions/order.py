"""Running totals and global ranks that never sort a whole group in one task.

A window over a whole subset, or over everything, would send one hot group to
one task. Each function here works on blocks: a small total per block, a window
over the block totals, and a window inside each block.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from sparkprep.functions.draws import draw_hex
from sparkprep.functions.groups import join_null_safe

BLOCK_ROWS = 65_536
_HEX_DIGITS = 3
HASH_BLOCKS = 16**_HEX_DIGITS  # per group: a fixed number, whatever the data size
MAX_BROADCAST_BLOCKS = 262_144  # rows of (group, block, start): under 32 MB


def prefix_sum(
    df: DataFrame,
    value: Column,
    *,
    within: Sequence[str],
    order: str,
    out: str,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add ``out`` = running total of ``value`` by ``order`` inside each group.

    ``order`` is an integer that is unique in its group, so a block holds at
    most ``block_rows`` rows and the second window sees one row per block.
    """
    keys = [*within, "_block"]
    blocked = df.withColumn("_block", F.floor(F.col(order) / F.lit(block_rows)))
    before = Window.partitionBy(*within).orderBy("_block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        blocked.groupBy(*keys)
        .agg(F.sum(value).alias("_total"))
        .select(*keys, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    )
    inside = Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    summed = blocked.withColumn("_inside", F.sum(value).over(inside))
    return (
        join_null_safe(summed, starts, keys)
        .withColumn(out, F.col("_start") + F.col("_inside"))
        .drop("_block", "_inside", "_start")
    )


def shuffled_rank(
    df: DataFrame,
    *,
    seed: int,
    key: Sequence[str],
    within: Sequence[str] = (),
    rank: str = "shuffle_rank",
    total: str | None = None,
    limit: int | None = None,
    groups: int | None = None,
) -> DataFrame:
    """Add the 1-based position of each row in a seeded shuffle of its group.

    The draw is uniform over the (unique) key, so its leading digits cut a
    group into blocks of equal size; a block starts after the rows of the
    blocks before it. ``total`` names an extra column for the group size.

    With ``limit`` only the first rows of each group are returned. Blocks that
    start beyond it are dropped before the row shuffle, so a sample of a few
    rows moves a few rows, whatever the size of the group. ``groups`` states
    how many groups there can be; while ``groups`` blocks tables stay small the
    block starts are broadcast, otherwise Spark joins them by shuffling.
    """
    keys = [*within, "_block"]
    drawn = df.withColumn("_draw", draw_hex(seed, *key)).withColumn(
        "_block", F.substring("_draw", 1, _HEX_DIGITS)
    )
    before = (
        Window.partitionBy(*within)
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    starts = (
        drawn.groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
        .select(
            *keys,
            F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"),
            F.sum("_rows").over(Window.partitionBy(*within)).alias("_group"),
        )
    )
    if limit is not None:
        starts = starts.where(F.col("_start") < limit)
    if groups is not None and groups * HASH_BLOCKS <= MAX_BROADCAST_BLOCKS:
        starts = F.broadcast(starts)
    inside = Window.partitionBy(*keys).orderBy("_draw", *key)
    ranked = join_null_safe(drawn, starts, keys).withColumn("_inside", F.row_number().over(inside))
    if limit is not None:
        # Lets every task keep only so many rows of a block before the rows are shuffled.
        ranked = ranked.where(F.col("_inside") <= limit)
    ranked = ranked.withColumn(rank, (F.col("_start") + F.col("_inside")).cast("bigint"))
    if limit is not None:
        ranked = ranked.where(F.col(rank) <= limit)
    if total:
        ranked = ranked.withColumn(total, F.col("_group"))
    return ranked.drop("_draw", "_block", "_start", "_group", "_inside")
