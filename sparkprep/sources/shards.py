"""Shards that never exceed their limit: the greedy cut, without walking a subset in one task.

A shard takes samples in order until the next one would exceed the limit, so each cut depends
on all cuts before it. Where a shard begins decides where the next one does; that function of
rows is composed block by block:

* A sample above the limit is a shard of its own. It parts its subset, so between two of them
  (a segment) every sample fits.
* A segment is cut into blocks of equally many bytes, several limits wide. The first shard
  that begins in a block does so within one limit of the block's start. From each of these few
  possible entries a block alone tells at which entry of the next block it ends.
* Two blocks in a row are such a function, too, then four, and so on: doubling takes as many
  small joins as the number of blocks has binary digits, each half the size of the one before.
* Read backwards, the functions tell the entry of every block, and blocks then cut
  themselves, all at once.

Samples without bytes begin no shard but a segment's first. A null size counts as none.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.order import BLOCK_ROWS, prefix_sum
from sparkprep.session import drop_scratch, written

# Rows of a block on average: what one task sorts and cuts.
CUT_ROWS = 262_144
_CELL = ["_g", "_seg", "_block"]


def _next_starts(off: np.ndarray, size: np.ndarray, limit: int) -> np.ndarray:
    """For each row as the start of a shard, the row that starts the next one; else the row count."""
    n = len(off)
    last = np.searchsorted(off, off + limit, "right") - 1
    full = (last > np.arange(n)) & (off[last] + size[last] > off + limit)
    return np.where(full, last, n)


def _sorted_columns(table: pa.Table):
    order = np.argsort(table.column("off").to_numpy(), kind="stable")
    return (table.column(c).to_numpy(zero_copy_only=False)[order] for c in ("sample_idx", "off", "size", "own"))


def _entries(limit: int, width: int, table: pa.Table) -> pa.Table:
    """``entry, exit`` of one block: where a shard that begins at ``entry`` leads in the next."""
    idx, off, size, own = _sorted_columns(table)
    n = len(idx)
    leads = np.append(_next_starts(off, size, limit), n)
    inside = np.append(own, False)
    # Follow starts inside the block, doubling the step, until they leave it.
    while inside[leads[:n]].any():
        leads[:n] = np.where(inside[leads[:n]], leads[leads[:n]], leads[:n])
    possible = np.flatnonzero(own & (off % width <= limit) & (leads[:n] < n))
    cell = [pa.array([table.column(c)[0].as_py()] * len(possible), table.column(c).type) for c in _CELL]
    found = [pa.array(idx[possible], pa.int64()), pa.array(idx[leads[possible]], pa.int64())]
    return pa.table([*cell, *found], names=[*_CELL, "entry", "exit"])


def _cut(limit: int, table: pa.Table, entered: pa.Table) -> pa.Table:
    """The starts of the shards that begin in one block."""
    found: list[int] = []
    if len(table) and len(entered):
        idx, off, size, own = _sorted_columns(table)
        leads = _next_starts(off, size, limit)
        at = int(np.flatnonzero(idx == entered.column("entry")[0].as_py())[0])
        while at < len(idx) and own[at]:
            found.append(int(idx[at]))
            at = int(leads[at])
    group = table.column("_g")[0].as_py() if found else None
    return pa.table(
        [pa.array([group] * len(found), pa.string()), pa.array(found, pa.int64())], names=["_g", "sample_idx"]
    )


def greedy_shards(
    df: DataFrame,
    bytes_col: Column,
    limit: int,
    *,
    by: tuple[str, ...] = ("dataset", "subset"),
    block_rows: int = BLOCK_ROWS,
    cut_rows: int = CUT_ROWS,
) -> DataFrame:
    """Add ``shard_id``: samples in order, a new shard where the next sample would exceed ``limit``.

    No shard holds more than ``limit`` bytes unless it is one sample; numbers run from 0 in
    each group without gaps. ``sample_idx`` is unique in its group; group columns may be null.
    """
    if limit <= 0:
        raise ValueError(f"the limit must be positive, got {limit}")
    spark = df.sparkSession
    scratch: list[str] = []

    def kept(table: DataFrame, label: str) -> DataFrame:
        out, path = written(table, label)
        scratch.append(path)
        return out

    # One text per group, never null; fields that are null are left out of it.
    group = F.to_json(F.struct(*by))
    size = F.coalesce(bytes_col.cast("bigint"), F.lit(0))
    slim = kept(df.select(group.alias("_g"), "sample_idx", size.alias("size")), "sizes")
    facts = slim.agg(F.max("size").alias("top"), F.avg("size").alias("mean")).first()
    if facts["top"] is None:
        return df.withColumn("shard_id", F.lit(None).cast("bigint"))
    order = {"within": ["_g"], "order": "sample_idx", "block_rows": block_rows}
    placed = prefix_sum(slim, F.col("size"), out="_cum", **order)
    if facts["top"] > limit:
        wide = (F.col("size") > limit).cast("bigint")
        placed = kept(prefix_sum(placed, wide, out="_seg", **order), "placed")
        opens = placed.where(F.col("size") > limit).select("_g", "_seg", F.col("_cum").alias("_base"))
        placed = placed.join(opens, ["_g", "_seg"], "left")
    else:
        placed = placed.withColumns({"_seg": F.lit(0).cast("bigint"), "_base": F.lit(0).cast("bigint")})
    off = (F.col("_cum") - F.col("size") - F.coalesce("_base", F.lit(0))).cast("bigint")
    placed = kept(placed.select("_g", "_seg", "sample_idx", "size", off.alias("off")), "placed")
    fits = placed.where(F.col("size") <= limit)
    firsts = fits.groupBy("_g", "_seg").agg(F.min("sample_idx").alias("sample_idx")).select("_g", "sample_idx")
    starts = placed.where(F.col("size") > limit).select("_g", "sample_idx").union(firsts)

    width = max(4 * limit, int(facts["mean"] * cut_rows))
    filled = fits.where("size > 0")
    block = F.floor(F.col("off") / F.lit(width))
    own = filled.withColumns({"_block": block, "own": F.lit(True)})
    # The rows in which a shard of the block before may end.
    halo = own.where((F.col("off") % F.lit(width) <= limit) & (F.col("_block") > 0))
    cells = own.union(halo.withColumns({"_block": F.col("_block") - 1, "own": F.lit(False)}))
    cells = kept(cells.select(*_CELL, "sample_idx", "off", "size", "own"), "cells")
    entered = cells.where("off = 0 and own").select(*_CELL, F.col("sample_idx").alias("entry"))
    blocks = (cells.agg(F.max("_block")).first()[0] or 0) + 1
    if blocks > 1:
        schema = "_g string, _seg bigint, _block bigint, entry bigint, exit bigint"
        one = cells.groupBy(*_CELL).applyInArrow(lambda table: _entries(limit, width, table), schema)
        entered = _all_entries(kept(one, "entries"), entered, blocks, kept)
    cut = (
        cells.groupBy(*_CELL)
        .cogroup(entered.toDF(*_CELL, "entry").groupBy(*_CELL))
        .applyInArrow(lambda table, entered: _cut(limit, table, entered), "_g string, sample_idx bigint")
    )
    # A segment's first sample with bytes stands for the samples without bytes before it.
    leading = cells.where("off = 0 and own").select("_g", "sample_idx")
    later = cut.join(leading, ["_g", "sample_idx"], "left_anti")
    starts = kept(starts.union(later).withColumn("_new", F.lit(1)), "starts")
    flagged = slim.join(starts, ["_g", "sample_idx"], "left")
    ids = prefix_sum(flagged, F.coalesce("_new", F.lit(0)), out="_n", **order)
    ids = ids.select("_g", "sample_idx", (F.col("_n") - 1).cast("bigint").alias("shard_id"))
    numbered, _ = written(ids, "shard-ids")
    for path in scratch:
        drop_scratch(spark, path)
    return df.withColumn("_g", group).join(numbered, ["_g", "sample_idx"]).select(*df.columns, "shard_id")


def _all_entries(one: DataFrame, first: DataFrame, blocks: int, kept) -> DataFrame:
    """The entry of every block: functions of 2, 4, ... blocks, then back from the longest."""
    steps = [one]
    while 1 << len(steps) < blocks:
        double = 1 << len(steps)
        left = steps[-1].where(F.col("_block") % double == 0)
        right = steps[-1].select("_g", F.col("entry").alias("exit"), F.col("exit").alias("_then"))
        joined = left.join(right, ["_g", "exit"]).select(*_CELL, "entry", F.col("_then").alias("exit"))
        steps.append(kept(joined, "entries"))
    reached = first
    for k in reversed(range(len(steps))):
        on = ["_g", "entry"]
        ahead = reached.select(*on).join(steps[k], on)
        ahead = ahead.select("_g", "_seg", (F.col("_block") + (1 << k)).alias("_block"), F.col("exit").alias("entry"))
        reached = kept(reached.union(ahead), "entered")
    return reached
