"""Merge datasets and split them reproducibly.

Splits are decided on the manifest, a few bytes per shard, or row by row from a
hash when a table has no shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.draws import draw_unit
from sparkprep.functions.groups import join_null_safe
from sparkprep.functions.order import shuffled_rank

SHARD_KEY = ("dataset", "subset", "shard_id")


def check_ratios(train: float, val: float, small: float) -> None:
    """Train and validation must cover everything; the small share must be in (0, 1]."""
    if abs(train + val - 1.0) > 0.001:
        raise ValueError(f"train and val ratios must sum to 1, got {train} and {val}")
    if not 0 < small <= 1:
        raise ValueError(f"the small train ratio must be in (0, 1], got {small}")


def _share(total: Column, ratio: float) -> Column:
    """``int(total * ratio)`` in double arithmetic."""
    return F.floor(total.cast("double") * F.lit(float(ratio))).cast("bigint")


def split_manifest(
    manifest: DataFrame,
    *,
    train_ratio: float = 0.9,
    val_ratio: float = 0.1,
    small_ratio: float = 0.05,
    seed: int = 42,
    key: Sequence[str] = SHARD_KEY,
) -> DataFrame:
    """Add ``split`` (train or val), ``in_train_small`` and ``position`` in the split.

    Train is the first ``int(n * train_ratio)`` shards of a seeded shuffle,
    validation the rest; train_small is the beginning of train, at least one
    shard of it, and stays part of it.
    """
    check_ratios(train_ratio, val_ratio, small_ratio)
    ranked = shuffled_rank(manifest, seed=seed, key=key, rank="_rank", total="_total")
    n_train = _share(F.col("_total"), train_ratio)
    n_small = F.when(
        F.col("_train") > 0, F.greatest(F.lit(1), _share(F.col("_train"), small_ratio))
    ).otherwise(0)
    is_train = F.col("_rank") <= F.col("_train")
    return (
        ranked.withColumn("_train", n_train)
        .withColumn("split", F.when(is_train, "train").otherwise("val"))
        .withColumn("in_train_small", F.col("_rank") <= n_small)
        .withColumn(
            "position",
            F.when(is_train, F.col("_rank")).otherwise(F.col("_rank") - F.col("_train")),
        )
        .drop("_rank", "_total", "_train")
    )


def only_train_small(
    manifest: DataFrame, *, small_ratio: float = 0.05, seed: int = 42, key: Sequence[str] = SHARD_KEY
) -> DataFrame:
    """A small train set taken from all shards: ``max(1, int(n * ratio))`` of them."""
    check_ratios(1.0, 0.0, small_ratio)
    ranked = shuffled_rank(manifest, seed=seed, key=key, rank="position", total="_total")
    n = F.greatest(F.lit(1), _share(F.col("_total"), small_ratio))
    return (
        ranked.where(F.col("position") <= n)
        .withColumn("split", F.lit("train_small"))
        .drop("_total")
    )


def with_small(split: DataFrame) -> DataFrame:
    """One row per shard and split it is part of: train_small repeats some of train."""
    labels = F.when(F.col("in_train_small"), F.array(F.col("split"), F.lit("train_small")))
    return split.withColumn(
        "split", F.explode(F.coalesce(labels, F.array("split")))
    ).drop("in_train_small")


def split_summary(labelled: DataFrame) -> DataFrame:
    """``split, shards, samples``"""
    return labelled.groupBy("split").agg(
        F.count("*").alias("shards"), F.sum("samples").cast("bigint").alias("samples")
    )


def rows_of_split(
    rows: DataFrame, labelled: DataFrame, split: str, key: Sequence[str] = SHARD_KEY
) -> DataFrame:
    """The rows of one split: a semi join with its shards; the subset without a name is one, too."""
    shards = labelled.where(F.col("split") == split).select(*key)
    return join_null_safe(rows, shards, key, "left_semi")


def split_rows(
    df: DataFrame,
    *,
    train_ratio: float = 0.9,
    val_ratio: float = 0.1,
    small_ratio: float = 0.05,
    seed: int = 42,
    key: Sequence[str] = ("id",),
) -> DataFrame:
    """Row-level split of a table without shards: a hash threshold, no shuffle.

    Sizes are the ratios in expectation; a row's label never depends on others.
    """
    check_ratios(train_ratio, val_ratio, small_ratio)
    u = draw_unit(seed, *key)
    return df.withColumn(
        "split", F.when(u < train_ratio, "train").otherwise("val")
    ).withColumn("in_train_small", u < float(train_ratio) * float(small_ratio))
