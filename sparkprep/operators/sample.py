"""Sampling by token length and per dataset."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from sparkprep.functions.groups import join_null_safe
from sparkprep.functions.order import shuffled_rank


def bin_label(length: str | Column, edges: Sequence[int]) -> Column:
    """``(lower,upper]`` of the bin a length falls in, null outside all bins."""
    c = F.col(length) if isinstance(length, str) else length
    label = F.lit(None).cast("string")
    for lower, upper in reversed(list(zip(edges, edges[1:]))):
        label = F.when((c > lower) & (c <= upper), f"({lower},{upper}]").otherwise(label)
    return label


def parse_edges(text: str) -> list[int]:
    """``"0,512,1024"`` to edges; they must rise."""
    edges = [int(x) for x in text.split(",")]
    if len(edges) < 2 or any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError(f"bin edges must rise: {text!r}")
    return edges


def sample_length(df: DataFrame) -> Column:
    """``len`` when the table has it, else the number of ids; null drops the row."""
    known = [F.col("len")] if "len" in df.columns else []
    counted = [F.size("input_ids")] if "input_ids" in df.columns else []
    if not known and not counted:
        return F.lit(None).cast("int")
    return F.coalesce(*known, *counted)


def binned(df: DataFrame, edges: Sequence[int]) -> DataFrame:
    """Rows that fall in a bin, with ``len`` and ``bin_label``."""
    return (
        df.withColumn("len", sample_length(df))
        .withColumn("bin_label", bin_label("len", edges))
        .where(F.col("bin_label").isNotNull())
    )


def chosen_per_bin(
    df: DataFrame, edges: Sequence[int], k: int = 500, *, seed: int = 42, key: Sequence[str]
) -> DataFrame:
    """The keys of a uniform sample of ``k`` rows per bin, without replacement.

    ``key`` must be unique in the table: over several datasets, ids alone are not.

    Reads the key and the length only; token arrays are not touched.
    """
    keys = binned(df, edges).select(*key, "len", "bin_label")
    return shuffled_rank(
        keys,
        seed=seed,
        key=key,
        within=["bin_label"],
        rank="draw_rank",
        limit=k,
        groups=len(edges) - 1,
    )


def sample_per_bin(
    df: DataFrame,
    edges: Sequence[int],
    k: int = 500,
    *,
    seed: int = 42,
    key: Sequence[str],
    columns: Sequence[str] = ("input_ids",),
    broadcast_rows: int = 1_000_000,
) -> DataFrame:
    """The sampled rows with their token arrays.

    The choice has at most ``k`` rows per bin: while that is small it is sent to
    the scan of the arrays, which then moves nothing but the sample.
    """
    chosen = chosen_per_bin(df, edges, k, seed=seed, key=key)
    if k * (len(edges) - 1) <= broadcast_rows:
        chosen = F.broadcast(chosen)
    rows = df.select(*key, *columns)
    return join_null_safe(rows, chosen, key).select(*key, *columns, "len", "bin_label")


def bin_stats(
    df: DataFrame,
    edges: Sequence[int],
    k: int = 500,
    *,
    seed: int = 42,
    key: Sequence[str] = (),
    chosen: DataFrame | None = None,
) -> DataFrame:
    """Per bin, empty ones too: rows in it, rows collected (at most ``k``) and their sorted lengths.

    ``chosen`` may be a sample that was already drawn and written; without it ``key``
    is needed. ``total_size_bytes`` is what the collected ids take at 16 bits each.
    """
    labels = [f"({lower},{upper}]" for lower, upper in zip(edges, edges[1:])]
    bins = df.sparkSession.createDataFrame([(x,) for x in labels], "bin_label string")
    totals = binned(df, edges).groupBy("bin_label").agg(F.count("*").alias("total"))
    if chosen is None:
        chosen = chosen_per_bin(df, edges, k, seed=seed, key=key)
    collected = chosen.groupBy("bin_label").agg(
        F.count("*").alias("collected"), F.sort_array(F.collect_list("len")).alias("lengths")
    )
    nothing = F.array().cast("array<int>")
    both = bins.join(totals, "bin_label", "left").join(collected, "bin_label", "left")
    lengths = F.coalesce("lengths", nothing)
    size = F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + 2 * x)
    return both.select(
        "bin_label",
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("total", "collected")],
        lengths.alias("lengths"),
        size.alias("total_size_bytes"),
    )


def take_per_dataset(
    df: DataFrame, n: int, *, seed: int = 42, key: Sequence[str], datasets: int | None = None
) -> DataFrame:
    """The keys of the first ``n`` rows of each dataset in a seeded shuffle."""
    return shuffled_rank(
        df.select("dataset", *key),
        seed=seed,
        key=key,
        within=["dataset"],
        rank="draw_rank",
        limit=n,
        groups=datasets,
    )
